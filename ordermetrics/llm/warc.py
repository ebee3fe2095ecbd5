"""WARC archives that are written with an index and read back by byte ranges.

Each task writes archives of its own, one gzip member for each record, and returns index
rows: file, offset, length, URL and digest. File names are drawn anew for each attempt and
only the index of an attempt that succeeded is kept, so a lost executor leaves no half
record. Reading starts from index rows: they are sorted by place, ranges that lie close
together become one read, and records are cut out of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import posixpath
import string
import uuid
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermetrics.llm import words as w
from ordermetrics.llm.scratch import Scratch

# Bytes at which a task begins another archive, and of one read at most unless a record is longer.
ARCHIVE = 128 << 20
READ = 4 << 20
# Ranges with a smaller gap between them are read together.
GAP = 64 << 10
INDEX = ("page_id bigint, file string, offset bigint, length bigint, url string, digest string, "
         "record_type string, refers_to bigint")
SAFE = "".join(set(string.punctuation) - {"%"})


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder's URI."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's URI as Spark resolves it: without a scheme it is in the default file system,
    which on a cluster is no executor's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page, url, payload: bytes, name: str, owner, revisit: bool) -> bytes:
    """One WARC record, a response with its payload or a revisit without."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
            "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, SAFE)}")
    head.append(f"WARC-Payload-Digest: sha1:{name}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{owner}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields and the payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    number = {k: fields.get(k, "<urn:page:>")[10:-1] for k in ("WARC-Record-ID", "WARC-Refers-To")}
    revisit = fields["WARC-Type"] == "revisit"
    name = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (digest(payload) != name or len(payload) != size):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    url = fields.get("WARC-Target-URI")
    return {"page_id": int(number["WARC-Record-ID"]) if number["WARC-Record-ID"] else None,
            "url": None if url is None else unquote(url), "payload_bytes": size,
            "payload_digest": name, "record_type": fields["WARC-Type"],
            "refers_to": int(number["WARC-Refers-To"]) if number["WARC-Refers-To"] else None,
            "payload": None if revisit else payload.decode()}


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", least: int = 0,
) -> DataFrame:
    """Write one record for each row of ``pages``; the rows of the index.

    The payload is the HTML in UTF-8, a null one is empty. Of records with equal payloads of
    at least ``least`` bytes, those with the largest page id are responses and the others
    revisits of it; repeated rows of that id are responses all. A null id counts as the
    smallest. Other columns are not read. The frame writes when it is evaluated: evaluate it
    once, as ``archive`` does.
    """
    plain = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    plain = plain.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    owners = plain.groupBy("sha").agg(F.max("page_id").alias("owner"))
    joined = plain.join(owners, "sha").select("page_id", "url", "html", "owner")

    def run(batches):
        system, path = store(folder)
        system.create_dir(path, recursive=True)
        out, name, place = None, None, 0
        try:
            for batch in batches:
                for first, stop, _, _ in w.slices(batch, "html"):
                    rows = []
                    for row in batch.slice(first, stop - first).to_pylist():
                        payload = row["html"].encode()
                        page, owner = row["page_id"], row["owner"]
                        revisit = page != owner and len(payload) >= least
                        key = digest(payload)
                        data = gzip.compress(
                            record(page, row["url"], payload, key, owner, revisit), 6, mtime=0)
                        if out is None or place + len(data) > ARCHIVE:
                            if out is not None:
                                out.close()
                            name = f"{uuid.uuid4().hex}.warc.gz"
                            out, place = system.open_output_stream(
                                posixpath.join(path, name), compression=None), 0
                        out.write(data)
                        rows.append({
                            "page_id": page, "file": name, "offset": place, "length": len(data),
                            "url": row["url"], "digest": key,
                            "record_type": "revisit" if revisit else "response",
                            "refers_to": owner if revisit else None})
                        place += len(data)
                    yield pa.RecordBatch.from_pylist(rows, schema=_arrow_index())
        finally:
            if out is not None:
                out.close()

    return joined.mapInArrow(run, INDEX)


def _arrow_index() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in INDEX.split(", "))])


def archive(pages: DataFrame, **options) -> tuple[str, DataFrame]:
    """(folder, index): archives and index below the shared folder, written when called."""
    scratch = Scratch(pages.sparkSession, "warc")
    folder = qualified(pages.sparkSession, f"{scratch.root}/archives")
    return folder, scratch.keep(write(pages, folder, **options), "index")


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> list[list[int]]:
    """Numbers of the sorted (offset, length) rows that one read takes together."""
    found: list[list[int]] = []
    begin = end = 0
    for i, (offset, length) in enumerate(rows):
        if found and offset - end <= gap and offset + length - begin <= most:
            found[-1].append(i)
        else:
            found.append([i])
            begin, end = offset, offset
        end = max(end, offset + length)
    return found


def read(folder: str, selected: DataFrame) -> DataFrame:
    """The records that the index rows ``selected`` name, as fields and payload.

    Payloads of responses are checked against length and digest; a revisit has none. Rows
    given twice are read twice. A large archive is read by several tasks.
    """
    spark = selected.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.expr(f"offset DIV {READ}")
    placed = selected.select("file", "offset", "length").repartition(
        tasks, "file", part).sortWithinPartitions("file", "offset")
    kinds = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload", pa.string())])

    def run(batches):
        system, path = store(folder)
        held, name = None, None
        try:
            for batch in batches:
                files = batch.column("file").to_pylist()
                places = list(zip(batch.column("offset").to_pylist(),
                                  batch.column("length").to_pylist()))
                at = 0
                while at < len(files):
                    stop = at
                    while stop < len(files) and files[stop] == files[at]:
                        stop += 1
                    if files[at] != name:
                        if held is not None:
                            held.close()
                        name = files[at]
                        held = system.open_input_file(posixpath.join(path, name))
                    for group in ranges(places[at:stop]):
                        own = [places[at + i] for i in group]
                        begin = own[0][0]
                        held.seek(begin)
                        data = held.read(max(o + n for o, n in own) - begin)
                        yield pa.RecordBatch.from_pylist(
                            [parse(gzip.decompress(data[o - begin:o - begin + n]))
                             for o, n in own], schema=kinds)
                    at = stop
        finally:
            if held is not None:
                held.close()

    return placed.mapInArrow(
        run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
             "record_type string, refers_to bigint, payload string")
