"""Document fingerprints by content-defined chunking.

A gear hash runs over a text's bytes; where it has enough leading zero bits, a chunk ends.
Chunking is normalised: below the usual chunk length a stricter mask applies, beyond it a
looser one, so lengths stay close to the usual one. An insertion moves the boundaries near
it only. A fingerprint is the set of chunk digests, each with its length; the likeness of a
fingerprint to another is the share of its bytes whose chunks the other holds as well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermetrics.llm import words as w

LEAST, USUAL, MOST = 16, 48, 192
STRICT_BITS, LOOSE_BITS = 7, 4
# Documents of one range of ids, and ranges at most; more documents make larger ranges.
ROWS = 4_000
RANGES = 2_000

GEAR = w.mix(np.arange(256, dtype=np.uint64), 4242)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, over the 64 bytes before it."""
    total = GEAR[data]
    for shift in (1, 2, 4, 8, 16, 32):
        if len(total) > shift:
            later = total.copy()
            later[shift:] += total[:-shift] << np.uint64(shift)
            total = later
    return total


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of one text end."""
    n = len(data)
    value = gear(data)
    loose = np.flatnonzero(value >> np.uint64(64 - LOOSE_BITS) == 0) + 1
    strict = loose[value[loose - 1] >> np.uint64(64 - STRICT_BITS) == 0].tolist()
    loose = loose.tolist()
    ends, at, i, j = [], 0, 0, 0
    while n - at > LEAST:
        while i < len(strict) and strict[i] < at + LEAST:
            i += 1
        if i < len(strict) and strict[i] <= at + USUAL:
            at = strict[i]
        else:
            while j < len(loose) and loose[j] <= at + USUAL:
                j += 1
            at = min(loose[j] if j < len(loose) else n, at + MOST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunks(text: str) -> dict[int, int]:
    """{digest: bytes} of a text's distinct chunks; a repeated chunk counts each time."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return {}
    ends = np.array(chunk_ends(data))
    starts = np.append(0, ends[:-1])
    digests = w.word_hashes(data, starts, ends) >> np.uint64(16)
    found, back = np.unique(digests, return_inverse=True)
    return dict(zip(found.tolist(), np.bincount(back, weights=ends - starts).astype(
        int).tolist()))


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's bytes in chunks of which b has as many bytes; 1 for two empty texts."""
    total = sum(a.values())
    if not total:
        return float(not b)
    return sum(min(n, b[x]) for x, n in a.items() if x in b) / total


def dump(found: dict[int, int]) -> str:
    return " ".join(f"{x:012x}:{n}" for x, n in found.items())


def load(text: str) -> dict[int, int]:
    return {int(x, 16): int(n) for x, n in (part.split(":") for part in text.split())}


def fingerprint(
    docs: DataFrame, text_col: str = "text", *others: Column,
) -> DataFrame:
    """(fingerprint, *others) of each row of ``docs``; a null text is empty."""
    rows = docs.select(F.col(text_col).alias("text"), *others)
    rest = rows.drop("text").schema

    def run(batches):
        for batch in batches:
            for first, stop, _, _ in w.slices(batch):
                part = batch.slice(first, stop - first)
                texts = w.strings(part, "text").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dump(chunks(x)) for x in texts]),
                     *(part.column(f.name) for f in rest.fields)],
                    ["fingerprint", *(f.name for f in rest.fields)])

    return rows.mapInArrow(run, "fingerprint string" + "".join(
        f", `{f.name}` {f.dataType.simpleString()}" for f in rest.fields))


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of ``after``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + after[:cut]


def compare_neighbours(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS,
) -> DataFrame:
    """Each text's fingerprint against its edited text's and the next document's.

    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The next document is the one after it by (id, text), null ids
    first; after the last comes the first, also when there is only one. Null texts are
    empty. Repeated rows follow each other. Documents are cut into ranges of ids of about
    ``rows`` documents; the first one of a range also goes to the range before it. Repeated
    ids stay in one range. Runs jobs on the ids when called.
    """
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("key"),
                        F.col(id_col).cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    count = docs.count()
    parts = min(RANGES, max(1, -(-count // rows)))
    cuts = plain.select(F.col("key").cast("double")).approxQuantile(
        "key", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    cuts = sorted({int(x) for x in cuts})
    rank = F.lit(0)
    table = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    if cuts:
        rank = F.size(F.filter(table, lambda x: x <= F.col("key")))
    placed = plain.withColumn("part", rank)
    firsts = {x["part"]: x["first"] for x in placed.groupBy("part").agg(
        F.min("key").alias("first")).collect()}
    order = sorted(firsts)
    ahead = [(firsts[b], a) for a, b in zip(order, order[1:] + order[:1])]
    tails = spark.createDataFrame(ahead, "key bigint, part int")
    tails = plain.join(F.broadcast(tails), "key").select("key", "doc_id", "text", "part", F.lit(
        True).alias("tail"))
    # Of equal first ids only the smallest text can come next.
    tails = tails.groupBy("part", "tail").agg(F.min(F.struct("key", "text")).alias("x")).select(
        "x.key", F.lit(None).cast("bigint").alias("doc_id"), "x.text", "part", "tail")
    both = placed.withColumn("tail", F.lit(False)).select(*tails.columns).union(tails)
    both = both.repartition(max(2, len(order)), "part").sortWithinPartitions(
        "part", "tail", "key", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def run(batches):
        before = None
        for batch in batches:
            for first, stop, _, _ in w.slices(batch):
                part = batch.slice(first, stop - first)
                out = []
                for doc, text, number, tail in zip(
                        part.column("doc_id").to_pylist(), part.column("text").to_pylist(),
                        part.column("part").to_pylist(), part.column("tail").to_pylist()):
                    own = chunks(text)
                    if before is not None and before[2] == number:
                        out.append(_compared(*before[:2], before[3], text, own))
                    before = None if tail else (doc, text, number, own)
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                        *map(pa.array, columns[2:])], names)

    return both.select("doc_id", "text", "part", "tail").mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")


def _compared(doc, text, own, after, other):
    changed = edited(text, after)
    found = chunks(changed)
    return (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), dump(own), dump(found),
            likeness(own, found), likeness(own, other))
