"""Resampling of documents towards a target corpus by importance weights of hashed n-grams.

A feature is a run of a few consecutive words joined by one space, its bucket the CRC-32 of
its bytes modulo a fixed number. No feature is ever put together: the words of a text are
scanned once, separated by single spaces, and the running CRC is stored at the end of each
word. The CRC of any run follows from two of these: a CRC is linear over GF(2), so the CRC
up to where the run starts, shifted by the run's length, cancels out of the CRC up to where
it ends. Shifting by n bytes is a linear map, kept as four tables of 256 entries.

Bucket totals of both corpora give each bucket a gain. A document's weight is the mean gain
of its features; with Gumbel noise drawn from its id, the highest scores are a sample without
replacement in proportion to the exponentiated weights.
"""

from __future__ import annotations

import math
import zlib
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermetrics.llm import words as w
from ordermetrics.llm.scratch import Scratch

BUCKETS = 10_000
WORDS = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = "7"

# Letters a-z, digits and bytes from 0x80 stay, A-Z in lower case; the rest separates.
NORMAL = bytes(int(w.LOWER[b]) if w.ALNUM[w.LOWER[b]] else 0x20 for b in range(256))


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


BYTE = _byte_table()


def _zeros(crc: np.ndarray) -> np.ndarray:
    """The register after one more zero byte."""
    return crc >> np.uint32(8) ^ BYTE[crc & np.uint32(255)]


def _applied(table: np.ndarray, crc: np.ndarray, base: np.ndarray | int = 0) -> np.ndarray:
    """A linear map, given by its values for each byte at each of the four places."""
    out = table[base + (crc & np.uint32(255))]
    for place in (1, 2, 3):
        out ^= table[base + 256 * place + (crc >> np.uint32(8 * place) & np.uint32(255))]
    return out


def _short_shifts() -> np.ndarray:
    """The maps of 0 to 255 bytes, one after another."""
    maps = [(np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
            .astype(np.uint32).ravel()]
    while len(maps) < 256:
        maps.append(_zeros(maps[-1]))
    return np.concatenate(maps)


SHORT = _short_shifts()
# Maps of 256, 512, 1024, ... bytes, made as far as some text needs them.
_long = [_zeros(SHORT[-1024:])]


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs after ``length`` more zero bytes each."""
    crc = _applied(SHORT, crc, (length & 255) * 1024)
    rest, turn = length >> 8, 0
    while rest.any():
        if turn == len(_long):
            _long.append(_applied(_long[-1], _long[-1]))
        some = np.flatnonzero(rest & 1)
        crc[some] = _applied(_long[turn], crc[some])
        rest, turn = rest >> 1, turn + 1
    return crc


def crcs(words: list[bytes], bounds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(crc, text) of every run of 1 to ``most`` words that lies in one text.

    ``words`` are those of all texts, each after one space; text i has those from
    ``bounds[i]`` to ``bounds[i + 1]``.
    """
    n = len(words)
    running = np.fromiter(accumulate(words, lambda crc, word: zlib.crc32(word, crc), initial=0),
                          np.uint32, n + 1)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, n))
    start = np.concatenate([[0], end[:-1]]) + 1
    # What the CRC is after the space that stands before each word.
    before = ~(_zeros(~running[:-1] ^ np.uint32(0x20)))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found, owners = [], []
    for size in range(1, most + 1):
        first = np.flatnonzero(text[size - 1:] == text[:n - size + 1]) if n >= size else np.zeros(0, int)
        last = first + size - 1
        found.append(running[last + 1] ^ shifted(before[first], end[last] - start[first]))
        owners.append(text[first])
    return np.concatenate(found), np.concatenate(owners)


def _features(batch: pa.RecordBatch, text_col: str, buckets: int, most: int):
    """(first row, end row, bucket, row, words of each row) of each slice of a batch."""
    for first, stop, data, offsets in w.slices(batch, text_col):
        plain = data.tobytes().translate(NORMAL)
        texts = [plain[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        count = np.fromiter(map(len, texts), np.int64, len(texts))
        words = [b" " + word for word in chain.from_iterable(texts)]
        bounds = np.concatenate([[0], np.cumsum(count)])
        crc, row = crcs(words, bounds, most)
        yield first, stop, crc % np.uint32(buckets), row, count


def bucket_counts(
    docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most: int = WORDS,
) -> DataFrame:
    """(bucket, n): features of all texts by bucket; each task sends one row a bucket at most."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, bucket, _, _ in _features(batch, text_col, buckets, most):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    found = docs.select(text_col).mapInArrow(run, "bucket bigint, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What each bucket adds, in thousandths: how much likelier the target makes it, smoothed by one.

    The two tables of counts have at most ``buckets`` rows each, whatever the corpora are.
    """
    s, t = [0] * buckets, [0] * buckets
    for counts, frame in ((s, source), (t, target)):
        for bucket, n in frame.collect():
            counts[bucket] = n
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((y + 1) * all_s / ((x + 1) * all_t)))
                     for x, y in zip(s, t)], np.int64)


def weighed(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    most: int = WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    def run(batches):
        for batch in batches:
            for first, stop, bucket, row, count in _features(batch, text_col, len(gain), most):
                n = np.bincount(row, minlength=stop - first)
                total = np.zeros(stop - first, np.int64)
                np.add.at(total, row, gain[bucket])
                yield pa.RecordBatch.from_arrays([
                    batch.column(id_col).slice(first, stop - first).cast(pa.int64()),
                    pa.array(count), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(seed: str) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    mark = F.sha2(F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform)))


def ranked(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, score, ...) with their place by falling score, from 1.

    The rows are range-partitioned and sorted there; a row's place is its position plus the
    rows of earlier ranges. A stored row number splits rows that are equal otherwise. Null ids
    come last among equal scores.
    """
    numbered = scratch.keep(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    sorted_rows = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits are the range, the lower 33 the position in it.
    placed = scratch.keep(sorted_rows.drop("_row").withColumn(
        "_at", F.monotonically_increasing_id()), "placed")
    span = F.shiftright("_at", 33).alias("_range")
    sizes = sorted(placed.groupBy(span).agg(F.count("*")).collect())  # one row a partition
    before = dict(zip((r for r, _ in sizes), accumulate((n for _, n in sizes), initial=0)))
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "_range int, _before bigint")
    return placed.withColumn("_range", span.cast("int")).join(offsets, "_range").withColumn(
        "rank", F.col("_before") + F.expr("_at & 8589934591") + 1).drop("_range", "_before", "_at")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, most: int = WORDS, seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; ``rank`` is null unless drawn.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred with the
    highest scores are drawn, ties to smaller ids. Words are runs of a-z, digits and
    characters beyond ASCII after A-Z is lower-cased. Null and empty texts have no features
    and weight 0; a null id draws noise as an empty one and comes last among equals. Repeated
    rows are documents of their own and may be drawn each. Other columns are not read. An
    empty table gives an empty one, an empty target is the smoothing alone. Runs Spark jobs
    when called.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    gain = gains(bucket_counts(docs, text_col, buckets, most),
                 bucket_counts(target, target_text, buckets, most), buckets)
    scored = scratch.keep(weighed(docs, gain, id_col, text_col, most).withColumn(
        "score", F.col("weight") + noise(seed)), "scored")
    enough = F.col("n_words") >= least_words
    draw = percent * scored.filter(enough).count() // 100
    places = ranked(scratch, scored.filter(enough))
    columns = ["doc_id", "n_features", "weight", "score"]
    return places.select(*columns, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank")).union(
        scored.filter(~enough).select(*columns, F.lit(None).cast("bigint").alias("rank")))
