"""Near-duplicate documents by word shingles: a parity-sketch join.

Each shingle of a document's set is hashed to one block of a bit sketch and flips bits
there, so a block's content is the XOR of its shingles and two sketches differ in no more
places than the two sets do. Sets of similarity s or more differ in at most
(1 - s) / (1 + s) * (|A| + |B|) shingles. Within a band of set sizes this is at most d; of
any d + 1 blocks that hold something at least one is then equal in both sketches. Documents
that share such a block are compared by a dense parity sketch of all their shingles, whose
Hamming distance is again a lower bound, and what is left is verified on the texts.

Nothing is dropped: documents whose shingles fall into d blocks or fewer meet in a block of
their own. Blocks hold 64-bit XOR hashes and sets are compared as sets of 64-bit hashes.
"""

from __future__ import annotations

import itertools
import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ordermetrics.llm import words as w
from ordermetrics.llm.graph import components
from ordermetrics.llm.scratch import Scratch

SHINGLE = 5
NUMERATOR, DENOMINATOR = 80, 100
# Sizes of one band; a document also meets the partners it may have one band lower.
BAND_RATIO = 1.4
# A task remembers so many sets it has seen, so that copies are not sent on again and again.
SEEN = 50_000
# Blocks offered beyond d + 1 are SPARE - 1 and an eighth of d.
SPARE = 5
FEW = 1 << 30
# A block is crowded when more documents than this share it.
CROWD = 16
# Documents of one side of a task that compares a crowded block.
CHUNK = 1024


def shingle_sets(data, offsets, n_rows, size=SHINGLE):
    """(row, hash) of the distinct shingles of each row, sorted; rows count from 0."""
    data = w.LOWER[data]
    start, end, row = w.spans(data, offsets, w.NOT_SPACE)
    hashes = w.mix(w.word_hashes(data, start, end))
    bounds = w.row_bounds(row, n_rows)
    count = np.diff(bounds)
    total = np.zeros(len(hashes), np.uint64)
    for j, factor in enumerate(w.powers(w.BASES[1], size + 2)[0][1:size + 1]):
        if j < len(hashes):
            total[:len(hashes) - j] += hashes[j:] * factor
    # A shingle starts where enough words follow; a shorter text is one shingle.
    left = bounds[row + 1] - np.arange(len(hashes))
    short = (count < size) & (count > 0)
    whole = left >= size
    rows, values = row[whole], w.mix(total[whole], size)
    if short.any():
        first, last = bounds[:-1][short], bounds[1:][short]
        some = np.flatnonzero(short)
        sums = w.Ranges(hashes, w.BASES[1])(first, last)
        rows = np.concatenate([rows, some])
        values = np.concatenate([values, w.mix(sums + count[short].astype(np.uint64), size + 1)])
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[fresh], values[fresh]


def set_node(rows, values, bounds):
    """One 64-bit name for each row's set; 0 for an empty set."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(w.mix(values, 77), out=sums[1:])
    n = np.diff(bounds)
    node = w.mix(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64), 78)
    node[n == 0] = 0
    return node.astype(np.int64)


def bands(n: int, similarity: float) -> list[tuple[int, int, int]]:
    """(band, most differences, blocks) of each band in which a set of n shingles meets others.

    Band k holds the smaller set of a pair: sizes from ratio^k on. The larger set has at most
    1 / similarity times as many shingles.
    """
    found = []
    for k in {_band(n), *(_band(m) for m in (math.ceil(n * similarity - 1e-9), n))}:
        found.append(k)
    low_bands = range(min(found), _band(n) + 1)
    out = []
    for k in low_bands:
        top = _band_end(k) - 1
        most = int((1 - similarity) / (1 + similarity) * top * (1 + 1 / similarity) + 1e-9)
        out.append((k, most, most + most // 3 + 8))
    return out


def _band(n: int) -> int:
    k = int(math.log(max(n, 1)) / math.log(BAND_RATIO))
    while _band_end(k) <= n:
        k += 1
    while k > 0 and _band_end(k - 1) > n:
        k -= 1
    return k


def _band_end(k: int) -> int:
    return math.ceil(BAND_RATIO ** (k + 1) - 1e-9)


def block_keys(values: np.ndarray, similarity: float) -> tuple[np.ndarray, list]:
    """Names of the blocks that a set offers, and (band, certain) for each of its bands.

    ``certain`` is how many blocks a similar set shares at least. A name holds the band in
    its lowest six bits; the seventh marks the place of sets with too few blocks.
    """
    out, certain = [], []
    for band, most, blocks in bands(len(values), similarity):
        if most == 0:
            continue  # only equal sets are similar enough
        at = ((values >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        used, first = np.unique(at[order], return_index=True)
        parity = np.bitwise_xor.reduceat(w.mix(values, 5)[order], first)
        offered = most + SPARE + most // 8
        used, parity = used[:offered], parity[:offered]
        place = np.uint64(band << 32) + used.astype(np.uint64)
        names = w.mix(parity + w.mix(place, 9), 10) & np.uint64(~127 & (1 << 64) - 1)
        if len(used) <= most:
            names = np.append(names, np.uint64(64))
            certain.append((band, FEW))
        else:
            certain.append((band, len(used) - most))
        out.append(names | np.uint64(band))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), certain


def parity_bits(values: np.ndarray) -> np.ndarray:
    """A parity sketch of four bits or more for each shingle, a power of two long."""
    bits = max(64, 1 << (4 * len(values) - 1).bit_length())
    flips = np.bincount((w.mix(values, 6) >> np.uint64(64 - bits.bit_length() + 1)).astype(
        np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8))


def fold(bits: np.ndarray, length: int) -> np.ndarray:
    """A sketch as a shorter one: neighbouring bits share the leading bits of the hash."""
    if len(bits) == length:
        return bits
    apart = np.unpackbits(bits).reshape(-1, len(bits) // length)
    return np.packbits(np.bitwise_xor.reduce(apart, axis=1))


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two parity sketches, at the shorter one's length."""
    a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    length = min(len(a), len(b))
    return int(np.bitwise_count(fold(a, length) ^ fold(b, length)).sum())


def _sets(batches, text):
    for batch in batches:
        for first, stop, data, offsets in w.slices(batch, text):
            rows, values = shingle_sets(data, offsets, stop - first)
            bounds = w.row_bounds(rows, stop - first)
            yield batch, first, stop, values, bounds, set_node(rows, values, bounds)


def offered(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """(doc_id, hash, n_shingles, node, keys): each document's set and the blocks it offers.

    ``hash`` is the text's. A copy of a set that the same task has seen offers nothing.
    """
    names = ["doc_id", "hash", "n_shingles", "node", "keys"]

    def run(batches):
        seen: OrderedDict = OrderedDict()
        for batch, first, stop, values, bounds, node in _sets(batches, "text"):
            keys = []
            for i in range(stop - first):
                name = int(node[i])
                if not name or name in seen:
                    keys.append(np.zeros(0, np.uint64))
                    continue
                seen[name] = None
                if len(seen) > SEEN:
                    seen.popitem(last=False)
                keys.append(block_keys(values[bounds[i]:bounds[i + 1]], similarity)[0])
            ends = np.cumsum([0, *map(len, keys)])
            flat = np.concatenate(keys).view(np.int64)
            for i in range(0, len(keys), 256):
                end = min(i + 256, len(keys))
                part = batch.slice(first + i, end - i)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("hash"), pa.array(np.diff(bounds)[i:end]),
                    pa.array(node[i:end]), pa.ListArray.from_arrays(
                        pa.array((ends[i:end + 1] - ends[i]).astype(np.int32)),
                        pa.array(flat[ends[i]:ends[end]]))], names)

    return _plain(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, hash bigint, n_shingles bigint, node bigint, keys array<bigint>")


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.xxhash64(text).alias("hash"), text.alias("text"))


def _sketches(docs: DataFrame, text_col: str, similarity: float) -> DataFrame:
    certain = pa.list_(pa.struct([("band", pa.int32()), ("certain", pa.int32())]))

    def run(batches):
        for _, first, stop, values, bounds, node in _sets(batches, text_col):
            sets = [values[bounds[i]:bounds[i + 1]] for i in range(stop - first)]
            yield pa.RecordBatch.from_arrays([
                pa.array(node), pa.array(np.diff(bounds)),
                pa.array([parity_bits(x).tobytes() for x in sets], pa.binary()),
                pa.array([[{"band": band, "certain": n}
                           for band, n in block_keys(x, similarity)[1]] for x in sets],
                         certain)], ["node", "n", "bits", "certain"])

    return docs.select(text_col).mapInArrow(
        run, "node bigint, n bigint, bits binary, certain array<struct<band int, certain int>>")


def _close(pairs: DataFrame, sketches: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs whose sketches allow the similarity."""
    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            total = na + nb
            common = -(-numerator * total // (numerator + denominator))
            keep = np.minimum(na, nb) >= common
            for i in np.flatnonzero(keep):
                far = hamming(batch.column("sa")[int(i)].as_py(), batch.column("sb")[int(i)].as_py())
                keep[i] = far <= total[i] - 2 * common[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    a = sketches.select("node", "n", "bits").toDF("a", "na", "sa")
    b = sketches.select("node", "n", "bits").toDF("b", "nb", "sb")
    return pairs.select("a", "b").join(a, "a").join(b, "b").select(
        "a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _verified(
    pairs: DataFrame, texts: DataFrame, numerator: int, denominator: int,
) -> DataFrame:
    """Pairs whose texts' sets are similar enough."""
    def sets(batch, column, key):
        out = {}
        for first, stop, data, offsets in w.slices(batch, column):
            rows, values = shingle_sets(data, offsets, stop - first)
            bounds = w.row_bounds(rows, stop - first)
            for i in range(stop - first):
                out[first + i] = values[bounds[i]:bounds[i + 1]]
        return out

    def run(batches):
        for batch in batches:
            xs, ys = sets(batch, "ta", "a"), sets(batch, "tb", "b")
            keep = []
            for i in range(batch.num_rows):
                common = len(np.intersect1d(xs[i], ys[i], assume_unique=True))
                union = len(xs[i]) + len(ys[i]) - common
                keep.append(denominator * common >= numerator * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select(
        "a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    numerator: int = NUMERATOR, denominator: int = DENOMINATOR,
) -> DataFrame:
    """(doc_id, hash, n_shingles, root) of every row of ``docs``.

    ``hash`` is the xxhash64 of the text, null as empty; rows of one component have the same
    root, whatever their ids are. Two documents link when denominator * |A & B| >= numerator * |A | B| over their sets of
    lower-cased shingles; component_id is the smallest id reachable by links. A text of
    fewer than five words is one shingle. Null, empty or blank texts have no shingles and
    their own component. Repeated rows and equal texts are one set and share a component.
    Other columns are not read. Runs Spark jobs when called.

    Links are found in two steps so that no group yields all its pairs: first every document
    against the smallest one of each block, then, between the components that this leaves,
    the pairs of a block that are not yet in one component.
    """
    spark = docs.sparkSession
    similarity = numerator / denominator
    scratch = Scratch(spark, "near-duplicates")
    sets = scratch.keep(offered(docs, id_col, text_col, similarity), "sets")

    run = Window.partitionBy("key").orderBy("node")
    members = sets.select(F.explode("keys").alias("key"), "node").select(
        "key", "node", F.first("node").over(run).alias("pivot"),
        F.lead("node").over(run).alias("later"),
    ).filter("node <> pivot OR later <> pivot").select("key", "node", "pivot")
    members = scratch.keep(members, "members")
    described = scratch.keep(sets.drop("keys"), "documents")
    scratch.drop("sets")

    some = members.select("node").distinct()
    # One text for each set that shares a block with another.
    one = described.select("node", "hash").join(some, "node").groupBy("node").agg(
        F.min("hash").alias("hash"))
    texts = _plain(docs, id_col, text_col).join(one, "hash").groupBy(
        "hash", "node").agg(F.first("text").alias("text")).select("node", "text")
    texts = scratch.keep(texts, "texts")
    sketches = scratch.keep(_sketches(texts, "text", similarity), "sketches")

    star = members.filter("node <> pivot").selectExpr("pivot AS a", "node AS b").distinct()
    links = _links(scratch, star, sketches, texts, numerator, denominator, "star")
    found = components(scratch, links, "first")

    # Pairs across the components that are left in a block, in an eighth of the blocks at
    # first: what these link need not be compared again in all others.
    for turn, some in enumerate(("pmod(xxhash64(key), 8) = 0", "true")):
        left = _unsettled(members, found, sketches).filter(some)
        close = scratch.keep(
            _across(left, sketches, numerator, denominator), f"across-{turn}")
        links = links.union(scratch.keep(
            _verified(close, texts, numerator, denominator), f"across-{turn}-links"))
        scratch.drop(f"across-{turn}")
        found = components(scratch, links, f"found-{turn}")
    scratch.drop("members", "texts", "sketches")

    return described.join(found, "node", "left").select(
        "doc_id", "hash", "n_shingles", F.coalesce("root", "node").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    numerator: int = NUMERATOR, denominator: int = DENOMINATOR,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``; see :func:`grouped`.

    component_id is the smallest id reachable by links; a null id counts only where no
    document of the component has another.
    """
    known = grouped(docs, id_col, text_col, numerator, denominator)
    lowest = known.filter("n_shingles > 0").groupBy("root").agg(
        F.min("doc_id").alias("lowest"))
    return known.join(lowest, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(
            F.col("doc_id")).alias("component_id"))


def _unsettled(members: DataFrame, found: DataFrame, sketches: DataFrame) -> DataFrame:
    """(key, node, root, n, own, size): blocks in which links between components may be left.

    A pair shares a certain number of blocks, so crowded blocks can be left out for every
    document that has fewer of them than that number: its partners meet it in another block.
    The place of sets with too few blocks is never left out. A pair counts in the band of
    its smaller set, so a block needs a member of its own band.
    """
    info = sketches.select("node", "n", "certain").join(found, "node", "left").select(
        "node", "n", "certain", F.coalesce("root", "node").alias("root"))
    band = F.expr("CAST(key & 63 AS INT)")
    rows = members.select("key", "node").join(info, "node").select(
        "key", "node", "root", "n", band.alias("band"),
        (F.expr("array_max(certain.band)") == band).alias("own"),
        F.expr("filter(certain, x -> x.band = CAST(key & 63 AS INT))[0].certain").alias("certain"))
    block, mine = Window.partitionBy("key"), Window.partitionBy("node", "band")
    rows = rows.withColumns({
        "low": F.min("root").over(block), "high": F.max("root").over(block),
        "size": F.count("*").over(block), "lowest": F.min("certain").over(block),
        "owned": F.max("own").over(block)}).filter("low < high AND owned")
    rows = rows.withColumn("crowded", (F.col("size") > CROWD) & (F.expr("key & 64") == 0))
    rows = rows.withColumn("many", F.sum(F.col("crowded").cast("int")).over(mine))
    return rows.filter("NOT crowded OR many >= lowest").select(
        "key", "node", "root", "n", "own", "size")


def _across(
    rows: DataFrame, sketches: DataFrame, numerator: int, denominator: int,
) -> DataFrame:
    """Pairs of one block but different components whose sketches allow the similarity.

    A large block is cut into chunks and every two chunks are a group of their own. A task
    compares all its groups' rows at one distance at once; only pairs that are close enough become rows.
    """
    def close(rows):
        """Pairs (r, r + k) of one group, for all rows and one k after the other."""
        group = rows["group"]
        end = np.searchsorted(group, group, "right")
        least = min(map(len, rows["bits"]))
        wide = np.stack([fold(np.frombuffer(x, np.uint8), least) for x in rows["bits"]]).view(
            np.uint64)
        node, root, n, own, part, cross = (
            rows[c] for c in ("node", "root", "n", "own", "part", "cross"))
        at = np.arange(len(group))
        for k in range(1, len(group)):
            at = at[at + k < end[at]]
            if not len(at):
                return
            total = n[at] + n[at + k]
            common = -(-numerator * total // (numerator + denominator))
            fits = ((root[at] != root[at + k]) & (np.minimum(n[at], n[at + k]) >= common)
                    & (own[at] | own[at + k]) & (~cross[at] | (part[at] != part[at + k])))
            a = at[fits]
            far = np.bitwise_count(wide[a] ^ wide[a + k]).sum(axis=1, dtype=np.int64)
            a = a[far <= (total - 2 * common)[fits]]
            yield np.minimum(node[a], node[a + k]), np.maximum(node[a], node[a + k])

    def run(batches):
        held = None
        for batch in itertools.chain(batches, [None]):
            rows = held
            if batch is not None:
                rows = pa.Table.from_batches(
                    [*(held.to_batches() if held is not None else []), batch])
            if rows is None or not rows.num_rows:
                continue
            key, i, j = (rows.column(c).to_numpy() for c in ("key", "i", "j"))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            # The last group may go on in the next batch.
            stop = len(key) if batch is None else int(np.flatnonzero(new)[-1])
            held = rows.slice(stop)
            band = key & 63
            cuts = [0, *(np.flatnonzero(band[1:stop] != band[:-1][:max(stop - 1, 0)]) + 1), stop]
            group = np.cumsum(new)
            found = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = rows.slice(a, b - a)
                columns = {c: part.column(c).to_numpy() for c in ("node", "root", "n", "own", "part")}
                found += close(columns | {
                    "bits": part.column("bits").to_pylist(), "group": group[a:b],
                    "cross": (i != j)[a:b]}) if b > a else []
            if found:
                pairs = np.unique(np.concatenate([np.stack(x) for x in found], axis=1), axis=1)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, pairs)), ["a", "b"])

    parts = F.expr(f"CAST(ceil(size / {CHUNK}) AS INT)")
    cut = rows.join(sketches.select("node", "bits"), "node").withColumns({
        "parts": parts, "part": F.pmod(F.xxhash64("node"), parts).cast("int")})
    cut = cut.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).withColumns({
        "i": F.least("part", "other"), "j": F.greatest("part", "other")})
    cut = cut.select("key", "i", "j", "node", "root", "n", "own", "part", "bits").repartition(
        "key", "i", "j").sortWithinPartitions(F.expr("key & 63"), "key", "i", "j")
    return cut.mapInArrow(run, "a bigint, b bigint").distinct()


def _links(scratch, pairs, sketches, texts, numerator, denominator, label):
    close = scratch.keep(_close(pairs, sketches, numerator, denominator), f"{label}-close")
    links = scratch.keep(_verified(close, texts, numerator, denominator), f"{label}-links")
    scratch.drop(f"{label}-close")
    return links
