"""Removal of long word passages that occur more than once: recompression.

Equal passages are found by naming their parts alike wherever they stand. Rounds replace
runs of equal symbols and then, again and again, pairs of a left and a right symbol by new
symbols; which symbols are left ones is drawn anew in each round from the symbol's name. A
name is a hash of what it stands for, so all tasks give the same names without a dictionary.
Each symbol carries the range of words that decided it. A window of words contains a symbol
for certain when it contains that range, and then every equal window contains it too.

Every window picks the symbol with the smallest name among those that it contains of the
highest round. Windows that follow each other mostly pick the same one, so a text offers few
picks: with 35 words and five rounds about one for ten words. A pick whose symbol
is picked nowhere else ends the matter for its windows. Picks with equal symbols and equal
words all around are repeats as a whole. Only where symbols agree and the words around them
differ are single windows compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermetrics.llm import words as w
from ordermetrics.llm.scratch import Scratch

WINDOW = 35
# Rounds of pairs: more make symbols longer, but a window then contains fewer of them.
ROUNDS = 5


def _hashed(data, offsets, n_rows):
    """Two 64-bit hashes of each word, the row of each word and the rows' word bounds."""
    start, end, row = w.spans(data, offsets, w.NOT_SPACE)
    hashes = w.mix(w.word_hashes(data, start, end))
    return hashes, row, w.row_bounds(row, n_rows)


def levels(hashes: np.ndarray, row: np.ndarray, bounds: np.ndarray):
    """(names, first, end) of each round's symbols: first..end are the words that decide one.

    Ranges that reach beyond a text mark symbols that depend on where it begins or ends.
    """
    n = len(hashes)
    position = np.arange(n)
    yield hashes, position, position + 1
    # Runs of one word.
    fresh = np.ones(n, bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    end = np.append(first[1:], n)
    length = end - first
    names = np.where(length > 1, w.mix(hashes[first] + length.astype(np.uint64), 2), hashes[first])
    texts = row[first]
    low, high = first - 1, end + 1
    yield names, low, high
    for turn in range(ROUNDS):
        same = texts[1:] == texts[:-1]
        left = (w.mix(names, 100 + turn) >> np.uint64(63)).astype(bool)
        pair = np.zeros(len(names), bool)
        pair[:-1] = left[:-1] & ~left[1:] & same
        second = np.zeros(len(names), bool)
        second[1:] = pair[:-1]
        # What a symbol that stays alone depends on: its neighbour was no partner.
        follows = np.append(same, False)
        after = np.where(follows, np.append(high[1:], 0), bounds[texts + 1] + 1)
        before = np.where(np.append(False, same), np.append(0, low[:-1]), bounds[texts] - 1)
        high = np.where(left, after, high)
        low = np.where(left, low, before)
        joined = names.copy()
        at = np.flatnonzero(pair)
        joined[at] = w.mix(names[at] * np.uint64(3) + w.mix(names[at + 1], 4), 5)
        high[at] = np.where(pair, np.append(high[1:], 0), high)[at]
        names, texts, low, high = (x[~second] for x in (joined, texts, low, high))
        yield names, low, high


def _least(names: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where the leftmost smallest name stands in first..last, for many ranges at once."""
    tables = [np.arange(len(names))]
    width = int((last - first + 1).max())
    while 2 << (len(tables) - 1) <= width:
        half = 1 << (len(tables) - 1)
        a, b = tables[-1][:-half], tables[-1][half:]
        tables.append(np.where(names[b] < names[a], b, a))
    out = np.empty(len(first), np.int64)
    power = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    for k, table in enumerate(tables):
        at = np.flatnonzero(power == k)
        a, b = table[first[at]], table[last[at] + 1 - (1 << k)]
        out[at] = np.where(names[b] < names[a], b, a)
    return out


def picks(hashes: np.ndarray, row: np.ndarray, bounds: np.ndarray, window: int = WINDOW):
    """(key, first window, last window) of each pick; windows are numbered by their first word."""
    n = len(hashes)
    windows = np.flatnonzero(np.arange(n) + window <= bounds[row + 1]) if n else np.zeros(0, int)
    if not len(windows):
        return np.zeros(0, np.uint64), windows, windows
    level = np.zeros(len(windows), np.int64)
    chosen = np.zeros(len(windows), np.int64)
    key = np.zeros(len(windows), np.uint64)
    left = np.arange(len(windows))
    for turn, (names, low, high) in reversed(list(enumerate(levels(hashes, row, bounds)))):
        # Symbols whose words lie inside each window; both ends of the ranges only grow.
        before = np.cumsum(np.bincount(np.maximum(low, -1) + 1, minlength=n + 2))
        until = np.cumsum(np.bincount(np.minimum(high, n + 1), minlength=n + 2))
        first, last = before[windows[left]], until[windows[left] + window] - 1
        some = first <= last
        at = left[some]
        if len(at):
            one = _least(names, first[some], last[some])
            level[at], chosen[at], key[at] = turn, one, w.mix(names[one], 50 + turn)
        left = left[~some]
        if not len(left):
            break
    new = np.ones(len(windows), bool)
    new[1:] = ((level[1:] != level[:-1]) | (chosen[1:] != chosen[:-1])
               | (windows[1:] != windows[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    return key[first], windows[first], windows[last]


def _picked(docs: DataFrame, window: int) -> DataFrame:
    """(key, around, doc, hash, first, last): the picks of all texts; words from 0."""
    names = ["key", "around", "doc", "hash", "first", "last"]

    def run(batches):
        for batch in batches:
            doc, text_hash = batch.column("doc"), batch.column("hash").to_numpy()
            for at, stop, data, offsets in w.slices(batch):
                hashes, row, bounds = _hashed(data, offsets, stop - at)
                key, first, last = picks(hashes, row, bounds, window)
                around = w.Ranges(hashes, w.BASES[1])(first, last + window)
                text = row[first] if len(first) else first
                base = bounds[text]
                for i in range(0, len(first), 50_000):
                    part = slice(i, i + 50_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[part].view(np.int64)), pa.array(around[part].view(np.int64)),
                        doc.take(pa.array(at + text[part])),
                        pa.array(text_hash[at + text[part]]),
                        pa.array((first - base)[part].astype(np.int32)),
                        pa.array((last - base)[part].astype(np.int32))], names)

    return docs.mapInArrow(
        run, "key bigint, around bigint, doc bigint, hash bigint, first int, last int")


def _windows(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(key, words, doc, hash, first, n): the single windows of the wanted picks."""
    names = ["key", "words", "doc", "hash", "first", "n"]

    def run(batches):
        for batch in batches:
            for at, stop, data, offsets in w.slices(batch):
                hashes, _, bounds = _hashed(data, offsets, stop - at)
                sums = w.Ranges(hashes, w.BASES[0])
                for i in range(at, stop):
                    want = batch.column("want")[i].values
                    key, first, last, n = (want.field(j).to_numpy() for j in range(4))
                    many = last - first + 1
                    each = np.repeat(np.arange(len(key)), many)
                    start = first[each] + np.arange(len(each)) - np.repeat(
                        np.cumsum(many) - many, many)
                    found = sums(bounds[i - at] + start, bounds[i - at] + start + window)
                    rows = len(each)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[each]), pa.array(found.view(np.int64)),
                        pa.array([batch.column("doc")[i].as_py()] * rows, pa.int64()),
                        pa.array([batch.column("hash")[i].as_py()] * rows, pa.int64()),
                        pa.array(start.astype(np.int32)), pa.array(n[each])], names)

    lists = wanted.groupBy("doc", "hash").agg(
        F.collect_list(F.struct("key", "first", "last", "n")).alias("want"))
    return _joined(docs, lists, "inner").mapInArrow(
        run, "key bigint, words bigint, doc bigint, hash bigint, first int, n bigint")


def _joined(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    b = lists.withColumnsRenamed({"doc": "doc_b", "hash": "hash_b"})
    return docs.join(
        b, (docs["hash"] == b["hash_b"]) & docs["doc"].eqNullSafe(b["doc_b"]), how,
    ).drop("doc_b", "hash_b")


def repeats(scratch: Scratch, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, hash, first, end): word ranges covered by windows that also start elsewhere.

    ``docs`` is (doc, hash, text); see ``remove_repeats``.
    """
    scratch.release()
    found = scratch.keep(_picked(docs, window), "picks")
    classes = found.groupBy("key", "around").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "hash", "first", "last")).alias("one"))
    classes = scratch.keep(classes, "classes")
    whole = found.join(classes.filter("n > 1").select("key", "around"), ["key", "around"],
                       "left_semi").selectExpr("doc", "hash", "first", f"last + {window} AS end")
    # Copies of a row have the same ranges.
    whole = scratch.keep(whole.distinct(), "whole")
    scratch.drop("picks")

    # One pick of each class whose symbol has several classes: do single windows agree?
    several = classes.groupBy("key").agg(F.count("*").alias("classes")).filter("classes > 1")
    wanted = classes.join(several.select("key"), "key", "left_semi").select(
        "one.doc", "one.hash", "key", "one.first", "one.last", "n")
    single = scratch.keep(_windows(docs, wanted, window), "windows")
    scratch.drop("classes")
    agree = single.groupBy("key", "words").agg(F.sum("n").alias("total")).filter("total > 1")
    parts = single.filter("n = 1").join(agree, ["key", "words"], "left_semi").selectExpr(
        "doc", "hash", "first", f"first + {window} AS end")
    parts = scratch.keep(parts, "parts")
    scratch.drop("windows")
    return whole.union(parts)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    others: list[Column] = (),
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, *others): each text without its repeated passages.

    Words are runs of bytes other than ASCII white space, taken unchanged. A word goes when
    a window of ``window`` consecutive words covers it that also starts anywhere else, in
    another text or in the same one; all copies go. ``kept`` joins the other words by one
    space. One row for each row of ``docs``, also for repeated rows and repeated or null ids;
    null and empty texts have no words. Other columns are only carried, as
    far as ``others`` names them (not doc, hash, text, ranges, nor the columns above). Windows are compared by
    two hashes of 64 bits. Runs Spark jobs when called.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scratch = Scratch(docs.sparkSession, "repeats")
    wide = plain if not others else docs.select(
        F.col(id_col).cast("bigint").alias("doc"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), *others)
    rest = wide.drop(*plain.columns).schema
    lists = repeats(scratch, plain, window).groupBy("doc", "hash").agg(
        F.collect_list(F.struct("first", "end")).alias("ranges"))

    def run(batches):
        for batch in batches:
            for at, stop, data, offsets in w.slices(batch):
                start, end, row = w.spans(data, offsets, w.NOT_SPACE)
                bounds = w.row_bounds(row, stop - at)
                goes = np.zeros(len(start) + 1, np.int64)
                for i in range(at, stop):
                    ranges = batch.column("ranges")[i].values
                    if ranges is not None:
                        base = bounds[i - at]
                        np.add.at(goes, base + ranges.field(0).to_numpy(), 1)
                        np.add.at(goes, base + ranges.field(1).to_numpy(), -1)
                stays = np.cumsum(goes)[:-1] == 0
                kept = [_joined_words(data, start[a:b][stays[a:b]], end[a:b][stays[a:b]])
                        for a, b in zip(bounds[:-1], bounds[1:])]
                count = np.diff(bounds)
                left = np.add.reduceat(np.append(stays, 0), np.append(bounds[:-1], len(start)))[
                    :-1] * (count > 0)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc").slice(at, stop - at), pa.array(count),
                    pa.array(count - left), pa.array(kept, pa.binary()).cast(pa.string()),
                    *(batch.column(f.name).slice(at, stop - at) for f in rest.fields)],
                    ["doc_id", "n_words", "n_removed", "kept", *(f.name for f in rest.fields)])

    return _joined(wide, lists, "left").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept string" + "".join(
            f", `{f.name}` {f.dataType.simpleString()}" for f in rest.fields))


def _joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words with one space between them."""
    if not len(start):
        return b""
    length = end - start + 1
    out = np.full(int(length.sum()), 0x20, np.uint8)
    to = np.cumsum(length) - length
    shift = np.repeat(start - to, length)
    source = np.arange(len(out)) + shift
    inside = source < np.repeat(end, length)
    out[inside] = data[source[inside]]
    return out[:-1].tobytes()


def digest(kept: DataFrame) -> DataFrame:
    """The kept text as its SHA-256."""
    return kept.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")
