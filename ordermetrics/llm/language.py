"""Language identification: interpolated Kneser-Ney models of characters.

N-grams are counted over all labelled texts, in each task and then by Spark, and each
language's model is made from its counts. N-grams stay inside words, which begin and end with
a space. Each order is a sorted array of n-gram hashes with log probabilities and one of
context hashes with log back-off weights. Models with more n-grams than may be broadcast are
made and looked up by joins instead, with the same results. A text has the language of lowest cross-entropy per
character. Every fifth labelled text is kept back: what all of these show under their own
language's model says how far a text may lie from it, and texts beyond that are rejected, as
are texts without letters.
"""

from __future__ import annotations

import io
import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ordermetrics.llm import words as w
from ordermetrics.llm.scratch import Scratch

ORDER = 4
# N-grams of all models together that are broadcast. More of them stay a table that is joined.
MOST_GRAMS = 2_000_000
# N-grams a task holds before it passes them on.
HELD_GRAMS = 250_000
# Bytes of text worked on at once: more share more words, and take more of an executor's memory.
SLICE = 1 << 20
# Languages with fewer labelled texts keep none back.
FEW = 25
ALPHABET = 5000
UNKNOWN = "und"
# Characters that a score counts at most.
EVIDENCE = 40

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter(
            (chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def distinct_words(texts: list[str]):
    """(padded characters, bounds of the distinct words, word of each place, row of each place)."""
    lowered = [x.lower() for x in texts]
    offsets = np.cumsum([0, *map(len, lowered)])
    chars = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    start, end, row = w.runs(letters()[chars], offsets)
    hashes = w.word_hashes(chars, start, end)
    _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    start, end = start[one], end[one]
    bounds = np.concatenate([[0], np.cumsum(end - start + 2)])
    padded = np.full(bounds[-1], 32, np.uint64)
    inner = np.ones(len(padded), bool)
    inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
    to = np.repeat(start - bounds[:-1] - 1, end - start + 2) + np.arange(len(padded))
    padded[inner] = chars[to[inner]]
    return padded, bounds, which, row


def ngrams(padded: np.ndarray, bounds: np.ndarray, order: int = ORDER):
    """Places after the first of each word, their longest orders, and keys[k] at each place.

    keys[k] names the k characters that end at a place; keys[k - 1] of the place before is
    its context.
    """
    first = np.repeat(bounds[:-1], np.diff(bounds))
    place = np.arange(len(padded))
    depth = np.minimum(place - first + 1, order)
    keys = {0: np.zeros(len(padded), np.uint64)}
    up = w.powers(w.BASES[0], order + 1)[0]
    total = np.zeros(len(padded), np.uint64)
    for k in range(1, order + 1):
        total[k - 1:] += (padded[:len(padded) - k + 1] + np.uint64(1)) * up[k]
        keys[k] = w.mix(total, k)
    inside = np.flatnonzero(place > first)
    return inside, depth[inside], keys


def count_grams(texts: list[str], order: int = ORDER) -> dict[int, list[np.ndarray]]:
    """For each order: n-grams by key, how often, their contexts, suffixes, and whether they begin words."""
    padded, bounds, which, _ = distinct_words(texts)
    times = np.bincount(which, minlength=len(bounds) - 1)
    inside, depth, keys = ngrams(padded, bounds, order)
    word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[inside]
    weight = times[word].astype(np.float64)
    grams = {}
    for k in range(1, order + 1):
        at = inside[depth >= k]
        key, one, back = np.unique(keys[k][at], return_index=True, return_inverse=True)
        count = np.bincount(back, weights=weight[depth >= k], minlength=len(key))
        at = at[one]
        anchored = (depth[depth >= k][one] == k) & (k < order)
        grams[k] = [key, count, keys[k - 1][at - 1], keys[k - 1][at], anchored]
    return grams


def merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The n-grams of one order from several counts."""
    key, one, back = np.unique(
        np.concatenate([x[0] for x in parts]), return_index=True, return_inverse=True)
    count = np.bincount(back, weights=np.concatenate([x[1] for x in parts]), minlength=len(key))
    return [key, count, *(np.concatenate([x[i] for x in parts])[one] for i in (2, 3, 4))]


class Model:
    """An interpolated Kneser-Ney model; ``tables`` maps names to sorted arrays."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.tables = tables

    @classmethod
    def fit(cls, texts: list[str], order: int = ORDER) -> Model:
        return cls.of_grams(count_grams(texts, order), order)

    @classmethod
    def of_grams(cls, grams: dict[int, list[np.ndarray]], order: int = ORDER) -> Model:
        """From ``count_grams``, or several of these merged; keys are sorted."""
        grams = {k: list(columns) for k, columns in grams.items()}
        for k in range(1, order):  # lower orders count the characters seen before them
            key, count, _, _, anchored = grams[k]
            longer = grams[k + 1][3]
            seen = np.searchsorted(key, longer)
            before = np.bincount(seen, minlength=len(key))
            # A word's beginning has nothing before it and keeps its count.
            grams[k][1] = np.where(anchored & (k > 1), count, np.maximum(before, 1))
        tables = {}
        for k in range(1, order + 1):
            key, count, context, suffix, _ = grams[k]
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = max(0.1, min(0.9, ones / max(1, ones + 2 * twos)))
            names, back = np.unique(context, return_inverse=True)
            total = np.bincount(back, weights=count)
            kinds = np.bincount(back)
            weight_of = discount * kinds / np.maximum(total, 1)
            if k == 1:
                low = np.full(len(key), 1 / ALPHABET)
                tables["unseen"] = np.array([np.log(weight_of[0] / ALPHABET)]) if len(
                    key) else np.array([-np.log(ALPHABET)])
            else:
                low = np.exp(tables[f"p{k - 1}"][np.searchsorted(tables[f"k{k - 1}"], suffix)])
            tables[f"k{k}"] = key
            tables[f"p{k}"] = np.log(
                np.maximum(count - discount, 0) / np.maximum(total[back], 1) + weight_of[back] * low)
            tables[f"c{k}"], tables[f"b{k}"] = names, np.log(weight_of)
        return cls(tables)

    def scores(self, place, depth, keys, order: int = ORDER) -> np.ndarray:
        """Log probability at each place."""
        if not len(self.tables["k1"]):
            return np.full(len(place), self.tables["unseen"][0])
        out = np.zeros(len(place))
        open_ = np.arange(len(place))
        for k in range(order, 0, -1):
            reach = depth[open_] >= k
            now = open_[reach]
            found, value = self._look(f"k{k}", f"p{k}", keys[k][place[now]])
            out[now[found]] += value
            missed = now[~found]
            if k > 1:
                known, back = self._look(f"c{k}", f"b{k}", keys[k - 1][place[missed] - 1])
                out[missed[known]] += back
            open_ = np.concatenate([open_[~reach], missed])
        out[open_] += self.tables["unseen"][0]
        return out

    def _look(self, names: str, values: str, wanted: np.ndarray):
        table = self.tables[names]
        if not len(table):
            return np.zeros(len(wanted), bool), np.zeros(0)
        at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
        found = table[at] == wanted
        return found, self.tables[values][at[found]]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.tables)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as tables:
            return cls({k: tables[k] for k in tables.files})


def read(texts: list[str]):
    """(bounds of the distinct words, word of each place, row of each place), places with depths and keys."""
    padded, bounds, which, row = distinct_words(texts)
    return (bounds, which, row), ngrams(padded, bounds)


def entropies(
    models: list[Model], texts: list[str], adds: Adds | None = None, names: list[str] = (), seen=None,
) -> tuple[np.ndarray, np.ndarray]:
    """(characters, cross-entropy per character of each text under each model).

    ``adds`` is added to the scores of places, for the languages ``names`` of the models.
    ``seen`` is what ``read`` gives for the texts, if that is there already.
    """
    (bounds, which, row), (place, depth, keys) = seen or read(texts)
    word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[place]
    size = np.bincount(row, weights=(np.diff(bounds) - 1)[which], minlength=len(texts))
    out = np.zeros((len(texts), len(models)))
    known, at = adds.find(longest(place, depth, keys)) if adds else (None, None)
    for i, model in enumerate(models):
        scores = model.scores(place, depth, keys)
        if adds:
            scores[known] += adds.adds[at, adds.names.index(names[i])]
        each = np.bincount(word, weights=scores, minlength=len(bounds) - 1)
        total = np.bincount(row, weights=each[which], minlength=len(texts))
        out[:, i] = -total / np.maximum(size, 1)
    return size, out


def gathered(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, k, key, n, context, suffix, anchored): n-grams of all texts of ``rows`` (lang, text)."""
    names = ["lang", "k", "key", "n", "context", "suffix", "anchored"]

    def emit(held):
        for (lang, k), parts in held.items():
            key, n, context, suffix, anchored = merged(parts)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(key)), pa.array(np.full(len(key), k, np.int32)),
                pa.array(key.view(np.int64)), pa.array(n.astype(np.int64)),
                pa.array(context.view(np.int64)), pa.array(suffix.view(np.int64)),
                pa.array(anchored)], names)

    def run(batches):
        held, size = defaultdict(list), 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, stop, _, _ in w.slices(batch, size=SLICE):
                texts = defaultdict(list)
                rows_of = w.strings(batch, "text").slice(first, stop - first).to_pylist()
                for lang, text in zip(langs[first:stop], rows_of):
                    texts[lang].append(text)
                for lang, some in texts.items():
                    for k, part in count_grams(some, order).items():
                        held[lang, k].append(part)
                        size += len(part[0])
                if size > HELD_GRAMS:
                    held = defaultdict(list, {at: [merged(parts)] for at, parts in held.items()})
                    size = sum(len(x[0][0]) for x in held.values())
                    if size > HELD_GRAMS:
                        yield from emit(held)
                        held, size = defaultdict(list), 0
        yield from emit(held)

    counted = rows.select("lang", "text").mapInArrow(
        run, "lang string, k int, key bigint, n bigint, context bigint, suffix bigint, anchored boolean")
    return counted.groupBy("lang", "k", "key").agg(
        F.sum("n").alias("n"), *(F.first(c).alias(c) for c in names[4:]))


class Models(dict):
    """{language: (model, limits)}. With ``tables`` the models hold no n-gram: these have them.
    Then ``most`` bounds what is broadcast of the n-grams looked up.

    ``tables`` is (at, key, lang, value). Order k has its n-grams at ``own_at(k)``, by how much
    their log probability is above an unseen character's, and the log back-off weights of its
    contexts at ``back_at(k)``.
    """

    tables: DataFrame | None = None
    most: int = MOST_GRAMS


def own_at(k: int) -> int:
    return max(0, 2 * k - 3)


def back_at(k: int) -> int:
    return 2 * k - 2


def _tabled(scratch: Scratch, grams: DataFrame) -> tuple[DataFrame, dict[str, Model]]:
    """The tables of ``Models`` by joins, for n-grams of any number, and models that hold none.

    The steps are those of ``Model.of_grams``.
    """
    k = F.col("k")
    longer = grams.filter("k > 1").groupBy(
        "lang", (k - 1).alias("k"), F.col("suffix").alias("key")).agg(F.count("*").alias("before"))
    keeps = (k == ORDER) | (F.col("anchored") & (k > 1))
    counts = scratch.keep(grams.join(longer, ["lang", "k", "key"], "left").select(
        "lang", "k", "key", "context", "suffix",
        F.when(keeps, F.col("n")).otherwise(F.coalesce("before", F.lit(1))).alias("n")), "counts")
    ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    discounts = counts.groupBy("lang", "k").agg(F.greatest(F.lit(0.1), F.least(
        F.lit(0.9), ones / F.greatest(F.lit(1), ones + 2 * twos))).alias("discount"))
    weights = scratch.keep(counts.groupBy("lang", "k", "context").agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds")).join(
        F.broadcast(discounts), ["lang", "k"]).withColumn(
        "weight", F.col("discount") * F.col("kinds") / F.col("total")), "weights")
    shares = scratch.keep(counts.join(weights, ["lang", "k", "context"]).select(
        "lang", "k", "key", "suffix", "weight",
        ((F.col("n") - F.col("discount")) / F.col("total")).alias("share")), "shares")
    unseen = weights.filter("k = 1").select("lang", F.log(F.col("weight") / ALPHABET).alias("unseen"))
    tables = weights.filter("k > 1").select(
        (2 * k - 2).alias("at"), F.col("context").alias("key"), "lang", F.log("weight").alias("value"))
    low = None
    for order in range(1, ORDER + 1):
        level = shares.filter(k == order)
        level = level.withColumn("low", F.lit(1 / ALPHABET)) if low is None else level.join(
            low.select("lang", F.col("key").alias("suffix"), F.col("p").alias("low")), ["lang", "suffix"])
        low = scratch.keep(level.select(
            "lang", "key", (F.col("share") + F.col("weight") * F.col("low")).alias("p")), f"order{order}")
        tables = tables.union(low.join(F.broadcast(unseen), "lang").select(
            F.lit(own_at(order)), "key", "lang", F.log("p") - F.col("unseen")))
    tables = scratch.keep(tables, "tables")
    empty = {f"{x}{k}": np.zeros(0, np.uint64 if x in "kc" else np.float64)
             for x in "kpcb" for k in range(1, ORDER + 1)}
    models = {x.lang: Model(empty | {"unseen": np.array([x.unseen])})
              for x in unseen.orderBy("lang").collect()}
    scratch.drop("counts", "weights", "shares", *(f"order{k}" for k in range(1, ORDER + 1)))
    return tables, models


class Adds:
    """What the tables add to the scores of places, by language: of frequent n-grams."""

    def __init__(self, grams: np.ndarray, names: list[str], adds: np.ndarray):
        self.grams, self.names, self.adds = grams, names, adds

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``grams`` are known, where these are)."""
        if not len(self.grams):
            return np.zeros(len(grams), bool), np.zeros(0, int)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        return known, at[known]


def longest(place: np.ndarray, depth: np.ndarray, keys: dict[int, np.ndarray]) -> np.ndarray:
    """The key of the longest n-gram that ends at each place; it settles what a place scores."""
    out = keys[ORDER][place]
    for k in range(1, ORDER):
        out[depth == k] = keys[k][place[depth == k]]
    return out


def _gram_adds(asked: DataFrame, tables: DataFrame) -> DataFrame:
    """(gram, lang, adds): what ``tables`` add where each of the distinct ``asked`` stands."""
    found = asked.select("gram", F.posexplode("asked").alias("at", "key")).join(tables, ["at", "key"])
    at, value = F.col("at"), F.col("value")
    own = F.when((at == 0) | (at % 2 == 1), at)
    found = found.groupBy("gram", "lang").agg(
        F.max(own).alias("top"), F.max_by(value, own).alias("value"),
        *(F.max(F.when(at == back_at(k), value)).alias(f"b{k}") for k in range(2, ORDER + 1)))
    # The longest n-gram that is known, and the back-off weights of all longer orders.
    top = F.coalesce("top", F.lit(-1))
    adds = F.when(top >= 0, value).otherwise(0.0)
    for k in range(2, ORDER + 1):
        adds = adds + F.when(top < own_at(k), F.coalesce(f"b{k}", F.lit(0.0))).otherwise(0.0)
    return found.select("gram", "lang", adds.alias("adds"))


def _looked_up(
    scratch: Scratch, rows: DataFrame, tables: DataFrame, names: list[str], most: int,
) -> tuple[Adds, DataFrame | None]:
    """What n-grams of the texts of ``rows`` add: of the frequent ones, and a table of the others.

    Each distinct n-gram of all texts is looked up once. The most frequent ones, at most ``most``
    numbers, are for a broadcast; the others, if there are any, are (gram, adds): a list of
    (place in ``names``, what it adds).
    """
    def merge(parts):
        gram, one, back = np.unique(
            np.concatenate([x[0] for x in parts]), return_index=True, return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([x[1] for x in parts]), minlength=len(gram))
        return [gram, n, *(np.concatenate([x[i] for x in parts])[one] for i in (2, 3))]

    def emit(parts):
        if parts:
            gram, n, depth, asked = merge(parts)
            inside = np.arange(asked.shape[1]) <= back_at(depth)[:, None]
            yield pa.RecordBatch.from_arrays([
                pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *inside.sum(axis=1)]), pa.int32()),
                    pa.array(asked[inside].view(np.int64)))], ["gram", "n", "asked"])

    def take_grams(batches):
        held, size = [], 0
        for batch in batches:
            for first, stop, _, _ in w.slices(batch, size=SLICE):
                texts = w.strings(batch, "text").slice(first, stop - first).to_pylist()
                padded, bounds, which, _ = distinct_words(texts)
                if not len(which):
                    continue
                place, depth, keys = ngrams(padded, bounds)
                times = np.repeat(np.bincount(which), np.diff(bounds))[place].astype(float)
                gram, one, back = np.unique(
                    longest(place, depth, keys), return_index=True, return_inverse=True)
                place, depth = place[one], depth[one]
                asked = np.empty((len(gram), back_at(ORDER) + 1), np.uint64)
                for k in range(ORDER, 0, -1):
                    asked[:, back_at(k)] = keys[k - 1][place - 1]
                    asked[:, own_at(k)] = keys[k][place]
                held.append([gram, np.bincount(back, weights=times), depth, asked])
                size += len(gram)
                if size > HELD_GRAMS:
                    held = [merge(held)]
                    size = len(held[0][0])
                    if size > HELD_GRAMS:
                        yield from emit(held)
                        held, size = [], 0
        yield from emit(held)

    asked = scratch.keep(rows.select("text").mapInArrow(
        take_grams, "gram bigint, n bigint, asked array<bigint>").groupBy("gram").agg(
        F.first("asked").alias("asked"), F.sum("n").alias("n")), "asked")
    adds = scratch.keep(_gram_adds(asked, tables), "adds")

    # Powers of two of how often n-grams occur decide, the most frequent first.
    level = F.floor(F.log2("n"))
    levels = sorted(asked.groupBy(level.alias("level")).agg(F.count("*")).collect(), reverse=True)
    room, least = most // max(1, len(names)), None
    for at, n in levels:
        room -= n
        if room < 0:
            break
        least = at
    frequent = asked.filter(F.lit(False) if least is None else level >= least)
    table = frequent.select("gram").join(adds, "gram", "left").toArrow()
    known, at = np.unique(np.array(table.column("gram"), np.int64).view(np.uint64), return_inverse=True)
    lang = np.asarray(pc.fill_null(pc.index_in(
        table.column("lang").combine_chunks(), pa.array(names, pa.string())), -1))
    matrix = np.zeros((len(known), len(names)))
    matrix[at[lang >= 0], lang[lang >= 0]] = np.array(table.column("adds"), float)[lang >= 0]
    held = Adds(known, names, matrix)
    rare = None
    if room < 0:
        column = (F.array_position(F.lit(names), F.col("lang")) - 1).cast("int").alias("column")
        rare = scratch.keep(adds.groupBy("gram").agg(
            F.collect_list(F.struct(column, "adds")).alias("adds")), "rare")
    scratch.drop("asked", "adds")
    return held, rare


def _rare_of(seen, rows: int, common: Adds) -> tuple[np.ndarray, list[np.ndarray]]:
    """(distinct n-grams of a slice that are not ``common``, bounds of rows, which of them, how often)."""
    (bounds, which, row), (place, depth, keys) = seen
    gram = longest(place, depth, keys)
    rare = ~common.find(gram)[0]
    grams, gram = np.unique(gram[rare], return_inverse=True)
    word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[place][rare]
    # The rare places of each word, for all rows where the word stands.
    some = np.bincount(word, minlength=len(bounds) - 1)
    begin = np.cumsum(some) - some
    times = some[which]
    to = np.repeat(begin[which] - np.cumsum(times) + times, times) + np.arange(times.sum())
    many = max(1, len(grams))
    pair, n = np.unique(np.repeat(row, times) * many + gram[to], return_counts=True)
    ends = np.searchsorted(pair // many, np.arange(rows + 1))
    return grams, [ends, pair % many, n]


def _scored(
    scratch: Scratch, rows: DataFrame, start, finish, schemas: tuple[str, str],
    rare: DataFrame | None = None,
) -> DataFrame:
    """``finish(part, sums)`` of what ``start()(slice, seen)`` measures on slices of ``rows``.

    ``start`` gives the n-grams that are broadcast too. ``sums`` is what the n-grams of ``rare``
    add to each row, a function of a language's place. A slice's distinct rare n-grams are
    joined once and go back to its rows, which only name them; texts are read once.
    ``schemas`` are those of the measured and of the finished rows.
    """
    rare_too = rare is not None

    def run(batches):
        measure, common = start()
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, stop, _, _ in w.slices(batch, size=SLICE):
                part = batch.slice(first, stop - first)
                if rare_too:
                    seen = read(w.strings(part, "text").to_pylist())
                    grams, (ends, at, n) = _rare_of(seen, len(part), common)
                    part = measure(part, seen)
                    ends = pa.array(ends, pa.int32())
                    listed = [grams.view(np.int64)] + [None] * (len(part) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array([block] * len(part), pa.int64()),
                         pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                         pa.ListArray.from_arrays(ends, pa.array(n, pa.int32())),
                         pa.array(listed, pa.list_(pa.int64()))],
                        [*part.schema.names, "_block", "_at", "_n", "_grams"])
                    block += 1
                else:
                    yield finish(measure(part, None), lambda column: 0.0)

    if not rare_too:
        return rows.mapInArrow(run, schemas[1])

    def settle(left, right):
        part = left.combine_chunks().to_batches()[0]
        lists = part.column("_at")
        row = np.repeat(np.arange(len(part)), pc.list_value_length(lists))
        at, n = np.asarray(lists.flatten()), np.asarray(part.column("_n").flatten(), float)
        right = right.combine_chunks()
        adds = right.column("adds").combine_chunks()
        which = np.repeat(np.asarray(right.column("_i")), pc.list_value_length(adds))
        column, value = (np.asarray(x) for x in adds.flatten().flatten())
        many = max(at.max(initial=-1), which.max(initial=-1)) + 1

        def sums(wanted):
            here = column == wanted
            each = np.bincount(which[here], weights=value[here], minlength=many)
            return np.bincount(row, weights=n * each[at], minlength=len(part))

        return pa.Table.from_batches([finish(part, sums)])

    measured = scratch.keep(rows.mapInArrow(run, (
        f"{schemas[0]}, _block bigint, _at array<int>, _n array<int>, _grams array<bigint>")), "measured")
    asked = measured.select(F.col("_block").alias("_of"), F.posexplode("_grams").alias("_i", "gram")).join(
        rare, "gram").select("_of", "_i", "adds")
    return measured.drop("_grams").groupBy("_block").cogroup(asked.groupBy("_of")).applyInArrow(
        settle, schemas[1])


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    most: int = MOST_GRAMS,
) -> Models:
    """{language: (model, limits)} from all texts of each language.

    Rows without text or language teach nothing; equal rows count as often as they stand
    there. Every fifth row by the hash of its id and text is kept back, unless its language has
    only a few; the limits of those come from the texts learnt from, and are wider. What reaches
    the driver is at most ``most`` n-grams and a few numbers a language; where there are more of
    them, all stay in the tables of ``Models``.
    Limits are the median cross-entropy of what was kept back, how far above it a long text
    may lie, and what a short text of n characters may have more, times 1 / sqrt(n): three and
    two times what 95 of 100 of the texts kept back stay below, so that odd texts among them do
    not move the limits, and at least 1.0 and 12.0.
    """
    scratch = Scratch(labelled.sparkSession, "language")
    rows = labelled.select(
        F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")
    few = [lang for lang, n in rows.groupBy("lang").count().collect() if n < FEW]
    kept = (F.pmod(F.xxhash64("doc", "text"), F.lit(5)) == 0) & ~F.col("lang").isin(few)
    grams = scratch.keep(gathered(rows.filter(~kept)), "grams")

    def train(table):
        order = np.array(table.column("k"))
        columns = [np.array(table.column(c)) for c in ("key", "n", "context", "suffix", "anchored")]
        each = {}
        for k in range(1, ORDER + 1):
            key, n, context, suffix, anchored = (x[order == k] for x in columns)
            key = key.view(np.uint64)
            at = np.argsort(key)
            each[k] = [key[at], n[at].astype(np.float64), context.view(np.uint64)[at],
                       suffix.view(np.uint64)[at], anchored[at]]
        return pa.table({"lang": table.column("lang").slice(0, 1),
                         "model": pa.array([Model.of_grams(each).dump()], pa.binary())})

    out = Models()
    if grams.count() > most:
        out.tables, models = _tabled(scratch, grams)
    else:
        fitted = grams.groupBy("lang").applyInArrow(train, "lang string, model binary")
        models = {x.lang: Model.load(bytes(x.model)) for x in fitted.orderBy("lang").collect()}
    out.most = most
    limits = _limits(scratch, rows.filter(kept | F.col("lang").isin(few)), models, out.tables, most)
    for lang in few:  # their texts have been learnt from, so others may lie further off
        if lang in limits:
            limits[lang][1] = max(2.0, limits[lang][1])
    for lang, model in models.items():
        out[lang] = model, limits.get(lang, np.array([np.log(ALPHABET), 2.0, 12.0]))
    return out


def _limits(
    scratch: Scratch, kept: DataFrame, models: dict[str, Model], tables: DataFrame | None = None,
    most: int = MOST_GRAMS,
) -> dict[str, np.ndarray]:
    """What the kept texts of each language show under its own model."""
    kept, adds, rare, names = kept.select("lang", "text"), None, None, sorted(models)
    if tables is not None:
        adds, rare = _looked_up(scratch, kept, tables, names, most)
    shared = kept.sparkSession.sparkContext.broadcast(
        ({x: m.dump() for x, m in models.items()}, adds))

    def start():
        held, adds = shared.value
        held = {x: Model.load(data) for x, data in held.items()}

        def measure(part, _):
            langs = np.array(part.column("lang").to_pylist(), object)
            texts = w.strings(part, "text").to_pylist()
            size, own = np.zeros(len(part)), np.zeros(len(part))
            for lang in sorted(set(langs) & held.keys()):
                at = np.flatnonzero(langs == lang)
                size[at], each = entropies([held[lang]], [texts[i] for i in at], adds, [lang])
                own[at] = each[:, 0]
            return pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array(size), pa.array(own)], ["lang", "size", "own"])

        return measure, adds

    def finish(part, sums):
        langs = np.array(part.column("lang").to_pylist(), object)
        size, own = np.asarray(part.column("size")), np.array(part.column("own"))
        for lang in sorted(set(langs) & set(names)):
            more = np.broadcast_to(sums(names.index(lang)), len(part))
            own = np.where(langs == lang, own - more / np.maximum(size, 1), own)
        return pa.RecordBatch.from_arrays(
            [part.column("lang"), pa.array(size), pa.array(own)], ["lang", "size", "own"])

    schema = "lang string, size double, own double"
    seen = scratch.keep(_scored(
        scratch, kept, start, finish, (schema, schema), rare).filter("size > 0"), "kept")
    if rare is not None:
        scratch.drop("measured", "rare")
    middle = {x.lang: x.middle for x in seen.groupBy("lang").agg(
        F.percentile_approx("own", 0.5, 10_000).alias("middle")).collect()}
    if not middle:
        return {}
    above = F.col("own")
    for lang, value in middle.items():
        above = F.when(F.col("lang") == lang, F.col("own") - value).otherwise(above)
    long = F.col("size") >= 200
    far = seen.groupBy("lang").agg(
        F.percentile_approx(F.when(long, above), 0.95, 10_000).alias("long"),
        F.percentile_approx(F.when(~long, above * F.sqrt("size")), 0.95, 10_000).alias("short"))
    return {x.lang: np.array([middle[x.lang], max(1.0, 3 * (x.long or 0.0)), max(12.0, 2 * (x.short or 0.0))])
            for x in far.collect()}


def identify(
    docs: DataFrame, models: Models | dict[str, tuple[Model, np.ndarray]], id_col: str = "doc_id",
    text_col: str = "text", others: list[Column] = (), with_text: bool = False,
) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected, *others[, text]) of each row of ``docs``.

    ``lang_pred`` is the language of lowest cross-entropy, ties to the first in name order,
    and ``und`` for null texts, texts without a letter, or without any model. ``score`` is
    the language's share of exp(-entropy * min(characters, 40)). ``rejected`` marks ``und``
    and texts beyond the language's limits. Only texts are looked at.
    """
    spark = docs.sparkSession
    names = sorted(models)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text"), *others)
    rest = rows.drop("text").schema
    scratch, adds, rare = None, None, None
    if getattr(models, "tables", None) is not None:
        scratch = Scratch(spark, "language")
        adds, rare = _looked_up(scratch, rows, models.tables, names, models.most)
    shared = spark.sparkContext.broadcast(([models[name][0].dump() for name in names], adds))
    limits = np.array([models[name][1] for name in names]).reshape(-1, 3)
    passed = [*(f.name for f in rest.fields[1:]), *["text"] * with_text]

    def start():
        held, adds = shared.value
        held = [Model.load(x) for x in held]

        def measure(part, seen):
            texts = w.strings(part, "text").to_pylist()
            size, each = entropies(held, texts, adds, names, seen)
            ends = pa.array(np.arange(len(part) + 1) * len(held), pa.int32())
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size), pa.ListArray.from_arrays(ends, pa.array(each.ravel())),
                 *(part.column(x) for x in passed)], ["doc_id", "_size", "_each", *passed])

        return measure, adds

    def finish(part, sums):
        size = np.asarray(part.column("_size"))
        each = np.array(part.column("_each").flatten()).reshape(len(part), len(names))
        for i in range(len(names)):
            each[:, i] -= sums(i) / np.maximum(size, 1)
        known = (size > 0) & bool(names)
        if names:
            best = each.argmin(axis=1)
            low = each[np.arange(len(part)), best]
            odds = np.exp((low[:, None] - each) * np.minimum(size, EVIDENCE)[:, None])
            score = np.where(known, 1 / odds.sum(axis=1), 0.0)
            far = limits[best, 0] + limits[best, 1] + limits[best, 2] / np.sqrt(np.maximum(size, 1))
            rejected = ~known | (low > far)
        else:
            best, low = np.zeros(len(part), int), np.zeros(len(part))
            score, rejected = np.zeros(len(part)), np.ones(len(part), bool)
        pred = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(low),
             pa.array(rejected), *(part.column(x) for x in passed)],
            ["doc_id", "lang_pred", "score", "entropy", "rejected", *passed])

    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rest.fields[1:])
    more += ", text string" * with_text
    return _scored(scratch, rows, start, finish, (
        f"doc_id bigint, _size double, _each array<double>{more}",
        f"doc_id bigint, lang_pred string, score double, entropy double, rejected boolean{more}"), rare)
