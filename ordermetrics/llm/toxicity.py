"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, word pairs and pairs with one word
between them. FTRL-proximal keeps two numbers for each coordinate, from which follow its own
learning rate and a weight that an L1 penalty holds at exactly zero until the evidence
exceeds it. Shards of a bounded sample are learnt side by side, several rounds each, and
their sparse weights are averaged.
What the sample keeps back sets the scale of the scores. The weights that are not zero are few; they are broadcast, and scoring is one pass over the
texts without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermetrics.llm import words as w
from ordermetrics.llm.sampling import bounded

BITS = 20
# Labelled texts that are learnt from at most, so learning does not grow with the tables.
SAMPLE = 16_000
# More shards learn side by side, each from fewer texts, which costs accuracy; the sample is
# small enough for one task.
SHARDS = 1
ROUNDS = 6
# One part in so many is not learnt from but sets the scale of the scores.
KEPT_BACK = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2.0, 0.5
THRESHOLD = 0.7


def features(data: np.ndarray, offsets: np.ndarray, n_rows: int, bits: int = BITS):
    """(row, feature) of every word, pair and skip pair; not yet distinct."""
    data = w.LOWER[data]
    start, end, row = w.spans(data, offsets, w.ALNUM)
    one = w.mix(w.word_hashes(data, start, end))
    rows, found = [row], [one]
    for apart, salt in ((1, 2), (2, 3)):
        both = row[apart:] == row[:-apart]
        rows.append(row[:-apart][both])
        found.append(w.mix(one[:-apart][both] * np.uint64(3) + one[apart:][both], salt))
    shift = np.uint64(64 - bits)
    return np.concatenate(rows), (np.concatenate(found) >> shift).astype(np.int64)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w_ = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w_)


def learn(examples, z: np.ndarray, n: np.ndarray) -> None:
    """One pass over (features, label); changes z and n in place."""
    for active, label in examples:
        now = weights(z[active], n[active])
        p = 1 / (1 + np.exp(-np.clip(now.sum(), -35, 35)))
        g = p - label
        step = (np.sqrt(n[active] + g * g) - np.sqrt(n[active])) / ALPHA
        z[active] += g - step * now
        n[active] += g * g


# Features that the learning task holds; further texts of the sample are not learnt from.
MOST_FEATURES = 100_000_000


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample: int = SAMPLE, bits: int = BITS,
) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) that are not zero; the last coordinate, 2^bits, is the constant.

    Learns from at most ``sample`` labelled texts, whole ones of any length, and from no more of
    them than have ``MOST_FEATURES`` features together. Rows without a label or an id teach
    nothing; a null text has no features. Labels repeated for a document count each time.
    """
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias(
        "label")).filter("label IS NOT NULL")
    ids = bounded(marks, sample, F.struct("_id", "label"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(ids), "_id").select("text", "label", F.pmod(
        F.xxhash64("_id"), F.lit(SHARDS * KEPT_BACK)).alias("part"), F.xxhash64("_id", "text").alias(
        "turn"))
    size = 1 << bits
    kept = rows.filter(f"part % {KEPT_BACK} = 0").select("text", "label")
    learnt = rows.filter(f"part % {KEPT_BACK} > 0").repartition(
        SHARDS, F.expr(f"part DIV {KEPT_BACK}")).sortWithinPartitions("turn").select("text", "label")

    def train(batches):
        examples, held = [], 0
        for batch in batches:
            for first, stop, data, offsets in w.slices(batch) if held < MOST_FEATURES else ():
                row, found = features(data, offsets, stop - first, bits)
                key = np.unique(row * size + found)
                ends = np.searchsorted(key, np.arange(stop - first + 1) * size)
                found = (key % size).astype(np.int32)
                held += len(found)
                labels_ = batch.column("label").slice(first, stop - first).to_numpy()
                examples += [(np.append(found[a:b], np.int32(size)), label)
                             for a, b, label in zip(ends[:-1], ends[1:], labels_)]
        if examples:
            z, n = np.zeros(size + 1), np.zeros(size + 1)
            for _ in range(ROUNDS):
                learn(examples, z, n)
            found = weights(z, n)
            at = np.flatnonzero(found)
            # Coordinate -1 counts the shards.
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(-1, at)), pa.array(np.append(1.0, found[at]))], ["at", "w"])

    mixed = learnt.mapInArrow(train, "at bigint, w double").groupBy("at").agg(
        F.sum("w").alias("w")).toArrow().sort_by("at")
    found = np.zeros(size + 1)
    if mixed.num_rows:
        at, total = (mixed.column(c).to_numpy() for c in ("at", "w"))
        found[at[1:]] = total[1:] / total[0]
    margins = _margins(kept, found, bits)
    slope, shift = calibrate(*margins)
    found *= slope
    found[size] += shift
    at = np.flatnonzero(found)
    return at, found[at]


def _margins(kept: DataFrame, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(table)
    shared = kept.sparkSession.sparkContext.broadcast((at, table[at]))

    def run(batches):
        dense = _dense(shared.value, bits)
        for batch in batches:
            for first, stop, data, offsets in w.slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sums(dense, data, offsets, stop - first, bits)),
                     batch.column("label").slice(first, stop - first)], ["margin", "label"])

    found = kept.mapInArrow(run, "margin double, label double").toArrow()
    return found.column("margin").to_numpy(), found.column("label").to_numpy()


def _dense(model: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    table = np.zeros((1 << bits) + 1)
    table[model[0]] = model[1]
    return table


def sums(table: np.ndarray, data, offsets, n_rows: int, bits: int = BITS) -> np.ndarray:
    """Sum of the weights of each row's distinct features, and the constant."""
    size = 1 << bits
    row, found = features(data, offsets, n_rows, bits)
    some = table[found] != 0
    key = np.unique(row[some] * size + found[some])
    return np.bincount(key // size, weights=table[key % size], minlength=n_rows) + table[size]


def calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of margins for which the labels of texts kept back are likeliest.

    Labels are smoothed by their counts, so separable margins have a finite answer; without
    both labels margins stay as they are.
    """
    good, bad = (label > 0).sum(), (label <= 0).sum()
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones(len(margin))])
    at = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -35, 35)))
        slope = x @ (p - target) + 1e-3 * (at - [1, 0])
        curve = (x * np.maximum(p * (1 - p), 1e-9)) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 0.0)), float(at[1])


def score(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id",
    text_col: str = "text", bits: int = BITS, threshold: float = THRESHOLD,
    others: list[Column] = (),
) -> DataFrame:
    """(doc_id, score, predicted, *others) of each row; only texts are looked at.

    A null or empty text has the score of no features. One row for each row of ``docs``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text"), *others)
    rest = rows.drop("text").schema

    def run(batches):
        table = _dense(shared.value, bits)
        for batch in batches:
            for first, stop, data, offsets in w.slices(batch):
                total = sums(table, data, offsets, stop - first, bits)
                p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                part = batch.slice(first, stop - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32)),
                     *(part.column(f.name) for f in rest.fields[1:])],
                    ["doc_id", "score", "predicted", *(f.name for f in rest.fields[1:])])

    schema = "doc_id bigint, score double, predicted int"
    for field in rest.fields[1:]:
        schema += f", `{field.name}` {field.dataType.simpleString()}"
    return rows.mapInArrow(run, schema)
