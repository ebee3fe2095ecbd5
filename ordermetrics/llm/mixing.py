"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent between 0 (all
sources alike) and 1 (as they are). The exponent is bisected so that the weights reach a
target entropy without repeating any source too often. A source's budget is met by whole
passes over its documents and a last pass over as many as fit. Documents are hashed to
blocks, and each pass takes the blocks in an order of its own; only the block in which the
budget ends is looked at document by document.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ordermetrics.llm import words as w
from ordermetrics.llm.scratch import Scratch

# Share of the largest possible entropy, log(number of sources), that weights shall reach.
ENTROPY = 0.95
REPEATS = 2.0
# Tokens of a block. Sources of more than its square have blocks of the root of their tokens, so
# that both the blocks of a source and the documents of a block stay few.
BLOCK_TOKENS = 1 << 20
# Sources whose plan is broadcast; the plan of more is joined by a shuffle.
SOURCES = 100_000


def entropy(weights: np.ndarray, counts: np.ndarray | float = 1.0) -> float:
    """Entropy of weights, each of which ``counts`` sources have."""
    logs = np.log(weights, out=np.zeros(len(weights)), where=weights > 0)
    return float(-(counts * weights * logs).sum())


def tempered(
    shares: np.ndarray, exponent: float, counts: np.ndarray | float = 1.0,
) -> np.ndarray:
    """Normalised shares to the power of ``exponent``; a source without tokens stays without."""
    out = np.zeros(len(shares))
    some = shares > 0
    out[some] = shares[some] ** exponent
    return out / (counts * out).sum()


def exponent(
    tokens: np.ndarray, budget: float, target: float = ENTROPY, repeats: float = REPEATS,
    counts: np.ndarray | None = None,
) -> float:
    """The largest exponent that reaches the entropy, raised as far as the repeats demand.

    ``counts`` says how many sources have each number of tokens, one each unless given.

    Entropy falls and the most repeated source's passes fall as the exponent grows. Where
    even exponent 1 repeats too often, the budget asks for it, and 1 is returned.
    """
    counts = np.ones(len(tokens)) if counts is None else counts
    shares = tokens / (counts * tokens).sum()
    goal = target * math.log(max(1, int(counts[tokens > 0].sum())))

    def bisect(ok_low) -> float:
        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if ok_low(middle) else (low, middle)
        return (low + high) / 2

    def passes(x):
        some = tokens > 0
        return float((budget * tempered(shares, x, counts)[some] / tokens[some]).max())

    def spread(x):
        return entropy(tempered(shares, x, counts), counts)

    reach = 1.0 if spread(1.0) >= goal else bisect(lambda x: spread(x) >= goal)
    spare = 0.0 if passes(0.0) <= repeats else bisect(lambda x: passes(x) > repeats)
    return max(reach, spare)


def counted(docs: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, tokens, key): each whole row with its number of words and its source's key."""
    def run(batches):
        for batch in batches:
            rows = batch.column("row")
            texts = pa.RecordBatch.from_arrays([rows.field(text_col)], ["text"])
            for first, stop, data, offsets in w.slices(texts):
                _, _, row = w.spans(data, offsets, w.NOT_SPACE)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, stop - first),
                     pa.array(np.bincount(row, minlength=stop - first))], ["row", "tokens"])

    packed = docs.select(F.struct("*").alias("row"))
    kind = packed.schema["row"].dataType.simpleString()
    found = packed.mapInArrow(run, f"row {kind}, tokens bigint")
    source = F.col("row").getField(source_col).cast("string")
    return found.withColumn("key", F.when(source.isNull(), "").otherwise(
        F.concat(F.lit("="), source)))


def weigh(
    totals: dict[str, int], budget: float | None = None, target: float = ENTROPY,
    repeats: float = REPEATS,
) -> dict[str, float]:
    """{source key: tokens it shall give}; the budget is all tokens unless given."""
    shall = weigh_totals(Counter(totals.values()), budget, target, repeats)
    return {key: shall[totals[key]] for key in sorted(totals)}


def weigh_totals(
    counts: dict[int, int], budget: float | None = None, target: float = ENTROPY,
    repeats: float = REPEATS,
) -> dict[int, float]:
    """{tokens of a source: tokens it shall give}, from how many sources have how many tokens.

    Sources with equally many tokens weigh the same. Different totals are no more than the
    root of twice the corpus's tokens, however many sources there are.
    """
    totals = sorted(counts)
    tokens = np.array(totals, np.float64)
    many = np.array([counts[t] for t in totals], np.float64)
    everything = (many * tokens).sum()
    if not everything:
        return dict.fromkeys(totals, 0.0)
    budget = everything if budget is None else float(budget)
    power = exponent(tokens, budget, target, repeats, many)
    return dict(zip(totals, (budget * tempered(tokens / everything, power, many)).tolist()))


def passes(shall: float, total: int) -> tuple[int, int]:
    """Whole passes over a source and the tokens left for the last one.

    A budget that is a whole number of passes but for rounding has no last one.
    """
    times = shall / total
    if abs(times - round(times)) < 1e-9:
        return round(times), 0
    return int(times), int(shall - int(times) * total)


def mix(
    docs: DataFrame, budget: float | None = None, target: float = ENTROPY,
    repeats: float = REPEATS, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", seed: int = 1,
) -> DataFrame:
    """(row, tokens, pass): rows of ``docs``, once for each pass that takes them.

    Tokens are words between ASCII white space; null and empty texts have none. A null
    source is a source of its own. The last pass takes documents in block order while they
    fit in the source's budget, so a source gives at most its budget and less than one
    document too little. Documents without tokens go along with every whole pass, very long
    ones count whole. Sources without any token give nothing; a corpus without any is returned as it is. Repeated rows
    count each. ``row`` holds all columns, whatever their names. Runs Spark jobs when called.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    # By id and text, so that documents of one id, or of none, are not all in one block.
    tie = F.xxhash64(F.col("row").getField(text_col))
    found = counted(docs, text_col, source_col).withColumns({
        "tie": tie, "order": F.xxhash64(F.col("row").getField(id_col), tie, F.lit(seed))})
    # All is decided on what is known of a document without its text.
    slim = scratch.keep(found.select("key", "tokens", "order", "tie"), "rows")
    sums = scratch.keep(slim.groupBy("key").agg(F.sum("tokens").alias("total")), "sums")
    counts = {x["total"]: x["n"] for x in
              sums.groupBy("total").agg(F.count("*").alias("n")).toLocalIterator()}
    if not any(counts):
        return found.select("row", "tokens", F.lit(0).alias("pass"))
    shall = weigh_totals(counts, budget, target, repeats)
    plan = [(total, -(-total // max(BLOCK_TOKENS, math.isqrt(total))), *passes(shall[total], total))
            for total in sorted(counts) if total]
    plan = scratch.keep(sums.join(spark.createDataFrame(
        plan, "total bigint, blocks bigint, whole int, room bigint"), "total").drop("total"), "plan")
    few = sum(counts.values()) <= SOURCES

    def planned(rows: DataFrame, limits: DataFrame) -> DataFrame:
        joined = rows.join(F.broadcast(limits) if few else limits, "key")
        return joined.withColumn("block", F.pmod("order", "blocks")).withColumns({
            "turn": F.xxhash64("key", "block", "whole", F.lit(seed)),
            "place": F.struct(F.xxhash64("order", "whole").alias("order"), "tie")})

    # The last pass takes blocks in an order of their own, up to the one in which the room ends.
    before = Window.partitionBy("key").orderBy("turn", "block")
    ends = planned(slim, plan).groupBy("key", "turn", "block", "room").agg(
        F.sum("tokens").alias("size")).withColumn("end", F.sum("size").over(before))
    last = ends.filter("end > room").groupBy("key").agg(F.min(F.struct(
        "turn", "block", (F.col("room") - F.col("end") + F.col("size")).alias("left"))).alias("last"))
    limits = scratch.keep(plan.join(last, "key", "left"), "last")
    in_last = (F.col("turn") == F.col("last.turn")) & (F.col("block") == F.col("last.block")) & (
        F.col("last.left") > 0)

    # Within it documents in their order, up to the one that no longer fits; of equal ones some.
    groups = planned(slim, limits).filter(in_last).groupBy("key", "place", "tokens", "last.left").agg(
        F.count("*").alias("copies")).withColumn("end", F.sum(F.col("tokens") * F.col("copies")).over(
            Window.partitionBy("key").orderBy("place")))
    room = F.col("left") - F.col("end") + F.col("tokens") * F.col("copies")
    edge = groups.filter("end > left").groupBy("key").agg(F.min(F.struct(
        "place", F.floor(F.try_divide(room, "tokens")).alias("fit"))).alias("edge"))
    limits = scratch.keep(limits.join(edge, "key", "left"), "limits")

    joined = planned(found, limits)
    inside = F.col("last").isNull() | (
        F.struct("turn", "block") < F.struct("last.turn", "last.block"))
    inside = inside | (in_last & (F.col("place") < F.col("edge.place")))
    times = F.col("whole") + F.coalesce(inside, F.lit(False)).cast("int")
    taken = joined.filter(times > 0).withColumn(
        "pass", F.explode(F.sequence(F.lit(0), times - 1))).select("row", "tokens", "pass")
    if not limits.filter("edge.fit > 0").take(1):
        return taken
    copies = joined.filter(in_last & (F.col("place") == F.col("edge.place"))).withColumn(
        "copy", F.row_number().over(Window.partitionBy("key").orderBy("place"))).filter("copy <= edge.fit")
    return taken.union(copies.select("row", "tokens", F.col("whole").alias("pass")))
