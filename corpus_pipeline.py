"""From documents to packed training sequences: five stages, each written before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordermetrics.llm import jaccard, language, mixing, packing, substrings
from ordermetrics.llm.queries import fold
from ordermetrics.llm.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept; the models learn from their own labels.

    Null and empty texts and texts without a letter have no language and go; repeated rows
    are judged alike. Where no row has a label there is nothing to judge by: all rows stay.
    """
    models = language.fit(docs.filter(fold(5) != 0))
    if not models:
        return docs.select(*COLUMNS)
    found = language.identify(docs, models, others=[
        F.col("lang"), F.col("source"), F.col("n_chars")], with_text=True)
    return found.filter("NOT rejected").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: one with the smallest id, null ids last.

    Rows are told apart by id and text, so rows of one id with different texts are documents
    of their own. Rows without words are near no other, and stay all.
    """
    row = ["_none", "_id", "_hash"]
    known = jaccard.grouped(docs).filter("n_shingles > 0").select(
        F.isnull("doc_id").alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
        F.col("hash").alias("_hash"), "root")
    chosen = known.groupBy("root").agg(F.min(F.struct(*row)).alias("row")).select("row.*")
    has_words = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # Copies become one row before the shuffle.
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    rows = docs.filter(has_words).groupBy(
        F.isnull("doc_id").alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
        F.xxhash64("text").alias("_hash")).agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"),
        F.min(F.struct(*others)).alias("others"))
    kept = rows.join(chosen, row, "left_semi").select("doc_id", "text", "others.*")
    return kept.select(*COLUMNS).union(docs.filter(~has_words).select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too; no row goes.

    Null texts become empty ones. What is left of a text may be empty.
    """
    found = substrings.remove_repeats(docs, others=[F.col("lang"), F.col("source")])
    return found.select(
        "doc_id", F.col("kept").alias("text"), "lang", "source",
        F.char_length("kept").cast("bigint").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight takes them; a null source is one as well."""
    return mixing.mix(docs).select(*(F.col(f"row.{c}") for c in COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in sequences; empty texts are an end token."""
    return packing.pack(packing.pieces(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

# Models, mixing and packing have no SQL; the tests follow the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage but the last is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
