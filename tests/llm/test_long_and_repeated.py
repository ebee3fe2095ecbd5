"""Very long white space, many copies of a row, and pipeline stages on poor tables."""

import time

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from ordermetrics.llm import packing, substrings, warc

RANKS = "byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


@pytest.mark.parametrize("text", [
    "x" + "\n" * 5_000_000 + "x", " " * 5_000_000 + "word", "a" + " \t\n" * 700_000,
    "x" + "\n" * packing.LONG_SPACE + "y <|endoftext|> z", " " * 300_000 + "é"])
def test_ids_of_long_white_space(tokenizer, text):
    assert packing.token_ids(text, RANKS) == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_of_long_white_space(spark):
    frame = spark.createDataFrame([(1, "x" + "\n" * 1_000_000 + "x"), (2, "plain")], "doc_id int, text string")
    found = packing.pieces(frame).collect()
    assert sum(r.length for r in found if r.doc_id == 1) == 500_004


def test_many_copies_of_one_row(spark):
    """Ranges of copies are listed once, so the work grows with the copies and not their square."""
    text = " ".join(f"w{i % 977}x{i}" for i in range(600))
    rows = spark.range(20_000).selectExpr("7 AS doc_id", f"'{text}' AS text").unionByName(
        spark.createDataFrame([(8, "other " + " ".join(f"v{i}" for i in range(50)))], "doc_id int, text string"))
    start = time.time()
    found = substrings.remove_repeats(rows.repartition(8)).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, found)) == [(7, 600, 600, 20_000), (8, 51, 0, 1)]
    assert time.time() - start < 120


@pytest.fixture(scope="module")
def poor(spark):
    """Documents without any label: nulls, empty, blank and repeated rows, null ids and sources."""
    draw = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 500, 60)) for _ in range(8)]
    rows = [(i, t, None, "s", len(t)) for i, t in enumerate(texts)]
    rows += [(0, texts[0], None, "s", len(texts[0]))] * 3 + [
        (None, texts[1], None, None, None), (20, None, None, "s", None), (21, "", None, None, 0),
        (22, " \t\n", None, "", 3), (None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_without_labels_no_document_goes(spark, poor):
    kept = corpus_pipeline.identified(spark, poor, "")
    assert kept.columns == corpus_pipeline.COLUMNS and kept.count() == poor.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_poor_and_empty_tables(spark, poor, name, stage):
    columns = None if name == "best_fit_packing" else corpus_pipeline.COLUMNS
    for docs in (poor, poor.filter("false"), poor.filter("text IS NULL"), poor.filter("doc_id = 0")):
        found = stage(spark, docs, "")
        assert columns is None or found.columns == columns
        rows = found.count()
        if name in ("language_id", "substring_dedup"):
            assert rows == docs.count()
        if name == "ngram_jaccard_join":
            # One of each group; rows without words are near no other.
            words = [r.text for r in docs.collect() if r.text and r.text.strip()]
            assert rows == len(set(words)) + docs.count() - len(words)


def test_archive_folder_is_where_spark_resolves_it(spark, tmp_path):
    assert warc.qualified(spark, f"{tmp_path}/x").replace("file://", "file:") == f"file:{tmp_path}/x"
    pages = spark.createDataFrame([(1, "u", "<p>a</p>"), (2, "v", "<p>a</p>")], "page_id int, url string, html string")
    folder, index = warc.archive(pages)
    assert folder.startswith("file:") and warc.read(folder, index).count() == 2
