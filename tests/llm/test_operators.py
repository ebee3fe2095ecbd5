"""The corpus operators on awkward rows, against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import TESTDATA
from ordermetrics.llm import (
    fingerprints, jaccard, language, licenses, mixing, neighbours, packing, substrings, toxicity,
    warc,
)
from ordermetrics.llm.queries import query_catalog

SF = TESTDATA / "sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def vocabulary(n, salt):
    return [f"w{salt}x{i}" for i in range(n)]


@pytest.fixture(scope="module")
def awkward():
    """(doc_id, text): nulls, empty, blank, equal, near, long, repeated and clashing rows."""
    draw = np.random.default_rng(3)
    base = [f"Wort{i}" for i in draw.integers(0, 400, 200)]
    near = base.copy()
    near[70] = "anders"
    passage = " ".join(vocabulary(60, 1))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "One Two"), (6, "one  two\n"),
        (7, " ".join(base)), (8, " ".join(near)), (9, " ".join(base)), (9, " ".join(base)),
        (10, "zu beginn " + passage + " am ende"), (11, "ganz anders " + passage + " fertig"),
        (12, "a " * 90), (13, "a b " * 60), (14, "über straße ñandú 東京 " * 30),
        (None, "row without id"), (16, " ".join(f"t{i}" for i in draw.integers(0, 10**6, 4000))),
        (17, "Licensed under the Apache License, Version 2.0. Released under the MIT License."),
        (18, "GNU general public license, twice: gnu GENERAL public license; CC BY-SA 4.0"),
        (19, "q" * 5000),
    ]


@pytest.fixture(scope="module")
def docs(spark, awkward):
    """With columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1, 2) for i, t in awkward]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, source string, score int, hash int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def removed(rows, window=35):
    words = [re.findall(SPACE, t or "") for _, t in rows]
    seen = Counter(tuple(x[i:i + window]) for x in words for i in range(len(x) - window + 1))
    out = []
    for (doc, _), x in zip(rows, words):
        gone = set()
        for i in range(len(x) - window + 1):
            if seen[tuple(x[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(word for i, word in enumerate(x) if i not in gone)
        out.append((doc, len(x), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_repeats(docs, empty, awkward):
    found = substrings.digest(substrings.remove_repeats(docs)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, removed(awkward)))
    assert substrings.remove_repeats(empty).count() == 0


def test_every_repeated_window_shares_a_pick():
    draw = np.random.default_rng(5)
    passage = draw.integers(0, 6, 50)
    for _ in range(40):
        a, b = (np.concatenate([draw.integers(0, 6, draw.integers(0, 30)), passage,
                                draw.integers(0, 6, draw.integers(0, 30))]) for _ in range(2))
        keys = []
        for text in (a, b):
            names = substrings.w.mix(text.astype(np.uint64))
            row, bounds = np.zeros(len(text), int), np.array([0, len(text)])
            key, first, last = substrings.picks(names, row, bounds)
            keys.append({tuple(text[s:s + 35]): k for k, f, e in zip(key, first, last)
                         for s in range(f, e + 1)})
        for window in keys[0].keys() & keys[1].keys():
            assert keys[0][window] == keys[1][window]


def components(rows):
    sets = []
    for _, text in rows:
        x = re.findall(SPACE, lower(text or ""))
        sets.append({tuple(x[i:i + 5]) for i in range(max(1, len(x) - 4))} if x else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                group = [group[j] if g == group[i] else g for g in group]
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == group[i] and rows[k][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None) if sets[i] else doc))
    return out


def test_near_duplicates(docs, empty, awkward):
    found = jaccard.near_duplicates(docs).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, components(awkward)))
    assert jaccard.near_duplicates(empty).count() == 0


def test_sketch_distance_is_a_lower_bound_and_similar_sets_share_a_block():
    draw = np.random.default_rng(9)
    for n in (5, 9, 30, 146, 700):
        for _ in range(30):
            values = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
            swaps = int(draw.integers(0, n // 9 + 1))
            other = np.sort(np.concatenate(
                [values[swaps:], draw.integers(0, 2**63, swaps).astype(np.uint64)]))
            common = len(np.intersect1d(values, other))
            assert jaccard.hamming(jaccard.parity_bits(values).tobytes(),
                                   jaccard.parity_bits(other).tobytes()) <= 2 * (n - common)
            if common < n and common >= 0.8 * (2 * n - common):
                a, b = (set(jaccard.block_keys(x, 0.8)[0].tolist()) for x in (values, other))
                assert a & b


def test_nearest(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(600, 8)).round(2)
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [1.0, None]),
           (None, [1.0] * 8), (1080, [1.0]), (0, x[0].tolist())]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")
    found = neighbours.nearest(frame, frame.filter("vec_id % 20 = 0"), shard=256).toPandas()
    assert sorted(found.query_id.unique()) == list(range(0, 600, 20))
    hits = 0
    for q, part in found.sort_values("rank").groupby("query_id"):
        score = x @ x[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(600), -score))[:20]
        hits += len(set(best) & set(part.vec_id))
        assert np.allclose(part.score, score[part.vec_id]) and list(part["rank"]) == list(range(1, 21))
    assert hits >= 0.9 * 20 * 30
    few = neighbours.nearest(frame.filter("vec_id < 3"), frame.filter("vec_id = 0")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert neighbours.nearest(frame.filter("false"), frame.filter("false")).count() == 0


def test_languages(spark, docs, empty):
    table = spark.read.parquet(str(SF / "documents.parquet"))
    models = language.fit(table.filter("doc_id % 5 > 0"))
    held = language.identify(table, models, others=[table["lang"]]).filter("doc_id % 5 = 0")
    rows = held.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert not any(r.rejected for r in rows)
    odd = language.identify(docs, models).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in odd if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in language.identify(docs, language.fit(
        empty.withColumn("lang", empty["source"]))).collect()} == {"und"}
    gibberish = spark.createDataFrame([(1, "щжцф ъыэю " * 50)], "doc_id bigint, text string")
    assert language.identify(gibberish, models).first().rejected


def test_kneser_ney_sums_to_one():
    model = language.Model.fit(["abra kadabra", "bad cab", "dab"])
    for context in ("", "a", "ab", "br"):
        each = {}
        for c in [*map(chr, range(97, 123)), " ", "é"]:
            padded = np.array([32, *map(ord, context + c)], np.uint64)
            place, depth, keys = language.ngrams(padded, np.array([0, len(padded)]))
            each[c] = float(np.exp(model.scores(place, depth, keys)[-1]))
        others = (language.ALPHABET - 27) * each.pop("é")
        assert sum(each.values()) + others == pytest.approx(1, abs=0.02)


def test_toxicity(spark, docs, empty):
    draw = np.random.default_rng(2)
    plain = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(1200):
        text = list(draw.choice(plain, int(draw.integers(5, 120))))
        if i % 6 == 0:
            text[int(draw.integers(0, len(text)))] = ["vile!", "Awful", "nasty,"][i % 3]
        rows.append((i, " ".join(text), int(i % 6 == 0)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(table.drop("toxic"), table.filter("doc_id < 800").select("doc_id", "toxic"))
    found = toxicity.score(table, model, others=[table["toxic"]]).filter("doc_id >= 800").collect()
    assert sum(r.predicted == r.toxic for r in found) >= 0.97 * len(found)
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 and not r.predicted for r in odd)
    none = toxicity.fit(docs, empty.withColumn("toxic", empty["score"]))
    assert toxicity.score(empty, none).count() == 0


def test_archives(spark):
    rows = [(1, "http://a/ b%20ü", "<p>x</p>"), (2, None, "<p>x</p>"), (2, None, "<p>x</p>"),
            (3, "u", None), (4, "u\r\nX: y", ""), (None, "n", "<p>x</p>"), (5, "v", "é" * 70000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder, index = warc.archive(pages.selectExpr("*", "1 AS file", "2 AS offset"))
    found = warc.read(folder, index).collect()
    best = {"<p>x</p>": 2, "": 4, "é" * 70000: 5}
    want = []
    for page, url, html in rows:
        html = html or ""
        revisit = page != best[html]
        want.append((page, url, len(html.encode()), warc.digest(html.encode()),
                     "revisit" if revisit else "response", best[html] if revisit else None,
                     None if revisit else html))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    some = warc.read(folder, index.filter("page_id = 5")).collect()
    assert [r.page_id for r in some] == [5]
    assert warc.read(*warc.archive(pages.filter("false"))).count() == 0


def test_read_ranges():
    rows = [(0, 10), (10, 5), (20, 5), (1000, 10), (1010, 5000)]
    assert warc.ranges(rows, gap=50, most=100) == [[0, 1, 2], [3], [4]]


def test_fingerprints(docs, empty, awkward):
    rows = sorted(((d, t or "") for d, t in awkward), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for size in (4, 100):
        found = fingerprints.compare_neighbours(docs, rows=size).collect()
        want = []
        for i, (doc, text) in enumerate(rows):
            after = rows[(i + 1) % len(rows)][1]
            changed = fingerprints.edited(text, after)
            own, new, other = map(fingerprints.chunks, (text, changed, after))
            want.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(),
                         fingerprints.dump(own), fingerprints.dump(new),
                         fingerprints.likeness(own, new), fingerprints.likeness(own, other)))
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert fingerprints.compare_neighbours(empty).count() == 0


def test_chunks_cover_a_text_and_resist_shifts():
    draw = np.random.default_rng(4)
    text = " ".join(map(str, draw.integers(0, 10**6, 3000)))
    own = fingerprints.chunks(text)
    assert sum(own.values()) == len(text)
    assert fingerprints.likeness(own, fingerprints.chunks("inserted " + text)) > 0.98


def test_licences(docs, empty, awkward):
    found = licenses.scan(docs).collect()
    want = []
    for doc, text in awkward:
        x = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        base = [(i, label) for phrase, label in licenses.PHRASES.items()
                for i in range(len(x)) if x[i:i + len(phrase.split())] == phrase.split()]
        want.append((doc, len(x), len(base), min((i for i, _ in base), default=None),
                     max((i for i, _ in base), default=None),
                     ",".join(sorted({label for _, label in base}))))
    assert sorted(str(tuple(r)[:6]) for r in found) == sorted(map(str, want))
    labels = {r.doc_id: r.labels for r in found}
    assert labels[17] == "apache,apache-notice,mit,mit-notice" and labels[4] == ""
    assert licenses.scan(empty).count() == 0


def test_templates():
    automaton = licenses.compile_template("a [[b [[c]]]] {2} d")
    for text, end in (("a x d", 3), ("a x y d", 4), ("a b x d", 4), ("a b c x y d", 6),
                      ("a d", -1), ("a x y z d", -1), ("b x d", -1)):
        assert licenses.accepted(automaton, text.split(), 0) == end
    with pytest.raises(ValueError):
        licenses.compile_template("a [[b")


def test_whole_licence_texts(spark):
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
    texts = ["Copyright (c) 2020 X\n" + mit + "\nand more", mit.replace("THE AUTHORS OR", "ACME"),
             mit.replace("without restriction", "without much restriction"),
             mit.replace("WITHOUT WARRANTY", "WITH WARRANTY"), mit[:400]]
    for name in ("bsd-2-clause-text", "bsd-3-clause-text", "isc-text"):
        text = re.sub(r"\[\[|\]\]", "", licenses.TEMPLATES[name]).replace("{12}", "The Holder")
        texts += [text, text.replace("warranties", "promises")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [x for x in r.labels.split(",") if x.endswith("-text")]
             for r in licenses.scan(docs).collect()}
    assert [found[i] for i in range(len(texts))] == [
        ["mit-text"], ["mit-text"], [], [], [], ["bsd-2-clause-text"], [],
        ["bsd-3-clause-text"], [], ["isc-text"], []]


def packed_well(rows, capacity):
    for _, part in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert part.length.sum() <= capacity
        assert list(part.offset) == list(part.length.cumsum() - part.length)


def test_packing(docs, empty, awkward):
    found = packing.pack(packing.pieces(docs)).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = []
    for doc, text in awkward:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                 for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    rows = [(None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
            for r in found.itertuples()]
    assert sorted(map(str, rows)) == sorted(map(str, want))
    packed_well(found, 1024)
    assert packing.pack(packing.pieces(empty)).count() == 0


def test_added_token_inside_a_text(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"x  {end}\n\n {end}don't", f"<|{end}|>", "<|endoftext|",
             "<|ENDOFTEXT|>", f"ü{end}東京", f"word {end} " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = packing.pieces(docs, with_ids=True).toPandas()
    for doc, own in found.sort_values("piece").groupby("doc_id"):
        ids = tokenizer.encode(texts[doc], add_special_tokens=False).ids + [2]
        assert np.concatenate(list(own.ids)).tolist() == ids
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        assert own.start.tolist() == cuts[:-1] and own.length.tolist() == np.diff(cuts).tolist()
        assert own.ids_crc32.tolist() == [
            zlib.crc32(np.array(ids[a:b], "<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]


def test_packing_needs_few_sequences(spark):
    sizes = np.random.default_rng(8).integers(1, 700, 3000)
    items = spark.createDataFrame(pd.DataFrame({"id": range(3000), "length": sizes}))
    found = packing.pack(items, block=1000).toPandas()
    packed_well(found, 1024)
    assert sorted(found.id) == list(range(3000))
    assert found.sequence_id.nunique() <= -(-sizes.sum() // 1024) * 1.02 + 3


def test_crossover_keeps_every_piece():
    draw = np.random.default_rng(6)
    sizes = draw.integers(1, 600, 300)
    parents = []
    for _ in range(2):
        packing_ = np.zeros(300, np.int64)
        packing.best_fit(sizes, draw.permutation(300), packing_, [], 1024)
        parents.append(packing_)
    child = packing.crossover(sizes, *parents, 1024, draw)
    assert (child >= 0).all() and np.bincount(child, weights=sizes).max() <= 1024


def test_mixing(spark, empty):
    rows = [(i, "w " * (1 + i % 7), None if i % 50 == 0 else "big" if i % 3 else "small", i)
            for i in range(600)] + [(900, None, "big", 0), (901, "", "mute", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, key int")
    found = mixing.mix(docs).select("row.doc_id", "row.source", "tokens", "pass").toPandas()
    totals = Counter()
    for _, text, source, _ in rows:
        totals["" if source is None else "=" + source] += len((text or "").split())
    shall = mixing.weigh(totals)
    assert sum(shall.values()) == pytest.approx(sum(totals.values()))
    for key, goal in shall.items():
        own = found[found.source.isna()] if not key else found[found.source == key[1:]]
        assert goal - 7 <= own.tokens.sum() <= goal + 1e-6 or not goal
        passes = own.groupby("doc_id").size()
        assert passes.empty or passes.max() - passes.min() <= 1
    assert not found[["doc_id", "pass"]].duplicated().any()
    assert mixing.mix(empty).count() == 0


def test_balanced_sources_give_every_row_once(spark):
    draw = np.random.default_rng(9)
    for sizes in draw.integers(9_000, 11_000, (300, 4)).tolist():
        shall = mixing.weigh(dict(zip("abcd", sizes)))
        assert [mixing.passes(shall[k], n) for k, n in zip("abcd", sizes)] == [(1, 0)] * 4
    assert mixing.passes(25.0, 10) == (2, 5) and mixing.passes(9.5, 10) == (0, 9)

    def short(sizes):
        """Whether rounding leaves a source of these sizes below its total."""
        shall = mixing.weigh(dict(zip("abcd", sizes)))
        return min(shall[k] - n for k, n in zip("abcd", sizes)) < 0

    sizes = next(x for x in draw.integers(20, 30, (1000, 4)).tolist() if short(x))
    rows = [(4 * i + j, "w" if i < n else "", s) for j, (s, n) in enumerate(zip("abcd", sizes))
            for i in range(n + 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix(docs).select("row.doc_id", "pass").collect()
    assert sorted(tuple(r) for r in found) == sorted((i, 0) for i, _, _ in rows)


def test_mixing_takes_any_number_of_sources(spark, monkeypatch):
    many = mixing.SOURCES + 5
    docs = spark.range(many).selectExpr(
        "id AS doc_id", "repeat('w ', CAST(1 + id % 3 AS INT)) AS text", "'s' || id AS source")
    found = mixing.mix(docs).select("row.doc_id", "pass").toPandas()
    shall = mixing.weigh({f"=s{i}": 1 + i % 3 for i in range(many)})
    want = [mixing.passes(shall[f"=s{i}"], 1 + i % 3)[0] for i in range(many)]
    assert (np.bincount(found.doc_id, minlength=many) >= want).all()
    assert sum(shall.values()) == pytest.approx(sum(1 + i % 3 for i in range(many)))

    rows = [(i, "w " * (1 + i % 7), f"s{i % 11 % 8}") for i in range(700)]
    some = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    broadcast = sorted(map(tuple, mixing.mix(some).select("row.doc_id", "pass").collect()))
    monkeypatch.setattr(mixing, "SOURCES", 3)
    assert sorted(map(tuple, mixing.mix(some).select("row.doc_id", "pass").collect())) == broadcast


def test_exponent_meets_its_targets():
    tokens = np.array([9000.0, 500, 300, 200])
    power = mixing.exponent(tokens, tokens.sum(), target=0.9, repeats=100)
    assert mixing.entropy(mixing.tempered(tokens / 1e4, power)) == pytest.approx(0.9 * np.log(4))
    power = mixing.exponent(tokens, tokens.sum(), target=1.0, repeats=2)
    assert (1e4 * mixing.tempered(tokens / 1e4, power) / tokens).max() == pytest.approx(2)


def test_pipeline(spark):
    table = spark.read.parquet(str(SF / "documents.parquet"))
    kept = [tuple(r) for r in table.select("doc_id", "text").collect()]
    docs = table
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, str(SF)).cache()
        if name != "best_fit_packing":
            assert docs.columns == table.columns
        rows = docs.collect()
        if name == "ngram_jaccard_join":
            want = {d for d, _, c in components([(r.doc_id, r.text) for r in before.collect()])
                    if d == c}
            assert sorted(r.doc_id for r in rows) == sorted(want)
        if name == "substring_dedup":
            texts = [(r.doc_id, r.text) for r in before.collect()]
            assert sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in rows) \
                == sorted((d, x) for d, _, _, x in removed(texts))
        if name == "language_id":
            assert len(rows) == len(kept)
        if name == "best_fit_packing":
            packed_well(docs.toPandas(), 1024)


def test_one_row_of_each_group_whatever_the_ids(spark):
    draw = np.random.default_rng(12)
    a, b, c, d = (" ".join(f"v{i}" for i in draw.integers(0, 10**6, 120)) for _ in range(4))
    near = {x: x + " tail" for x in (a, b, c)}
    rows = [(9, a), (9, b), (5, near[b]), (9, c), (9, c), (None, near[c]), (None, d), (None, d),
            (None, d + " tail"), (None, ""), (8, None), (8, " \t"), (8, None)]
    docs = spark.createDataFrame(
        [(i, t, "en", "web", len(t or "")) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for start in (docs, docs.repartition(5)):
        found = corpus_pipeline.one_of_each_group(spark, start, "")
        assert found.columns == corpus_pipeline.COLUMNS
        kept = Counter((r.doc_id, r.text) for r in found.collect())
        of_d = Counter({k: n for k, n in kept.items() if (k[1] or "").startswith(d)})
        assert sum(of_d.values()) == 1 and next(iter(of_d))[0] is None
        assert kept - of_d == Counter(
            [(9, a), (5, near[b]), (9, c), (None, ""), (8, None), (8, " \t"), (8, None)])


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in query_catalog()] == list(range(1, 14))
