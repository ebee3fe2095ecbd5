"""The graph index, language models from counts, packing against best fit, licence texts."""

import functools
import re
import time
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from conftest import TESTDATA
from ordermetrics.llm import language, licenses, neighbours, packing

SF = TESTDATA / "sf0.1"


# --- nearest neighbours ------------------------------------------------------------

def test_a_query_meets_little_of_a_shard():
    draw = np.random.default_rng(6)
    n = neighbours.SHARD
    centres = draw.normal(size=(400, 32))
    points = neighbours.lifted(centres[draw.integers(0, 400, n)] + 0.6 * draw.normal(size=(n, 32)))
    edges, entry = neighbours.build(points)
    asked = points[::60].copy()
    asked[:, -1] = 0
    met, _, visited = neighbours.beam_search(points, edges, entry, asked, neighbours.SEARCH_BEAM)
    nearest = np.argsort(-(asked @ points.T), axis=1, kind="stable")[:, :20]
    found = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(nearest, met)])
    assert found >= 0.9 and visited.mean() < 0.1 * n


def test_an_id_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [-1.0, 0.2]), (2, [0.5, 0.0])]
    frame = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, rank int, name string")
    found = neighbours.nearest(frame, frame.filter("vec_id = 0")).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in found] == [(1, 1, 1.0), (2, 2, 0.5), (3, 1, -1.0)]


# --- languages ---------------------------------------------------------------------

OTHERS = {
    "swahili": "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo "
               "yapasa watendeane kindugu. Kila mtu anastahili kuwa na haki zote na uhuru wote ambao umeelezwa "
               "katika taarifa hii bila ubaguzi wowote wa rangi, taifa, wanaume kwa wanawake, dini au siasa.",
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu "
               "järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on "
               "oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin ja vapauksiin.",
    "polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni "
              "rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada "
              "wszystkie prawa i wolności zawarte w niniejszej deklaracji bez względu na różnice rasy.",
    "norwegian": "Alle mennesker er født frie og med samme menneskeverd og menneskerettigheter. De er utstyrt med "
                 "fornuft og samvittighet og bør handle mot hverandre i brorskapets ånd. Enhver har krav på alle "
                 "de rettigheter og friheter som er nevnt i denne erklæring, uten forskjell av noen art.",
    "letters": "qxz vbkw jjq wpfz xkcd zzqv bnmk hgfd plkj wqxz ytrw mnbv cxzl kjhg fdsp oiuy trew qasz xswe "
               "dcvf rtgb nhyu jmki olpq azws xedc rfvt gbyh nujm ikol pqwe rtyu iopa sdfg hjkl zxcv bnmq wert",
}


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(str(SF / "documents.parquet"))


@pytest.fixture(scope="module")
def models(table):
    return language.fit(table.filter("doc_id % 5 > 0"))


def test_held_out_accuracy_and_nothing_clean_rejected(table, models):
    rows = language.identify(table, models, others=[table["lang"]]).filter(
        "doc_id % 5 = 0 AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert sum(r.rejected for r in rows) == 0


def test_other_languages_of_the_script_are_rejected(spark, table, models):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(OTHERS.values())], "doc_id int, text string")
    assert [r.rejected for r in language.identify(frame, models).orderBy("doc_id").collect()] == [True] * 5
    # The limits are steady: another half of the labels decides alike.
    for half in (0, 1):
        others = language.fit(table.filter(f"doc_id % 2 = {half}"))
        found = language.identify(frame, others).orderBy("doc_id").collect()
        assert [r.rejected for r in found] == [True] * 5
        for lang in models:
            assert others[lang][1][:2] == pytest.approx(models[lang][1][:2], rel=0.2, abs=0.2)
            assert 12 <= others[lang][1][2] <= 30


def test_counts_of_tasks_give_the_model_of_all_texts(spark):
    draw = np.random.default_rng(8)
    texts = [" ".join("".join(draw.choice(list("abcdeé"), draw.integers(1, 7))) for _ in range(40))
             for _ in range(60)] + ["", "123", "ab " * 50]
    frame = spark.createDataFrame([("x", t) for t in texts], "lang string, text string").repartition(7)
    grams = language.gathered(frame).toPandas()
    each = {}
    for k, part in grams.groupby("k"):
        part = part.assign(u=part.key.to_numpy().view(np.uint64)).sort_values("u")
        each[k] = [part.u.to_numpy(), part.n.to_numpy().astype(float), part.context.to_numpy().view(np.uint64),
                   part.suffix.to_numpy().view(np.uint64), part.anchored.to_numpy()]
    ours, whole = language.Model.of_grams(each), language.Model.fit(texts)
    assert ours.tables.keys() == whole.tables.keys()
    for name, values in whole.tables.items():
        assert np.allclose(ours.tables[name].astype(float), values.astype(float)), name


def test_bounded_models_keep_parts_of_what_they_keep(spark, table):
    few = language.fit(table.filter("doc_id % 5 > 0"), most=8000)
    assert sum(len(m.tables[f"k{k}"]) for m, _ in few.values() for k in range(1, 5)) <= 8000
    rows = language.identify(table, few, others=[table["lang"]]).filter(
        "doc_id % 5 = 0 AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_n_grams_beyond_the_bound_are_looked_up_not_left_out(spark):
    # Few letters make unknown n-grams and contexts of all orders; "c" words occur once each.
    draw = np.random.default_rng(4)

    def text(letters):
        return " ".join("".join(draw.choice(list(letters), draw.integers(1, 9))) for _ in range(30))

    rows = [(i, text(["abcdeé", "cdefgİß"][i % 2]), f"l{i % 2}", i) for i in range(200)]
    rows += [(200 + i, f"Zq{chr(97 + i)}x", "rare", i) for i in range(20)]
    rows += rows[:7] + [(300, None, "l0", 1), (301, "", "l1", 1), (302, "12 3", "l0", 1), (None, "abc", None, 1)]
    odd = [(400 + i, t, None, 1) for i, t in enumerate(
        ["zqax", "hello abc", "жук", "a", "b" * 5000, "ab " * 3000, text("abcdefgz"), "zqzq x" * 9])]
    columns = "doc_id int, text string, lang string, score int"
    frame = spark.createDataFrame(rows, columns).repartition(5)
    asked = spark.createDataFrame(rows + odd, columns).repartition(3)
    whole, tabled = language.fit(frame), language.fit(frame, most=100)
    assert whole.tables is None and whole.keys() == tabled.keys() == {"l0", "l1", "rare"}
    held = sum(len(m.tables[f"k{k}"]) for m, _ in whole.values() for k in range(1, 5))
    own = tabled.tables.filter("at = 0 OR at % 2 = 1")
    assert held == own.count() == own.select("at", "key", "lang").distinct().count() > 1000
    for lang, (_, limits) in whole.items():
        assert tabled[lang][1] == pytest.approx(limits)
    order = ["doc_id", "text"]
    found = []
    for models, most in ((whole, None), (tabled, 0), (tabled, 100), (tabled, 1_000_000)):
        if most is not None:  # none, some or all of what is looked up is broadcast
            models.most = most
        found.append(language.identify(
            asked, models, others=[asked["lang"], asked["score"].alias("n")], with_text=True
        ).orderBy(*order).collect())
        assert len(found[-1]) == len(rows) + len(odd)
    for a, b in ((a, b) for each in found[1:] for a, b in zip(found[0], each)):
        assert (a.doc_id, a.text, a.lang, a.n, a.lang_pred, a.rejected) == (
            b.doc_id, b.text, b.lang, b.n, b.lang_pred, b.rejected)
        assert (b.score, b.entropy) == pytest.approx((a.score, a.entropy), rel=1e-9, abs=1e-12)


def test_the_pipeline_accepts_the_same_rows_beyond_the_bound(spark, monkeypatch):
    draw = np.random.default_rng(9)
    letters = "abcdefgh", "efghijkl"
    words = [["".join(draw.choice(list(x), draw.integers(3, 8))) for _ in range(25)] for x in letters]
    rows = []
    for i in range(300):  # each with words that stand nowhere else
        own = ["".join(draw.choice(list(letters[i % 2]), 5)) for _ in range(3)]
        rows.append((i, " ".join([*draw.choice(words[i % 2], 60), *own]), f"l{i % 2}", "s", 1))
    for i in range(40):  # the letters of both languages, in other orders
        shuffled = ["".join(draw.permutation(list(x))) for x in draw.choice(words[i % 2], 60)]
        rows.append((300 + i, " ".join(shuffled), None, "s", 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept, limits = [], []
    fit, identify = language.fit, language.identify
    monkeypatch.setattr(language, "identify", lambda docs, models, **more: (
        limits.append({lang: tuple(each) for lang, (_, each) in models.items()}),
        identify(docs, models, **more))[1])
    for most in (language.MOST_GRAMS, 20):
        monkeypatch.setattr(language, "fit", functools.partial(fit, most=most))
        kept.append({r.doc_id for r in corpus_pipeline.identified(spark, docs, "").collect()})
    assert kept == [set(range(300))] * 2
    assert limits[0].keys() == limits[1].keys() == {"l0", "l1"}
    for lang, each in limits[0].items():
        assert limits[1][lang] == pytest.approx(each)


def test_a_rare_n_gram_is_joined_once_a_slice_not_once_a_text(spark, monkeypatch):
    words = [a + b + c for a in "abcdef" for b in "ghijk" for c in "lmnop"]
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(draw.permutation(words)), f"l{i % 2}") for i in range(200)]
    rows += [(200 + i, t, None) for i, t in enumerate(["", "12 3", None, "zzz zzz", rows[0][1]])]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string").coalesce(1)
    models = language.fit(frame, most=100)
    models.most = 0  # all n-grams are rare
    asked = []
    keep = language.Scratch.keep

    def seen(self, table, name):
        kept = keep(self, table, name)
        if name == "measured":
            lists = kept.filter("_grams IS NOT NULL").select("_grams").collect()
            asked.append((kept.count(), [list(r._grams) for r in lists]))
        return kept

    monkeypatch.setattr(language.Scratch, "keep", seen)
    found = {r.doc_id: r for r in language.identify(frame, models).collect()}
    (count, slices), = asked
    assert count == len(rows) == len(found)
    assert len(slices) == 1 and len(set(slices[0])) == len(slices[0]) < 4 * len(words)
    plain = {r.doc_id: r for r in language.identify(frame, language.fit(frame)).collect()}
    for i, r in found.items():
        assert (r.lang_pred, r.rejected) == (plain[i].lang_pred, plain[i].rejected)
        assert (r.score, r.entropy) == pytest.approx((plain[i].score, plain[i].entropy), rel=1e-9)
    assert (found[0].score, found[0].entropy) == (found[204].score, found[204].entropy)


def test_many_languages_and_repeated_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(i, "".join(draw.permutation(list("abcdefghijklmnopqrstuvwxyz"))), f"l{i}", i) for i in range(60)]
    frame = spark.createDataFrame(rows * 2, "doc_id int, text string, lang string, score int")
    found = language.identify(frame, language.fit(frame)).collect()
    assert len(found) == 120 and sum(r.lang_pred == f"l{r.doc_id}" for r in found) >= 110
    by_id = {}
    for r in found:
        assert by_id.setdefault(r.doc_id, (r.lang_pred, r.score)) == (r.lang_pred, r.score)


# --- packing -----------------------------------------------------------------------

def plain_best_fit(lengths, block=None):
    count = 0
    for part in np.array_split(lengths, max(1, len(lengths) // block)) if block else [lengths]:
        packing_, free = np.zeros(len(part), np.int64), []
        packing.best_fit(part, np.argsort(-part, kind="stable"), packing_, free, packing.CAPACITY)
        count += len(free)
    return count


def test_packing_beats_best_fit_alone(spark):
    draw = np.random.default_rng(3)
    lengths = np.clip(draw.gamma(1.6, 190, 9000).astype(int), 1, 1023)
    items = spark.createDataFrame(pd.DataFrame({"doc_id": range(9000), "length": lengths}))
    found = packing.pack(items, block=512).toPandas()
    assert sorted(found.length) == sorted(lengths) and found.doc_id.nunique() == 9000
    for _, part in found.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert part.length.sum() <= packing.CAPACITY
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]]
    least = -(-lengths.sum() // packing.CAPACITY)
    count = found.sequence_id.nunique()
    assert count < plain_best_fit(lengths, 512)
    assert count <= least + 5


# --- licences ----------------------------------------------------------------------

@pytest.mark.parametrize("label", licenses.TEMPLATES)
def test_templates_accept_their_own_wording_only(spark, label):
    def filled(template, optional):
        text = re.sub(r"\[\[|\]\]", "", template) if optional else re.sub(r"\[\[.*?\]\]", "", template)
        return re.sub(r"\{\d+\}", "Someone", text)

    template = licenses.TEMPLATES[label]
    whole, short = filled(template, True), filled(template, False)
    mandatory = short.split()
    broken = " ".join(mandatory[:len(mandatory) // 2] + ["otherwise"] + mandatory[len(mandatory) // 2 + 1:])
    rows = [(1, f"Intro. {whole.upper()} -- end"), (2, f"{short}"), (3, "word " * 30)]
    if "Someone" not in mandatory[len(mandatory) // 2:len(mandatory) // 2 + 1]:
        rows.append((4, broken))
    found = {r.doc_id: r.labels.split(",") for r in licenses.scan(
        spark.createDataFrame(rows, "doc_id int, text string"), phrases={},
        templates={label: template}).collect()}
    assert found[1] == [label] and found[2] == [label] and found[3] == [""]
    assert found.get(4, [""]) == [""]


def test_repeated_first_words_are_quick(spark):
    rows = [(1, "permission " * 100_000), (2, "this " * 100_000), (3, "copyright " * 50_000)]
    start = time.time()
    assert [r.n_words for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).orderBy(
        "doc_id").collect()] == [100_000, 100_000, 50_000]
    assert time.time() - start < 15


# --- mixing ------------------------------------------------------------------------

def test_rows_taken_are_those_of_the_definition(spark, monkeypatch):
    """Blocks, documents and passes recomputed in Python from the hashes of the rows."""
    from pyspark.sql import functions as F

    from ordermetrics.llm import mixing
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 64)
    draw = np.random.default_rng(12)
    rows = [(int(i), " ".join("w" * int(draw.integers(1, 9)) for _ in range(draw.integers(0, 30))), s, 1)
            for i, s in enumerate(draw.choice(["a", "a", "a", "a", "b", "c"], 300).tolist())]
    # A third is copies of one row; ids and sources may be null.
    rows += [(1000, "same text of six words here", "a", 1)] * 160 + [(None, "no id", None, 1)] * 5
    rows += [(None, None, "a", 1), (2000, "", "d", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, pass int").repartition(5)
    for budget in (None, 700.0, 9000.0):
        found = Counter(str((r.row.doc_id, r.row.text, r.row.source, r["pass"]))
                        for r in mixing.mix(frame, budget=budget).collect())
        hashed = frame.withColumns({
            "tie": F.xxhash64("text"),
            "key": F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))}).withColumn(
            "order", F.xxhash64("doc_id", "tie", F.lit(1)))
        total = Counter()
        for r in hashed.collect():
            total[r.key] += len((r.text or "").split())
        shall = mixing.weigh(dict(total), budget)
        plan = [(k, -(-t // 64), *mixing.passes(shall[k], t)) for k, t in total.items() if t]
        each = hashed.join(spark.createDataFrame(plan, "key string, blocks bigint, whole int, room bigint"), "key")
        each = each.withColumn("block", F.pmod("order", "blocks")).withColumns({
            "turn": F.xxhash64("key", "block", "whole", F.lit(1)), "at": F.xxhash64("order", "whole")})
        expected, by_key = Counter(), {}
        for r in each.collect():
            by_key.setdefault(r.key, []).append(r)
        for part in by_key.values():
            blocks = {}
            for r in part:
                blocks.setdefault((r.turn, r.block), []).append(r)
            room, open_ = part[0].room, True
            taken = []
            for _, members in sorted(blocks.items()):
                size = sum(len((r.text or "").split()) for r in members)
                if open_ and size <= room:
                    room -= size
                    taken += members
                elif open_:
                    open_ = False
                    end = 0
                    for r in sorted(members, key=lambda r: (r.at, r.tie)):
                        end += len((r.text or "").split())
                        if room > 0 and end <= room:
                            taken.append(r)
            for number in range(part[0].whole):
                expected.update(str((r.doc_id, r.text, r.source, number)) for r in part)
            expected.update(str((r.doc_id, r.text, r.source, r.whole)) for r in taken)
        assert found == expected and found
