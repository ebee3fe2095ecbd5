"""Spelling variants, main text and importance resampling against brute force."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import TESTDATA
from ordermetrics.llm import blocks, queries, resampling, spelling
from ordermetrics.llm.scratch import Scratch

SF = TESTDATA / "sf0.01"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_importance_resampling"])
def test_query_equals_sql(spark, db, name):
    frame = queries.query_catalog()[name](spark, str(SF))
    expected = db.sql(queries.oracle_catalog()[name])
    columns = sorted(expected.columns)
    assert sorted(frame.columns) == columns
    want = expected.select(*columns).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in frame.select(*columns).collect())


# --- spelling variants -------------------------------------------------------------

def slipped(doc, run):
    h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1:] if h % 199 == 0 else run


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute_variants(rows):
    counts = Counter(slipped(doc, run) for doc, text in rows
                     for run in re.findall("[A-Za-zÀ-ÿ]+", text or "") for run in [lower(run)])
    words = {x: n for x, n in counts.items() if len(x) >= 6 and n >= 5}
    near = {x: [y for y in words if abs(len(x) - len(y)) < 2 and edits(x, y) == 1] for x in words}
    forms = {}
    for x, others in near.items():
        best = min(others, key=lambda y: (-words[y], y), default=None)
        forms[x] = best if best and words[best] >= 5 * words[x] else None
    out = set()
    for x, n in words.items():
        root = x
        while forms[root]:
            root = forms[root]
        out.add((x, forms[x], root, n, len(near[x]), words.get(forms[x])))
    return out


@pytest.fixture(scope="module")
def spelled():
    draw = np.random.default_rng(11)
    letters = list("abcdeÀéß÷z")
    base = ["".join(draw.choice(letters, draw.integers(5, 9))) for _ in range(60)]
    rows = [(None, None), (1, ""), (2, " 12 ? \n"), (3, "İstanbul KELVINK ÀÉß Straße " * 9)]
    for i in range(160):
        words = []
        for _ in range(40):
            word = base[draw.integers(0, len(base))]
            if draw.random() < 0.3:
                at = draw.integers(0, len(word))
                word = word[:at] + draw.choice(letters + [""]) + word[at + draw.integers(0, 2):]
            words.append(word.upper() if draw.random() < 0.1 and word.isascii() else word)
        rows.append((None if i % 40 == 7 else i % 50, " ".join(words)))
    rows += [(7, "chained " * 6 + "chainedd " * 30 + "chaineddd " * 150 + "chaineddde " * 5)]
    rows += [(8, "equalsa " * 25 + "equalsb " * 25 + "equals " * 5)] * 2
    return rows + [(9, "wordlike " * 40_000 + "wordlikes " * 5)]


def test_variants(spark, spelled):
    frame = spark.createDataFrame(
        [(i, t, 1, "w") for i, t in spelled], "doc_id bigint, text string, n int, word string")
    expected = brute_variants(spelled)
    found = [tuple(r) for r in spelling.variants(frame).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    assert any(root not in (word, form) for word, form, root, *_ in expected)
    # Crowded reduced words take larger alphabets, down to the letters, and lose nothing.
    crowded = [tuple(r) for r in spelling.variants(frame, crowd=1).collect()]
    assert sorted(map(str, crowded)) == sorted(map(str, found))
    assert spelling.variants(frame.filter("false")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "a b c")], "doc_id int, text string")).count() == 0


def test_neighbourhoods_meet(spark):
    """Reduced words of words one edit apart are at most one edit apart, in every alphabet."""
    words = [("abcdef",), ("abcdef" + "é",), ("bcdefg",), ("acdefg",), ("Àbcdef",)]
    frame = spark.createDataFrame(words, "word string").selectExpr("word", "CAST(1 AS BIGINT) AS n")
    found = spelling.near_words(Scratch(spark, "test"), frame, crowd=0)
    pairs = {tuple(sorted((r.word, r.other))) for r in found.collect()}
    assert pairs == {tuple(sorted((a, b))) for (a,) in words for (b,) in words if edits(a, b) == 1}


# --- main text ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def tree(spark):
    return blocks.fit(spark)


def article(page):
    body = re.sub("</?(p|h1|br)>", " ", re.search("<article>(.*?)</article>", page, re.S)[1])
    return " ".join(html.unescape(re.sub("<[^>]*>", "", body)).split())


def test_pages_give_their_article(spark, db):
    found = queries.op12_html_extraction(spark, str(SF)).collect()
    pages = {i: (u, h) for i, u, h in db.sql("SELECT page_id, url, html FROM pages").fetchall()}
    assert len(found) == len(pages)
    for row in found:
        url, page = pages[row.page_id]
        assert row.text == article(page) and row.url == url and row.n_chars == len(row.text)


PAGE = """<html><body class="with-sidebar"><header><a href=/>Home</a> Some site</header>
<nav><a>a</a> <a>b</a></nav><div id="cookie-banner">We use cookies to make this better for you</div>
<main><article><h1>Title &amp; all</h1><p>First <b>para</b>graph with a <a href="x>y">link</a>
and  more.<p>Ok.</p><aside>Beside the text</aside><form><label>Mail</label><button>Go</button></form>
<script>if (a < b) { write("</p>") }</script><!-- <p>no</p> --><p>Fish<br>and&nbsp;chips</p>
<ul><li>one<li>two</ul><p hidden>unseen</p></article><section class="comments"><p>I liked it very much
and would read more of this kind every day of the week if I could.</p></section></main>
<aside class="sideBar"><ul><li><a>x</a></ul></aside><footer>Copyright</footer>"""


def test_main_text(tree):
    say = blocks.main_text
    assert say(PAGE, tree) == (
        "Title & all First paragraph with a link and more. Ok. Fish and chips one two")
    assert say(None, tree) == say("", tree) == say("<p> </p>", tree) == ""
    assert say("just text", tree) == "just text"
    assert say("1 < 2 &lt;b&gt; &amp;lt;", tree) == "1 < 2 <b> &lt;"
    plain = ("<div><a>Home</a> | <a>About</a></div><h1>The title</h1><p>" + "word " * 40 + "</p><p>Short.</p><p>"
             + "more " * 50 + "</p><div><a>one</a> <a>two</a></div><div>All rights reserved</div>")
    assert say(plain, tree).split() == ["The", "title", *["word"] * 40, "Short.", *["more"] * 50]


@pytest.mark.parametrize("page", [
    "<a b='" * 50_000, "<" * 200_000, "<div>" * 100_000 + "</section>" * 100_000, "<!--" * 100_000,
    "<script>x", "</p></div>", "<p", "&#xD800;&#0;&#1114112;&bogus", "<article>" + "&amp;" * 500_000])
def test_broken_markup_is_read(tree, page):
    blocks.main_text(page, tree).encode()


def test_tree_fits_its_table(tree):
    rows, labels = blocks.labelled()
    assert (tree(rows) == (labels > 0.5)).mean() > 0.97


def test_extract_keeps_rows(spark, tree):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (None, None, None, 2), (2, "v", "", 3),
            (3, "w", "<article>" + "<p>many words here</p>" * 100_000, 4)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string, n_chars int")
    found = blocks.extract(frame, tree=tree).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in found) == [
        ("1", 76), ("1", 76), ("2", 0), ("3", 1_599_999), ("None", 0)]
    assert blocks.extract(frame.filter("false"), tree=tree).count() == 0


# --- importance resampling ---------------------------------------------------------

def brute_resample(rows, target):
    def parts(text):
        x = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        return len(x), [zlib.crc32(f.encode()) % 10000 for f in x + [f"{a} {b}" for a, b in zip(x, x[1:])]]

    found = [parts(t) for _, t in rows]
    s, t = Counter(), Counter()
    for _, features in found:
        s.update(features)
    for text in target:
        t.update(parts(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
            for b in range(10000)]
    out = []
    for (doc, _), (n, features) in zip(rows, found):
        weight = sum(gain[b] for b in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(features), weight, score, None, n])
    drawn = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(drawn[:25 * len(drawn) // 100], 1):
        row[4] = place
    return sorted(str(tuple(r[:5])) for r in out)


def test_resample(spark):
    draw = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)] + ["über", "東京", "LOUD", "x" * 700, "y" * 70_000]
    rows = [(i, " ".join(draw.choice(words[:-1], draw.integers(0, 60)))) for i in range(200)]
    rows += [(None, None), (-5, ""), (300, "\x00\t ?! "), (301, "one"), (302, words[-1] + " end " * 30)]
    rows += [(7, rows[7][1])] * 9 + [(None, "no id " * 12), (303, "a-b c " * 3000)]
    target = [rows[3][1], None, "", "w1 w2 LOUD"]
    frame = spark.createDataFrame(
        [(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, rank int, weight int")
    other = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(frame.repartition(5), other)
    assert sorted(str(tuple(r)) for r in found.collect()) == brute_resample(rows, target)
    nothing = resampling.resample(frame, other.filter("false"))
    assert sorted(str(tuple(r)) for r in nothing.collect()) == brute_resample(rows, [])
    assert resampling.resample(frame.filter("false"), other).count() == 0


def test_ranks_of_equal_rows(spark):
    rows = spark.range(4000).selectExpr(
        "CAST(7 AS BIGINT) AS doc_id", "CAST(1 AS BIGINT) AS score").repartition(7)
    found = resampling.ranked(Scratch(spark, "test"), rows).select("rank").collect()
    assert sorted(r.rank for r in found) == list(range(1, 4001))


@pytest.mark.parametrize("length", [0, 1, 255, 256, 1000, 70_001])
def test_shifts_cancel_prefixes(length):
    head, tail = b"some start ", b"q" * length
    shifted = resampling.shifted(np.array([zlib.crc32(head)], np.uint32), np.array([length]))
    assert int(shifted[0]) ^ zlib.crc32(head + tail) == zlib.crc32(tail)
