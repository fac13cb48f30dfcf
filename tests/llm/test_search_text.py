"""Lexical search, spelling groups and main text, held against brute force and planted pages."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_rows import PROSE, SPANISH, empty, odd, odd_rows, tables  # noqa: F401

from shelfcast.llm import lexical, main_text, queries, spelling

# --- lexical search ------------------------------------------------------------------------------


def split_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [t for t in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered) if t]


def ranked(docs, items, best=20):
    """Naive scores of all pairs: [(item row, rank, doc_id, score)]."""
    terms = [split_terms(t) for _, t in docs]
    n_docs, total = sum(bool(t) for t in terms), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    out = []
    for k, (_, text) in enumerate(items):
        found = []
        for (doc_id, _), ts in zip(docs, terms):
            if not ts:
                continue
            tf, m = Counter(ts), 100 - 25 + (25 * len(ts) * n_docs) // total
            score = 0
            for t in split_terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(k, r + 1, f[3], -f[0]) for r, f in enumerate(found[:best])]
    return out


ITEMS = [(1, "The river in the village"), (1, "el río y el puente, el puente"), (None, "molino 日本語 mill"), (4, ""), (5, None),
         (6, "the the the one 🙂 Ä"), (7, "zzz qqq")]


def check_search(spark, docs, items, **settings):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(frame, asked, **settings).collect()
    expected = [(items[k][0], rank, doc_id, score) for k, rank, doc_id, score in ranked(docs, items)]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    return got


def test_search_is_the_naive_ranking(spark):
    docs = [(r[0], r[1]) for r in odd_rows()]
    assert check_search(spark, docs, ITEMS)


def test_search_expands_large_classes_by_ascending_id(spark):
    rng = random.Random(3)
    pool = split_terms(PROSE + SPANISH)
    docs = [(i, " ".join(rng.choices(pool, k=rng.choice([5, 40])))) for i in range(200)]
    docs += [(1000 - i, PROSE) for i in range(90)] + [(2000 + i, PROSE.upper() + " Xyz") for i in range(30)]
    docs += [(5, PROSE)] * 3 + [(None, PROSE)]
    rng.shuffle(docs)
    got = check_search(spark, docs, ITEMS)
    assert len({r["doc_id"] for r in got if r["rank"] <= 20}) > 20


def test_search_in_blocks_of_items_and_small_chunks(spark, monkeypatch):
    docs = [(r[0], r[1]) for r in odd_rows()] + [(20 + i, " ".join(PROSE.split()[i:])) for i in range(60)]
    monkeypatch.setattr(lexical, "CELLS", 64)
    check_search(spark, docs, ITEMS, item_rows=2)


def test_scores_beyond_the_doubles_are_exact():
    items = lexical.Items([b"a b", b"a " * 5000])
    weights = np.array([90_000_001, 7], np.int64)
    scorer = lexical.Scorer(items, weights, 20)
    assert not scorer.exact
    pairs, sizes = np.array([[0, 3], [1, 1]]), np.array([2])
    worth = lambda w, tf, m: w * ((10**9 * tf) // (1000 * tf + 12 * m))
    a, b = worth(90_000_001, 3, 80), worth(7, 1, 80)
    assert scorer.scores(pairs, sizes, np.array([80])).tolist() == [[a + b, 5000 * a]]


def test_search_of_nothing(spark, empty, odd):  # noqa: F811
    none = spark.createDataFrame([], "item_id long, text string")
    asked = spark.createDataFrame(ITEMS, "item_id long, text string")
    for docs, items in ((empty, asked), (odd, none), (empty, none)):
        found = lexical.search(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_search_query_matches_sql(spark, odd, tables):  # noqa: F811
    asked = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, score string")
    folder = tables(documents=odd, benchmark=asked)
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    names = ["item_id", "rank", "doc_id", "score"]
    got = queries.QUERIES["op11_lexical_search"](spark, folder).select(names).collect()
    expected = duck.sql(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op11_lexical_search']})").fetchall()
    assert Counter(map(tuple, got)) == Counter(expected)


# --- spelling ------------------------------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(docs):
    """Naive result: {word: (form, root, n, n_near, form_n)}."""
    counts = Counter()
    for doc_id, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    links = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for w, others in links.items():
        top = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = top if top and words[top] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, words[w], len(links[w]), words[forms[w]] if forms[w] else None)
    return out


def variants(seed, count=70):
    """Texts full of words that are one or two edits apart, with a chain of ever more frequent forms."""
    rng = random.Random(seed)
    letters = "abcdeéàÿßoz"
    base = ["".join(rng.choices(letters, k=rng.randint(4, 11))) for _ in range(12)]
    pool = list(base)
    for _ in range(260):
        w = list(rng.choice(pool))
        kind, at = rng.randrange(3), rng.randrange(len(w))
        if kind == 0:
            w[at] = rng.choice(letters)
        elif kind == 1:
            w.insert(at, rng.choice(letters))
        elif len(w) > 4:
            del w[at]
        pool.append("".join(w))
    texts = []
    for i in range(count):
        picked = rng.choices(pool, k=60) + ["aaaaaa"] * 8 + ["aaaaab"] * 4 + ["aaaabb"] * 2 + ["aaabbb"]
        rng.shuffle(picked)
        texts.append((None if i == 3 else i, rng.choice([" ", "-", "1", "\n"]).join(w.title() if rng.random() < 0.3 else w for w in picked)))
    return texts


def spelled(frame):
    rows = frame.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_is_the_naive_grouping(spark, seed):
    docs = variants(seed) + [(5, "aaaaaa " * 4)] * 2 + [(r[0], r[1]) for r in odd_rows()]
    got = spelled(spelling.group(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)))
    expected = grouped(docs)
    assert got == expected
    assert sum(v[3] > 3 for v in expected.values()) > 20 and any(v[0] and v[1] != v[0] for v in expected.values())


def test_spelling_query_matches_sql(spark, tables):  # noqa: F811
    rows = [(d, t, "x") for d, t in variants(3) + [(5, "aaaaaa " * 4)] * 2 + [(7, None), (None, ""), (8, "ÀÿÉ aaaaaa×÷b")]]
    folder = tables(documents=spark.createDataFrame(rows, "doc_id long, text string, word string"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    got = queries.QUERIES["op12_spelling_groups"](spark, folder).select(names).collect()
    expected = duck.sql(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op12_spelling_groups']})").fetchall()
    assert Counter(map(tuple, got)) == Counter(expected) and len(got) > 50


def test_tiles_and_buckets_do_not_change_the_result(spark):
    docs = spark.createDataFrame(variants(4), "doc_id long, text string")
    found = spelling.words(docs).persist()
    plain = {tuple(r) for r in spelling.near(found).collect()}
    assert plain == {tuple(r) for r in spelling.near(found, tile=3, bucket_bytes=4000).collect()}
    assert len(plain) > 50


def test_spelling_of_whole_table(spark, data_dir):
    docs = [tuple(r) for r in queries.table(spark, data_dir, "documents").select("doc_id", "text").collect()]
    got = spelled(queries.QUERIES["op12_spelling_groups"](spark, data_dir))
    counts = {w: v for w, v in grouped_words(docs).items()}
    assert {w: v[2] for w, v in got.items()} == counts
    rng = random.Random(0)
    for w in rng.sample(sorted(counts), 150):
        others = [v for v in counts if near(w, v)]
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        assert got[w][3] == len(others)
        assert got[w][0] == (top if top and counts[top] >= 2 * counts[w] else None)


def grouped_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        counts.update(spelling.damaged_words(doc_id, (text or "").encode()))
    return {w: n for w, n in counts.items() if n >= 3}


def test_spelling_of_odd_tables(spark, empty):  # noqa: F811
    found = spelling.group(empty)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found.count() == 0
    long = "x" * 70_000
    docs = [(i, f"{long} {long}y {'ab' * 9000}") for i in range(4)] + [(9, None), (None, "")]
    got = spelled(spelling.group(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == grouped(docs)


# --- main text -----------------------------------------------------------------------------------

PARAGRAPH = "The river turned north near the old mill and the wind came down from the hills in the evening."
PAGES = {
    "article": (
        f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body><nav><ul><li><a href='/'>Home</a></li>"
        f"</ul></nav><!-- <p>no</p> --><div class='ad'>{PARAGRAPH}</div><article><h1>Old &amp; new</h1><p><b>Short.<br>Line<p>{PARAGRAPH}</p>"
        f"<p>All rights reserved.</p></article><footer>&copy; {PARAGRAPH}</footer></body></html>",
        ["Old & new", "Short. Line", PARAGRAPH, "All rights reserved."],
    ),
    "no article": (
        f"<body><div id=main-menu><a href=a>One</a> <a href=b>Two</a></div><div><h2>Title</h2><p>{PARAGRAPH}<p>Short one.</div>"
        f"<ul><li><a href=c>{PARAGRAPH}</a></li><li><a href=d>Related thing</a></li></ul><div class='cookie-notice'>{PARAGRAPH}</div>",
        ["Title", PARAGRAPH, "Short one."],
    ),
    "comments and forms": (
        f"<main><p>{PARAGRAPH}</p><form><p>{PARAGRAPH}</p></form><section id='comments'><div class=comment>{PARAGRAPH}</div></section>"
        f"<aside>{PARAGRAPH}</aside></main>",
        [PARAGRAPH],
    ),
    "only short": ("<article><h1>Hi</h1><p>There.</p></article><nav>Menu</nav>", ["Hi", "There."]),
    "short beside links": (
        f"<main><p>{PARAGRAPH}</p><p>Kept.</p><p>Read</p><p>also</p><p><a href=x>{PARAGRAPH}</a></p></main>",
        [PARAGRAPH, "Kept.", "Read"],
    ),
    "broken off": (f"<article><p>{PARAGRAPH}</p><p>a < b &unknown; &#233;&nbsp;x</p><p class='", [PARAGRAPH, "a < b &unknown; é x"]),
    "open comment": (f"<article><p>{PARAGRAPH}</p><!-- lost {PARAGRAPH}", [PARAGRAPH]),
    "inline": (f"<article><p>{PARAGRAPH[:40]}<b>{PARAGRAPH[40:60]}</b><a href=x>{PARAGRAPH[60:]}</a></p></article>", [PARAGRAPH]),
    "nested": (f"<div class=sidebar><div><p>{PARAGRAPH}</div></div><p>{PARAGRAPH}</p></div>", [PARAGRAPH]),
    "quoted tag": (f"<article><p title='a > b' data-x=\"</article>\">{PARAGRAPH}</p></article>", [PARAGRAPH]),
    "no text": ("<html><head><title>T</title></head><body></body></html>", []),
    "spanish": (f"<body><p>{SPANISH}</p><p hidden>{SPANISH}</p><div role=navigation>{SPANISH}</div>", [SPANISH]),
}


@pytest.mark.parametrize("name", PAGES)
def test_planted_pages(name):
    page, expected = PAGES[name]
    assert main_text.main_text(page).split("\n\n") == (expected or [""])


def test_second_pass_takes_the_nearest_decided_label():
    t, f, n = True, False, None
    assert main_text.second_pass([n, f, n, n, t, n], t) == [f, f, f, t, t, t]
    assert main_text.second_pass([f, n, t], f) == [f, t, t]
    assert main_text.second_pass([n, n], f) == [f, f] and main_text.second_pass([], t) == []


def test_pages_are_read_in_linear_time():
    import time

    for piece in ("<", "<!--", "<p ", "<p a='", "</", "<script>", "&", "<div class=ad>", "<a href=x>", "</div>", "<b =   "):
        took = []
        for times in (20_000, 80_000):
            started = time.perf_counter()
            main_text.main_text(piece * times)
            took.append(time.perf_counter() - started)
        assert took[1] < 12 * took[0] + 0.3, piece


def test_main_text_of_odd_tables(spark, empty):  # noqa: F811
    rows = [(1, "u", None, "t", 1), (1, "u", None, "t", 1), (2, None, "", None, None), (None, "u", PAGES["article"][0] * 200, "t", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text string, n_chars long")
    got = main_text.extracted(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = got.collect()
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in got[:3]] == [(1, "", 0), (1, "", 0), (2, "", 0)]
    assert got[3]["text"] == "\n\n".join(PAGES["article"][1] * 200) and got[3]["n_chars"] == len(got[3]["text"])
    assert main_text.extracted(pages.limit(0)).count() == 0


def test_main_text_of_whole_table(spark, data_dir):
    """The generated pages have one article each: its blocks, cut out by a plain search, are the main text."""
    import html

    rows = queries.table(spark, data_dir, "pages").collect()
    got = {r["page_id"]: r for r in queries.QUERIES["op13_main_text"](spark, data_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:h1|p)>", article)]
        assert got[r["page_id"]]["text"].split("\n\n") == [b for b in blocks if b]
        assert got[r["page_id"]]["url"] == r["url"]
