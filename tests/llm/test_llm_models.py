"""Piece encoding, lattice likelihood and language identification."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from llm_rows import PROSE, SPANISH, empty, odd, odd_rows, tables  # noqa: F401
from pyspark.sql import functions as F

from shelfcast.llm import language, lattice, pieces, queries

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(queries.PIECE_MODEL)


PARTS = ["a", " ", "  ", "▁", "\n", "é", "日", "🙂", "\t", "in", "the", "tion", "'", ".", "0", "\x00", "ß", "①"]
PARTS += ["<s>", "<0x41>", "\r\n", " \n ", "aaaa", "\xa0", "ing", ",", "!?", '."', "</s>", "‍", "=", "=="]


def test_pieces_equal_the_library(library, model):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", " " * 1000, "a" * 5000, "ab" * 3000, "=" * 300, "🙂" * 50, PROSE * 20, SPANISH]
    for text in texts:
        raw, decoded = model.encode(text)
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True)
        assert decoded == model.decode(ids) == library.decode(ids)


def test_decoding_any_ids(library, model):
    rng = random.Random(4)
    for _ in range(500):
        ids = [rng.choice([1, 2, rng.randint(3, 258), rng.randint(259, 31999)]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids)


def test_piece_query(spark, odd, empty, tables, library):
    got = queries.QUERIES["op8_sentencepiece"](spark, tables(documents=odd)).collect()
    expected = Counter()
    for doc_id, text, *_ in odd_rows():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected[doc_id, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == expected
    kept = pieces.encoded(odd, queries.PIECE_MODEL)
    assert {"kept", "Row"} <= set(kept.columns) and kept.count() == odd.count()
    assert pieces.encoded(empty, queries.PIECE_MODEL).count() == 0


TOY = (["▁", "▁a", "a", "b", "ab", "▁ab", "c", "bc"], [math.log(p) for p in (0.1, 0.1, 0.15, 0.2, 0.15, 0.1, 0.1, 0.1)], {})


def paths(text, score):
    """Probabilities of all segmentations, one by one."""
    if not text:
        return [([], 1.0)]
    return [
        ([text[:k], *rest], math.exp(score[text[:k]]) * p)
        for k in range(1, len(text) + 1)
        if text[:k] in score
        for rest, p in paths(text[k:], score)
    ]


@pytest.mark.parametrize("word", ["a", "ab", "abc", "abab", "bcabc"])
def test_lattice_sums_all_segmentations(word):
    toy, score = lattice.Lattice(*TOY), dict(zip(TOY[0], TOY[1], strict=True))
    every = paths("▁" + word, score)
    total = sum(p for _, p in every)
    assert toy.log_probability(word) == pytest.approx(math.log(total))
    counts = np.zeros(len(TOY[0]))
    toy.expect(word, counts)
    expected = [sum(p * path.count(piece) for path, p in every) / total for piece in TOY[0]]
    assert counts == pytest.approx(expected)


def test_lattice_spells_unknown_characters_in_bytes():
    vocab = lattice.vocabulary(queries.PIECE_MODEL)
    assert sum(map(math.exp, vocab[1])) == pytest.approx(1.0)
    full = lattice.Lattice(*vocab)
    assert -math.inf < full.log_probability("①x") < full.log_probability("x") < 0


def brute_base(rows):
    tokens = [[*WORD.findall((t or "").encode().lower()), None] for _, t in rows]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i, _ in rows]
    c = Counter(w for ws, is_train in zip(tokens, train, strict=True) if is_train for w in ws)
    total, distinct = sum(c.values()), len(c)
    for (i, _), ws, is_train in zip(rows, tokens, train, strict=True):
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        yield i, not is_train, len(ws), sum(c[w] > 0 for w in ws), total, round(base, 6)


@pytest.mark.parametrize("hot", [0, 20])
def test_lattice_scores(spark, odd, empty, hot):
    docs = odd.select("doc_id", "text", "kept")
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 100))
    got = lattice.score(docs, queries.PIECE_MODEL, hot_words=hot).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert found == Counter(brute_base(rows))
    assert all(r.score < 0 for r in got)
    if hot:
        assert lattice.score(empty, queries.PIECE_MODEL).count() == 0


def brute_texts(rows):
    """log10 probability of each text: every segmentation of every word, by the file's scores, summed up."""
    names, weights, bytes_at = lattice.vocabulary(queries.PIECE_MODEL)
    weight = {p: math.exp(w) for p, w in zip(names, weights, strict=True)}

    def mass(word):
        if not word:
            return 1.0
        out = sum(weight[word[:k]] * mass(word[k:]) for k in range(1, len(word) + 1) if word[:k] in weight)
        if word[0] not in weight:
            out += math.prod(math.exp(weights[bytes_at[b]]) for b in word[0].encode()) * mass(word[1:])
        return out

    words = [[w.decode() for w in WORD.findall((t or "").encode().lower())] for _, t in rows]
    train = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i, _ in rows]
    ends = sum(train)
    end = (ends + 0.5) / (sum(len(ws) for ws, t in zip(words, train, strict=True) if t) + ends + 1)
    return [math.log10(end) + sum(math.log10((1 - end) * mass("▁" + w)) for w in ws) for ws in words]


def test_lattice_scores_whole_texts(spark):
    rng = random.Random(2)
    parts = ["the", "town", "Ñu", "ab", "x①", "日本", "ing", "qzx", "re", "don't", "-"]
    texts = [None, "", " ", *(" ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 9))) for _ in range(60))]
    rows = list(enumerate(texts))
    got = lattice.score(spark.createDataFrame(rows, "doc_id long, text string"), queries.PIECE_MODEL).collect()
    assert [r.score for r in sorted(got, key=lambda r: r.doc_id)] == pytest.approx(brute_texts(rows), rel=1e-9)


def test_lattice_options_learn_from_the_training_words(spark):
    docs = spark.createDataFrame([(i, "qzxqzx town " * 5) for i in range(40)], "doc_id long, text string")
    plain, learned, edges = (
        lattice.score(docs, queries.PIECE_MODEL, **o).agg(F.avg("score")).first()[0]
        for o in ({}, {"iterations": 2}, {"whole_words": True})
    )
    assert plain < learned < 0 and plain < edges < 0


def test_lattice_query_keeps_up_with_the_base_on_held_out_texts(spark, data_dir):
    found = queries.op3_lattice_score(spark, data_dir).where("held_out").select("n_tokens", "base_score", "score").collect()
    assert found and all(r.score is not None and math.isfinite(r.score) and r.score < 0 for r in found)
    tokens, base, score = (sum(r[k] for r in found) for k in range(3))
    assert score / tokens > base / tokens - 2.0


def test_hot_words_are_bounded_by_bytes_too(spark):
    rows = [("a" * 50_000, 0, 90, -1.0, -1.0), ("b", 3, 80, -1.0, -2.0), ("c", 0, 40, -1.0, -2.0), ("d", 1, 1, -1.0, -2.0)]
    scored = spark.createDataFrame(rows, "word string, c long, times long, base double, model double")
    assert set(lattice._hot_words(scored, 10)) == {b"a" * 50_000, b"b", b"c"}
    assert lattice._hot_words(scored, 10, 1000) == {} and len(lattice._hot_words(scored, 2)) == 2


def test_lattice_scores_do_not_depend_on_the_split_of_words(spark, odd):
    runs = [lattice.score(odd, queries.PIECE_MODEL, hot_words=n).collect() for n in (0, 1000)]
    assert [sorted(round(r.score, 6) for r in run) for run in runs][0] == sorted(round(r.score, 6) for r in runs[1])


def test_gru_gradients():
    net = language.ByteGru(3, 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    steps = np.random.default_rng(0).integers(0, 256, (5, 7)).astype(np.uint8).T
    real, labels = np.ones(steps.shape, bool), np.array([0, 1, 2, 1, 0])
    real[5:, 1] = False
    grads, _ = net.gradients(steps, real, labels)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        losses = []
        for move in (1e-3, -2e-3):
            net.p[name][at] += move
            losses.append(net.gradients(steps, real, labels)[1])
        net.p[name][at] += 1e-3
        assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.02, abs=1e-5)


def test_windows_cover_every_byte_once():
    net = language.ByteGru(2)
    texts = [b"x" * n for n in (1, language.SPAN - 1, language.SPAN, language.SPAN + 1, 5 * language.SPAN + 7)]
    assert net.shares(texts).sum(axis=1) == pytest.approx(np.ones(len(texts)))
    together, alone = net.shares(texts), [net.shares([t])[0] for t in texts]
    assert together == pytest.approx(np.array(alone), abs=1e-5)


def naive_shares(net, text):
    """The mean distribution of a text, one byte after the other, in plain loops over each window."""
    h = net.hidden
    p = {k: v.astype(float).tolist() for k, v in net.p.items()}
    sigmoid = lambda a: 1 / (1 + math.exp(-a))
    dot = lambda row, state: sum(a * b for a, b in zip(row, state, strict=True))

    def states(side, window):
        state, out = [0.0] * h, []
        for byte in window:
            x, u = [row[byte] for row in p[f"x{side}"]], [dot(row, state) for row in p[f"u{side}"]]
            reset = [sigmoid(x[k] + u[k]) for k in range(h)]
            update = [sigmoid(x[h + k] + u[h + k]) for k in range(h)]
            candidate = [math.tanh(x[2 * h + k] + reset[k] * u[2 * h + k]) for k in range(h)]
            state = [(1 - z) * s + z * c for z, s, c in zip(update, state, candidate, strict=True)]
            out.append(state)
        return out

    total = [0.0] * len(p["c"])
    for at in range(0, len(text), language.SPAN):
        first = max(0, at - language.CONTEXT)
        window = text[first : at + language.SPAN + language.CONTEXT]
        ahead, back = states("f", window), states("b", window[::-1])[::-1]
        for k in range(at - first, min(at + language.SPAN, len(text)) - first):
            logits = [dot(f, ahead[k]) + dot(b, back[k]) + c[0] for f, b, c in zip(p["vf"], p["vb"], p["c"], strict=True)]
            weights = [math.exp(x) for x in logits]
            total = [t + w / sum(weights) for t, w in zip(total, weights, strict=True)]
    return [t / len(text) for t in total]


def test_shares_are_those_of_plain_loops():
    rng = random.Random(4)
    net = language.ByteGru(3, 4, seed=7)
    texts = [bytes(rng.choices(range(256), k=n)) for n in (1, 3, 40, 256, 257, 300, 700)] + [PROSE.encode(), SPANISH.encode()]
    assert net.shares(texts) == pytest.approx(np.array([naive_shares(net, t) for t in texts]), abs=2e-5)


def test_language_of_documents(spark, odd, empty, tables):
    english, spanish = re.split(r"(?<=[.,]) ", PROSE), re.split(r"(?<=[.,]) ", SPANISH)
    rng = random.Random(5)
    rows = [
        (1000 + i, " ".join(rng.sample(parts, min(3, len(parts)))), lang, "s")
        for i, (parts, lang) in enumerate([(english, "en"), (spanish, "es")] * 60)
    ]
    docs = odd.select("doc_id", "text", "lang", "source")
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    got = queries.QUERIES["op4_language"](spark, tables(documents=docs)).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "es", "und") for r in got)
    assert {i for i, r in by_id.items() if r.lang_pred == "und"} == {4, 5, 6}
    held = [(by_id[i].lang_pred, lang) for i, _, lang, _ in rows if by_id[i].held_out]
    assert len(held) > 10 and sum(a == b for a, b in held) >= 0.9 * len(held)
    none = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language.identify(empty).count() == 0


def test_language_needs_a_letter():
    assert [language.has_letter(t) for t in ("½ ²³ Ⅷ ① _ 12", "١٢", "", "12 é", "ª", "日", "ǅ")] == [False] * 3 + [True] * 4


def test_a_normalising_model_is_refused(monkeypatch):
    real = sentencepiece.SentencePieceProcessor.normalize
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "normalize", lambda self, t, **k: real(self, t).replace("ﬁ", "fi"))
    with pytest.raises(ValueError, match="normalises"):
        pieces.PieceModel(queries.PIECE_MODEL)
