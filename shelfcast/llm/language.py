"""Language identification by a bidirectional gated recurrent network over bytes.

A forward and a backward GRU read the bytes of a text; at every position both states give a distribution
over the languages, and the mean over all positions is the document's. Texts of any length are read
whole: they are cut into windows of ``SPAN`` bytes, each read with ``CONTEXT`` bytes before and after it to warm up
the states, and only the window's own positions are labelled. All windows of a batch advance together,
one byte a step, as rows of one matrix.

The network is trained in numpy by backpropagation through time and Adam, on short windows of at most
``PER_LANGUAGE`` labelled documents of each language, chosen by a hash of their id: the one bounded sample.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text if there is
nothing to learn from; ties go to the language first in order; rows without a language are not learned from but are
predicted; equal texts get equal predictions; an empty table gives an empty result; other columns, however they
are called, play no part in ``identify`` and pass through ``predicted``, which replaces those called like a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import fold, slices

UNDETERMINED = "und"
HIDDEN = 8
SPAN = 256
CONTEXT = 16
PER_LANGUAGE = 600
#: Labels beyond the most frequent ones are not learned; a dirty column cannot make the sample grow.
MOST_LANGUAGES = 200
WINDOWS = 4
WINDOW_CHARS = 48
STEPS = 500
BATCH = 192
RATE = 0.02
ROWS = 1024
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter (Unicode category L); numbers such as a half or a Roman eight are none."""
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def sample(labelled: DataFrame, doc_id: str, text: str, lang: str, per_language: int = PER_LANGUAGE) -> list[tuple]:
    """(language, text window) pairs from about ``per_language`` documents of each language.

    The share of documents to take follows from exact counts; which ones, and where their windows lie, from
    hashes of the id. Windows are cut before anything is collected.
    """
    counted = labelled.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MOST_LANGUAGES)
    counts = {r[0]: r[1] for r in counted.collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64(F.lit("draw"), F.col(doc_id)), F.lit(1 << 20)) / float(1 << 20)
    room = F.greatest(F.char_length(text) - WINDOW_CHARS, F.lit(0)) + 1
    windows = [
        F.substring(F.col(text), (F.pmod(F.xxhash64(F.lit(k), F.col(doc_id)), room) + 1).cast("int"), F.lit(WINDOW_CHARS))
        for k in range(WINDOWS)
    ]
    chosen = labelled.where(draw < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.array(*windows).alias("w"), doc_id)
    bound = 2 * per_language * len(counts)
    rows = chosen.orderBy(F.xxhash64(doc_id), doc_id).limit(bound).collect()
    return [(r["lang"], w.encode()) for r in rows for w in r["w"] if has_letter(w)]


class ByteGru:
    """Two GRUs over bytes and a linear layer on both states, with the gradients of all of it.

    The gates are ``r`` and ``z``; the candidate is ``tanh(x + r * (U h))``. A byte enters as a column of a table.
    States are matrices of one column for each window, so that each gate is one block of memory.
    """

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        small = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {}
        for side in "fb":
            self.p[f"x{side}"] = small(3 * hidden, 256)
            self.p[f"u{side}"] = small(3 * hidden, hidden)
            self.p[f"v{side}"] = small(classes, hidden)
        self.p["c"] = np.zeros((classes, 1), np.float32)

    def _run(
        self, side: str, steps: np.ndarray, real: np.ndarray | None = None, kept: list | None = None
    ) -> np.ndarray:
        """This side's part of the logits after each step (``steps``: one row of bytes a step).

        Where not ``real`` the state stays zero, so that reading backwards begins at a text's own end, not
        in what pads it. ``kept`` gets what backpropagation needs.
        """
        table, weights, out_weights, h = self.p[f"x{side}"], self.p[f"u{side}"], self.p[f"v{side}"], self.hidden
        # the half of sigmoid(a) = (1 + tanh(a / 2)) / 2 goes into the weights
        table, weights = table.copy(), weights.copy()
        table[: 2 * h] *= 0.5
        weights[: 2 * h] *= 0.5
        state = np.zeros((h, steps.shape[1]), np.float32)
        logits = np.empty((len(steps), len(out_weights), steps.shape[1]), np.float32)
        for t, chars in enumerate(steps):
            x, u = table.take(chars, axis=1), weights @ state
            gates = x[: 2 * h]
            gates += u[: 2 * h]
            np.tanh(gates, out=gates)
            gates += 1.0
            gates *= 0.5
            reset, update = gates[:h], gates[h:]
            inner, candidate = u[2 * h :], x[2 * h :]
            candidate += inner * reset
            np.tanh(candidate, out=candidate)
            new = candidate - state
            new *= update
            new += state
            if real is not None:
                new *= real[t]
            if kept is not None:
                kept.append((chars, state, inner, reset, update, candidate, new))
            state = new
            np.matmul(out_weights, state, out=logits[t])
        return logits

    def _back(self, side: str, kept: list, d_logits: np.ndarray, real: np.ndarray, grads: dict) -> None:
        weights, out_weights = self.p[f"u{side}"], self.p[f"v{side}"]
        d_weights, d_out = np.zeros_like(weights), np.zeros_like(out_weights)
        d_x, later = [], np.zeros_like(kept[0][1])
        for t in range(len(kept) - 1, -1, -1):
            _, state, inner, reset, update, candidate, new = kept[t]
            d_out += d_logits[t] @ new.T
            d = (out_weights.T @ d_logits[t] + later) * real[t]
            d_candidate = d * update * (1 - candidate**2)
            d_update = d * (candidate - state) * update * (1 - update)
            d_reset = d_candidate * inner * reset * (1 - reset)
            d_u = np.concatenate([d_reset, d_update, d_candidate * reset])
            d_x.append(np.concatenate([d_reset, d_update, d_candidate]))
            d_weights += d_u @ state.T
            later = d * (1 - update) + weights.T @ d_u
        chars = np.concatenate([k[0] for k in reversed(kept)])
        flat = np.concatenate(d_x, axis=1)
        grads[f"x{side}"] = np.stack([np.bincount(chars, row, 256) for row in flat]).astype(np.float32)
        grads[f"u{side}"], grads[f"v{side}"] = d_weights, d_out

    def fit(self, windows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, seed: int = 1) -> None:
        """Adam over random batches; the loss is the mean log loss of all positions."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        at = np.arange(windows.shape[1])[:, None]
        for step in range(1, STEPS + 1):
            pick = rng.integers(0, len(windows), BATCH)
            grads, _ = self.gradients(windows[pick].T, at < sizes[pick][None, :], labels[pick])
            rate = RATE * (1 - step / (STEPS + 1)) + 1e-4
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                unbiased = first[k] / (1 - 0.9**step)
                self.p[k] -= (rate * unbiased / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def gradients(self, steps: np.ndarray, real: np.ndarray, labels: np.ndarray) -> tuple[dict, float]:
        """Gradients of the mean log loss over the positions that are ``real``, and the loss."""
        kept_f, kept_b = [], []
        back = real[::-1]
        logits = self._run("f", steps, real, kept_f) + self._run("b", steps[::-1], back, kept_b)[::-1] + self.p["c"]
        d = self._shares(logits)
        weight = (real / real.sum()).astype(np.float32)
        columns = np.arange(len(labels))
        loss = -float((np.log(np.maximum(d[:, labels, columns], 1e-30)) * weight).sum())
        d[:, labels, columns] -= 1
        d *= weight[:, None, :]
        grads = {"c": d.sum((0, 2))[:, None]}
        self._back("f", kept_f, d, real, grads)
        self._back("b", kept_b, d[::-1], back, grads)
        return grads, loss

    @staticmethod
    def _shares(logits: np.ndarray) -> np.ndarray:
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def window_sums(
        self, windows: np.ndarray, lengths: np.ndarray, before: np.ndarray, sizes: np.ndarray
    ) -> np.ndarray:
        """Sums of the positions' distributions over each window's own ``sizes`` bytes after ``before`` bytes."""
        steps = np.ascontiguousarray(windows.T)
        at = np.arange(len(steps))[:, None]
        real = at < lengths if lengths.min() < len(steps) else None
        logits = self._run("f", steps)
        logits += self._run("b", steps[::-1], None if real is None else real[::-1])[::-1]
        logits += self.p["c"]
        shares = self._shares(logits)
        shares *= ((at >= before) & (at < before + sizes))[:, None, :]
        return shares.sum(axis=0, dtype=np.float64).T

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """The mean distribution over all positions of each (not empty) text."""
        width = SPAN + 2 * CONTEXT
        out = np.zeros((len(texts), len(self.p["c"])))
        cuts = [(i, at) for i, text in enumerate(texts) for at in range(0, len(text), SPAN)]
        # short windows together, so that little is spent on padding
        cuts.sort(key=lambda c: min(len(texts[c[0]]), c[1] + SPAN + CONTEXT) - max(0, c[1] - CONTEXT))
        for lo in range(0, len(cuts), ROWS):
            part = cuts[lo : lo + ROWS]
            raw = [texts[i][max(0, at - CONTEXT) : at + SPAN + CONTEXT] for i, at in part]
            longest = min(width, max(map(len, raw)))
            matrix = np.frombuffer(b"".join(r.ljust(longest, b"\0") for r in raw), np.uint8).reshape(-1, longest)
            before = np.array([min(at, CONTEXT) for _, at in part])
            sizes = np.array([min(SPAN, len(texts[i]) - at) for i, at in part])
            lengths = np.fromiter(map(len, raw), np.int64, len(raw))
            np.add.at(out, [i for i, _ in part], self.window_sums(matrix, lengths, before, sizes))
        return out / np.array([max(1, len(t)) for t in texts])[:, None]


def train(samples: list[tuple[str, bytes]]) -> tuple[list[str], ByteGru | None]:
    """The languages in order and the network; no network if there is nothing to learn from."""
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return [], None
    network = ByteGru(len(languages))
    longest = max(len(w) for _, w in samples)
    windows = np.frombuffer(b"".join(w.ljust(longest, b"\0") for _, w in samples), np.uint8).reshape(-1, longest)
    sizes = np.array([len(w) for _, w in samples])
    number = {lang: k for k, lang in enumerate(languages)}
    network.fit(windows, sizes, np.array([number[lang] for lang, _ in samples]))
    return languages, network


def predicted(docs: DataFrame, languages: list[str], network: ByteGru | None, text: str = "text") -> DataFrame:
    """``docs`` without the text, and ``lang_pred`` and ``score``."""
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = [UNDETERMINED] * len(batch), [0.0] * len(batch)
            texts = batch.column(text)
            rows = [i for i in range(len(batch)) if network and has_letter(texts[i].as_py() or "")]
            if rows:
                shares = network.shares([texts[i].as_py().encode() for i in rows]).round(5)
                for i, best, share in zip(rows, shares.argmax(axis=1), shares.max(axis=1), strict=True):
                    names[i], scores[i] = languages[best], min(1.0, float(share))
            columns = [*[batch.column(c) for c in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    schema = ", ".join([*[fields] * bool(fields), "lang_pred string, score double"])
    return docs.select(*kept, text).mapInArrow(run, schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(``doc_id``, ``held_out``, ``lang_pred``, ``score``) of each row; learns from all folds but 0."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0))
    languages, network = train(sample(known, "doc_id", "text", "lang"))
    out = predicted(rows.select("doc_id", "text"), languages, network)
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
