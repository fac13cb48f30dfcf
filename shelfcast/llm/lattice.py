"""Text likelihood by a lattice over all segmentations into known pieces.

The pieces and their weights come from an existing vocabulary: a piece's score in the file, normalised once to
a unigram distribution. The probability of a word sums over every segmentation (forward recursion in log
space), so no single one is chosen; a text's probability is that of its words and of the end behind
them. How often a text ends is learned from the training texts, as are the counts of the base score.

No piece crosses the start of a word, so the marginal probability of a text is the product over its words
and the end; the recursion runs once for each distinct word of the corpus, in parallel, and the texts
are scored by joining their words with these results. The most frequent words of all texts, at most
``HOT_WORDS`` of at most ``HOT_TOTAL`` bytes together (a proven bound, whatever their length), go to every task; the
rest meets the texts in a shuffled join, so no frequent word becomes a hot key.

Two options go beyond the existing scores, and are off unless asked for: ``iterations`` rounds of expectation
maximization estimate the weights anew from the training words, and ``whole_words`` makes each training word
an edge of the lattice with its discounted share of the tokens.

Counts cover all training documents, word probabilities all documents; the tables grow with them.

Defined results: null is treated as the empty text, which is the end token alone; repeated rows are scored
by themselves; characters outside the vocabulary are spelled in byte pieces; an empty table gives an empty
result; texts and words of any length are read whole; other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import fold, slices, staged

MARK = "▁"
DISCOUNT = 0.75
HOT_WORDS = 131_072
HOT_TOTAL = 8 << 20
FLUSH_WORDS = 200_000
FLUSH_BYTES = 64 << 20
BATCH_ROWS = 20_000


def vocabulary(path: str) -> tuple[list[str], list[float], dict[int, int]]:
    """Pieces, their log probabilities from the file's scores, and the index of each byte piece.

    A file whose scores are log probabilities gives them as they are. In a file of merges they are ranks (0, -1,
    -2, ...), which are no logarithms of anything: there a piece weighs 1 / (rank + 10), as word frequencies fall.
    Either way the weights are normalised once.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks, bytes_at = [], [], {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_at[int(piece[3:5], 16)] = len(pieces)
            pieces.append(piece)
            ranks.append(model.get_piece_size())
        elif piece.strip(MARK) or piece == MARK:
            pieces.append(piece)
            ranks.append(max(1, -int(model.get_score(i))) if model.get_score(i) > -1e8 else 1)
    weights = -np.log(np.minimum(np.array(ranks, np.float64), model.get_piece_size()) + 10.0)
    weights -= math.log(np.exp(weights).sum())
    return pieces, weights.tolist(), bytes_at


class Lattice:
    """All segmentations of a word into pieces with log probabilities."""

    def __init__(self, pieces: list[str], scores: list[float], bytes_at: dict[int, int]) -> None:
        self.pieces, self.scores, self.bytes_at = pieces, scores, bytes_at
        self.automaton = ahocorasick.Automaton()
        spelled = set(bytes_at.values())
        for k, piece in enumerate(pieces):
            if k not in spelled:
                self.automaton.add_word(piece, (k, len(piece), scores[k]))
        self.automaton.make_automaton()

    def edges(self, word: str) -> list[list[tuple[int, int, float]]]:
        """For each end (piece, start, score); a character without a piece gets its bytes as one edge."""
        ends: list[list[tuple[int, int, float]]] = [[] for _ in range(len(word) + 1)]
        for at, (piece, length, score) in self.automaton.iter(word):
            ends[at + 1].append((piece, at + 1 - length, score))
        for end in range(1, len(word) + 1):
            if not ends[end] or ends[end][-1][1] != end - 1:  # matches come longest first
                spelled = sum(self.scores[self.bytes_at[b]] for b in word[end - 1].encode()) if self.bytes_at else -20.0
                ends[end].append((-1, end - 1, spelled))
        return ends

    @staticmethod
    def forward(ends: list[list[tuple[int, int, float]]]) -> list[float]:
        """Log probability of each prefix, over all of its segmentations."""
        alpha = [0.0] * len(ends)
        exp, log = math.exp, math.log
        for end in range(1, len(ends)):
            here = ends[end]
            if len(here) == 1:
                _, start, score = here[0]
                alpha[end] = alpha[start] + score
                continue
            into = [alpha[start] + score for _, start, score in here]
            top = max(into)
            alpha[end] = top + log(sum([exp(x - top) for x in into]))
        return alpha

    def log_probability(self, word: str) -> float:
        """Marginal natural-log probability of a word (without its mark)."""
        return self.forward(self.edges(MARK + word))[-1]

    def expect(self, word: str, counts: np.ndarray) -> None:
        """Add the expected uses of each piece in a word."""
        text = MARK + word
        ends = self.edges(text)
        alpha = self.forward(ends)
        exp = math.exp
        # beta in the linear domain relative to alpha: share[end] is the probability of passing through end
        share = [0.0] * len(alpha)
        share[-1] = 1.0
        for end in range(len(ends) - 1, 0, -1):
            mass = share[end]
            if mass > 0.0:
                base = alpha[end]
                for piece, start, score in ends[end]:
                    part = mass * exp(alpha[start] + score - base)
                    share[start] += part
                    if piece >= 0:
                        counts[piece] += part
                    elif self.bytes_at:
                        for b in text[start].encode():
                            counts[self.bytes_at[b]] += part


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def word_counts(docs: DataFrame) -> DataFrame:
    """(``word``, ``c``, ``times``): occurrences in training texts and in all; the null word counts the texts.

    ``docs`` has ``text`` and ``train``. Words are counted in each task before the shuffle; a task's table is
    handed on whenever it has ``FLUSH_WORDS`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, other, texts, letters = Counter(), Counter(), [0, 0], 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(learned) + [w for w in other if w not in learned]
            for at in range(0, len(words), BATCH_ROWS):
                part = words[at : at + BATCH_ROWS]
                seen = [learned.get(w, 0) for w in part]
                times = [n + other.get(w, 0) for n, w in zip(seen, part, strict=True)]
                column = pa.array(part, pa.binary()).cast(pa.string())
                yield _record(["word", "c", "times"], [column, pa.array(seen, pa.int64()), pa.array(times, pa.int64())])
            learned.clear()
            other.clear()

        for batch in slices(batches):
            train = batch.column("train").to_pylist()
            for text, is_train in zip(_texts(batch.column("text")), train, strict=True):
                (learned if is_train else other).update(text.lower().split())
                texts[0] += is_train
                texts[1] += 1
                letters += len(text)
                # the table holds no more bytes than the texts since the last time
                if len(learned) + len(other) >= FLUSH_WORDS or letters >= FLUSH_BYTES:
                    yield from flush()
                    letters = 0
        yield from flush()
        counts = [pa.array([n], pa.int64()) for n in texts]
        yield _record(["word", "c", "times"], [pa.array([None], pa.string()), *counts])

    counted = docs.select("text", "train").mapInArrow(run, "word string, c long, times long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("times").alias("times"))


def _record(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=names)


def reestimated(words: DataFrame, vocab: tuple, iterations: int) -> list[float]:
    """Piece log probabilities after expectation maximization over the distinct training words.

    Each task sums the expected uses over its words; what comes back is one row for each piece.
    """
    pieces, scores, bytes_at = vocab
    learned = words.where("c > 0 and word is not null").select("word")
    for _ in range(iterations):

        def run(batches: Iterator[pa.RecordBatch], scores: list[float] = scores) -> Iterator[pa.RecordBatch]:
            lattice, counts = Lattice(pieces, scores, bytes_at), np.zeros(len(pieces))
            for batch in slices(batches):
                for word in batch.column(0).to_pylist():
                    lattice.expect(word, counts)
            used = np.flatnonzero(counts)
            yield _record(["piece", "uses"], [pa.array(used, pa.int64()), pa.array(counts[used])])

        uses = np.full(len(pieces), 0.1)
        found = learned.mapInArrow(run, "piece long, uses double").groupBy("piece")
        # decimal sums: the same however tasks are combined
        for piece, total in found.agg(F.sum(F.round("uses", 4).cast("decimal(28,4)")).alias("u")).collect():
            uses[piece] += float(total)
        uses = np.append(uses, 0.0)
        log = np.log(np.maximum(uses[:-1], 1e-9) / uses.sum())
        scores = log.tolist()
    return scores


def word_scores(
    words: DataFrame, vocab: tuple, scores: list[float], total: int, distinct: int, word: float, whole_words: bool = False
) -> DataFrame:
    """(``word``, ``c``, ``times``, ``base``, ``model``): log10 probabilities of each distinct word of the corpus.

    ``word`` is the log probability that a token is a word and not the end.
    """
    pieces, _, bytes_at = vocab
    # tokens kept back from whole words by discounting; all of the mass where nothing was learned
    free = math.log(DISCOUNT * distinct / total) if whole_words and total else word
    base_total = math.log10(total + 0.5 * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, scores, bytes_at)
        for batch in slices(batches):
            base, model = [], []
            for text, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = free + lattice.log_probability(text)
                if whole_words and c > 0:
                    found = np.logaddexp(math.log((c - DISCOUNT) / total), found)
                model.append(found / math.log(10))
                base.append(math.log10(c + 0.5) - base_total)
            yield _record(
                ["word", "c", "times", "base", "model"],
                [*batch.columns, pa.array(base, pa.float64()), pa.array(model, pa.float64())],
            )

    known = words.where("word is not null").select("word", "c", "times")
    return known.mapInArrow(run, "word string, c long, times long, base double, model double")


def _hot_words(scored: DataFrame, most: int, most_bytes: int = HOT_TOTAL) -> dict[bytes, tuple[bool, float, float]]:
    """The most frequent words that number at most ``most`` and have at most ``most_bytes``.

    Exact counts by level of frequency (an eighth of a power of two) tell how far down that reaches.
    """
    often = scored.where("times > 1")
    level = F.floor(F.log2("times") * 8).cast("int")
    levels = often.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum(F.octet_length("word")).alias("bytes"))
    taken, size, least = 0, 0, None
    for row in levels.orderBy(F.desc("level")).collect():
        taken, size = taken + row["n"], size + row["bytes"]
        if taken > most or size > most_bytes:
            break
        least = row["level"]
    if least is None:
        return {}
    chosen = often.where(level >= least).select("word", "c", "base", "model")
    return {r["word"].encode(): (r["c"] > 0, r["base"], r["model"]) for r in chosen.collect()}


def score(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", hot_words: int = HOT_WORDS,
    iterations: int = 0, whole_words: bool = False,
) -> DataFrame:
    """(``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``) of each row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("train", fold(F.col("doc_id")) != 1)
    words = staged(word_counts(rows), "words")
    sums = words.agg(
        F.sum("c").alias("total"),
        F.count_if(F.col("c") > 0).alias("distinct"),
        F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("ends"),
    ).first()
    total, distinct, ends = int(sums["total"] or 0), int(sums["distinct"]), int(sums["ends"] or 0)
    vocab = vocabulary(path)
    scores = reestimated(words, vocab, iterations) if iterations else vocab[1]
    share = (ends + 0.5) / (total + 1.0)  # of the tokens that are the end
    found = word_scores(words, vocab, scores, total, distinct, math.log1p(-share), whole_words)
    scored = staged(found, "word-scores")
    hot = spark.sparkContext.broadcast(_hot_words(scored, hot_words))
    base_total = math.log10(total + 0.5 * (distinct + 1))
    end_base = math.log10(ends + 0.5) - base_total
    end_model = math.log10(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row of each document's frequent words and end, with its rare words as arrays."""
        known_words = hot.value
        for batch in slices(batches):
            made: list[list] = [[] for _ in range(6)]
            for value in _texts(batch.column("text")):
                tokens = value.lower().split()
                known, base, model = int(ends > 0), end_base, end_model
                rare, times = [], []
                for word, n in Counter(tokens).items():
                    entry = known_words.get(word)
                    if entry is None:
                        rare.append(word)
                        times.append(n)
                    else:
                        known += n * entry[0]
                        base += n * entry[1]
                        model += n * entry[2]
                for column, item in zip(made, (len(tokens) + 1, known, base, model, rare, times), strict=True):
                    column.append(item)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(made, kinds, strict=True)]
            arrays[4] = arrays[4].cast(pa.list_(pa.string()))
            yield _record(NAMES, [batch.column("doc_id"), batch.column("train"), *arrays])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, train boolean, n_tokens long, known long, base double, model double, rare array<string>, times array<long>"
    parts = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    parts = staged(parts, "texts")
    rare = parts.select("row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("n"))))
    joined = rare.join(scored, "word").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.col("base")).alias("rare_base"),
        F.sum(F.col("n") * F.col("model")).alias("rare_model"),
    )
    whole = parts.drop("rare", "times").join(joined, "row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return whole.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        plus("known", "rare_known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        plus("base", "rare_base").alias("base_score"),
        plus("model", "rare_model").alias("score"),
    )


NAMES = ["doc_id", "train", "n_tokens", "known", "base", "model", "rare", "times"]
