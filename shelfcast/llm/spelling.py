"""Groups of spelling variants by Gram matrices of letter counts.

Two words that differ by one inserted, deleted or replaced letter have letter counts at squared distance 1
(lengths one apart) or 2 (equal lengths). So the Gram matrix of the letter counts of a block of words, one
NumPy product, gives all squared distances at once; pairs at the right distance in adjacent lengths are
kept, and the edit itself is verified on the letters.

Blocks make this affordable. The letters fall into ``GROUPS`` groups (code point modulo ``GROUPS``). One edit
changes the counts of at most two letters, hence of at most two groups, so two near words have equal counts
in at least two of the four groups. A word stands in one block for each pair of groups, named by the length
and the counts in those groups, and in those of the next shorter length. Two near words meet in at least
one block; of the blocks in which they meet only the first one reports them, so each pair is reported once.

A block of more than ``TILE`` words is cut into tiles by a hash of the word, and each unordered pair of
tiles is a piece of work of its own, so no block, however many words share it, goes to one task. A block of
up to ``TILE`` words has one tile; there is one path for all sizes.

Words are counted in each task before the shuffle. Forms lead to words at least twice as frequent, so chains
are short and have no rings; their ends are found by pointer doubling.

Defined results: null texts have no words; a null ``doc_id`` counts as the empty text in the checksum; repeated
rows are counted like any others; runs may be of any length; a word without near words has null ``form`` and is
its own ``root``; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import slices, staged

# Fixed values of the contract.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DAMAGE = 97
LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2

GROUPS = 4
#: The pairs of groups whose equal counts name a block.
PAIRS = list(itertools.combinations(range(GROUPS), 2))
TILE = 4096
#: Bytes of block entries that one task joins at a time.
BUCKET_BYTES = 4 << 20
FLUSH_WORDS = 200_000
FLUSH_LETTERS = 16 << 20
#: Letters of the candidate pairs that are compared at a time, and cells of one product.
CHECK_LETTERS = 8 << 20
_MIX = np.random.default_rng(97).integers(1, 1 << 62, (256, len(PAIRS) + 1), dtype=np.int64).view(np.uint64)


def damaged_words(doc_id, text: bytes) -> Counter:
    """The words of a text and how often each occurs, after the deletions that the checksum asks for."""
    runs = Counter(RUN.findall(text.lower().decode()))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        if len(run) < LEAST_LETTERS:
            continue
        check = zlib.crc32(run.encode(), start)
        if check % DAMAGE == 0:
            at = check % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        out[run] += n
    return out


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``word``, ``n``): distinct words of at least ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        letters = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal letters
            part = pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())
            yield pa.RecordBatch.from_arrays(list(part), names=["word", "n"])
            counts.clear()
            letters = 0

        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for key, value in zip(batch.column(0).to_pylist(), texts, strict=True):
                for word, n in damaged_words(key, value or b"").items():
                    if word not in counts:
                        letters += len(word)
                    counts[word] += n
                if len(counts) >= FLUSH_WORDS or letters >= FLUSH_LETTERS:
                    yield from flush()
        yield from flush()

    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _letters(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The owner and the letter (Latin-1 code) of each place in the words."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.repeat(np.arange(len(texts)), lengths), np.frombuffer(b"".join(texts), np.uint8)


def block_keys(texts: list[bytes]) -> np.ndarray:
    """For each word and pair of groups a hash of its letter counts in these groups."""
    owner, letter = _letters(texts)
    keys = np.zeros((len(texts), len(PAIRS)), np.uint64)
    for p, groups in enumerate(PAIRS):
        inside = np.isin(letter % GROUPS, groups)
        np.add.at(keys[:, p], owner[inside], _MIX[letter[inside], p])
    return keys


def _entries(found: DataFrame) -> DataFrame:
    """(``key``, ``tag``, ``word``, ``n``): the words in each of their blocks.

    ``tag`` is 2 * the pair of groups, plus 1 where the word is the longer one of its block's lengths.
    """
    shown = len(PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            texts = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            lengths = np.fromiter(map(len, texts), np.uint64, len(texts))
            keys = block_keys(texts)
            for longer in (0, 1):
                size = lengths - np.uint64(longer)
                own = keys ^ (size[:, None] * _MIX[:shown, shown][None, :] + _MIX[shown : 2 * shown, shown][None, :])
                for p in range(shown):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own[:, p].view(np.int64)),
                            pa.array(np.full(len(texts), 2 * p + longer, np.int8)),
                            batch.column(0),
                            batch.column(1),
                        ],
                        names=["key", "tag", "word", "n"],
                    )

    return found.select("word", "n").mapInArrow(run, "key long, tag byte, word string, n long")


def _counts(texts: list[bytes], letters: np.ndarray, dtype) -> np.ndarray:
    owner, letter = _letters(texts)
    place = np.zeros(256, np.int64)
    place[letters] = np.arange(len(letters))
    flat = np.bincount(owner * len(letters) + place[letter], minlength=len(texts) * len(letters))
    return flat.reshape(len(texts), len(letters)).astype(dtype)


def _close(a: list[bytes], b: list[bytes], wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words whose letter counts have the squared distance ``wanted``, by one product."""
    letters = np.unique(np.frombuffer(b"".join(a) + b"".join(b), np.uint8))
    # single precision holds all sums of squares exactly up to this length
    dtype = np.float32 if len(b[0]) < 4000 else np.float64
    left, right = _counts(a, letters, dtype), _counts(b, letters, dtype)
    near = left @ right.T
    near *= -2
    near += (left * left).sum(axis=1)[:, None]
    near += (right * right).sum(axis=1)[None, :]
    return np.nonzero(near == wanted)


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words ``b``, one letter longer, are ``a`` with one letter put in."""
    ahead = np.cumprod(a == b[:, :-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return ahead + behind >= a.shape[1]


def _first_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first pair of groups in which the counts of two near words are equal.

    What differs between near words is one letter more (or one for another), found as the sums by group.
    """
    equal = np.stack(
        [(a % GROUPS == g).sum(axis=1) == (b % GROUPS == g).sum(axis=1) for g in range(GROUPS)], axis=1
    )
    # equal totals may hide a letter replaced within its group: there the sums of codes differ
    for g in range(GROUPS):
        own = np.where(a % GROUPS == g, a, 0).sum(axis=1, dtype=np.int64)
        equal[:, g] &= own == np.where(b % GROUPS == g, b, 0).sum(axis=1, dtype=np.int64)
    out = np.full(len(a), -1)
    for p, (g, h) in reversed(list(enumerate(PAIRS))):
        out[equal[:, g] & equal[:, h]] = p
    return out


def _verified(a: list[bytes], b: list[bytes], i: np.ndarray, j: np.ndarray, pair: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the candidate pairs those that are one edit apart and whose first common block is this one."""
    kept_i, kept_j = [], []
    left = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), -1)
    right = np.frombuffer(b"".join(b), np.uint8).reshape(len(b), -1)
    edited = _replaced if left.shape[1] == right.shape[1] else _inserted
    step = max(1, CHECK_LETTERS // right.shape[1])
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        good = edited(left[x], right[y])
        x, y = x[good], y[good]
        good = _first_pair(left[x], right[y]) == pair
        kept_i.append(x[good])
        kept_j.append(y[good])
    return np.concatenate(kept_i), np.concatenate(kept_j)


def near_in_block(own: list[bytes], longer: list[bytes], pair: int, others: tuple | None = None):
    """Near pairs of a block, as (list of places in ``own``, places in ``own`` or ``longer``).

    ``own`` are words of the block's length, ``longer`` of the next one. With ``others`` (two such lists of
    another tile) only the pairs between the two tiles are looked for.
    """
    if others is None:
        works = [(own, own, 2, True), (own, longer, 1, False)]
    else:
        works = [(own, others[0], 2, False), (own, others[1], 1, False), (others[0], longer, 1, False)]
    for a, b, wanted, same in works:
        if not a or not b or (same and len(a) < 2):
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        i, j = _close(a, b, wanted)
        if same:
            i, j = i[i < j], j[i < j]
        yield _verified(a, b, i, j, pair) if len(i) else (i, j)


def near(found: DataFrame, tile: int = TILE, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(``word``, ``n_near``, ``best_n``, ``best``) of each word with near words; ``found`` has ``word`` and ``n``."""
    entries = _entries(found)
    sizes = entries.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > tile)
    large = staged(sizes.select("key", F.ceil(F.col("size") / tile).cast("int").alias("tiles")), "blocks")
    # an entry is a word with some 16 bytes of numbers; a word of a block of t tiles stands in t of its t * t pairs
    total = 2 * len(PAIRS) * (found.agg(F.sum(F.length("word") + 16).alias("b")).first()["b"] or 0)
    copies = large.agg(F.sum(F.col("tiles").cast("long") * F.col("tiles")).alias("t")).first()["t"] or 0
    buckets = 1 + (total + copies * tile * 32) // bucket_bytes
    tiles = F.coalesce("tiles", F.lit(1))
    mine = F.pmod(F.xxhash64("word"), tiles).cast("int")
    dealt = (
        entries.join(large, "key", "left")
        .select("key", "tag", "word", "n", mine.alias("mine"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
        .select("key", "tag", "word", "n", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
        .withColumn("bucket", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(buckets)).cast("int"))
    )

    def meet(table: pa.Table) -> pa.Table:
        # words by number, in code-point order, so that ties of frequency go to the smaller number
        coded = table.column("word").combine_chunks().dictionary_encode()
        by_code = pc.sort_indices(coded.dictionary).to_numpy()
        known = [w.encode("latin-1") for w in coded.dictionary.take(pa.array(by_code)).to_pylist()]
        rank = np.empty(len(by_code), np.int64)
        rank[by_code] = np.arange(len(by_code))
        number = rank[coded.indices.to_numpy()]
        columns = {c: table.column(c).to_numpy() for c in ("key", "tag", "n", "mine", "lo", "hi")}
        lengths = np.fromiter(map(len, known), np.int64, len(known))[number]
        columns |= {"number": number, "length": lengths - (columns["tag"] & 1), "pair": columns["tag"] >> 1}
        # the length and the pair are part of the key already; they stand here so that a block cannot mix them
        named = ("key", "length", "pair", "lo", "hi")
        order = np.lexsort([columns[c] for c in named])
        columns = {c: v[order] for c, v in columns.items()}
        changes = np.zeros(max(0, len(order) - 1), bool)
        for c in named:
            changes |= columns[c][1:] != columns[c][:-1]
        edges = np.flatnonzero(np.r_[True, changes, True]) if len(order) else np.zeros(0, np.int64)
        role = (columns["tag"] & 1) * 2 + (columns["mine"] != columns["lo"])
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            places = [a + np.flatnonzero(role[a:b] == r) for r in range(4)]
            sets = [[known[k] for k in columns["number"][p]] for p in places]
            pair = int(columns["pair"][a])
            if columns["lo"][a] == columns["hi"][a]:
                sides, hits = [(0, 0), (0, 2)], near_in_block(sets[0], sets[2], pair)
            else:
                sides, hits = [(0, 1), (0, 3), (1, 2)], near_in_block(sets[0], sets[2], pair, (sets[1], sets[3]))
            for (x, y), (i, j) in zip(sides, hits, strict=True):
                left.append(places[x][i])
                right.append(places[y][j])
        source, target = np.concatenate([*left, *right]), np.concatenate([*right, *left])
        word, other, frequency = columns["number"][source], columns["number"][target], columns["n"][target]
        by = np.lexsort((other, -frequency, word))
        word, other, frequency = word[by], other[by], frequency[by]
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
        text = lambda numbers: pa.array([known[k].decode("latin-1") for k in numbers], pa.string())
        return pa.table(
            {
                "word": text(word[first]),
                "n_near": pa.array(np.diff(np.r_[first, len(word)]), pa.int64()),
                "best_n": pa.array(frequency[first], pa.int64()),
                "best": text(other[first]),
            }
        )

    parts = dealt.groupBy("bucket").applyInArrow(meet, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``): the end of the chain of forms that begins at each word of (``word``, ``form``)."""
    at = staged(forms.select("word", F.col("form").alias("root")), "chains")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = staged(at.join(ahead, "root", "left").select("word", "root", "next"), "chains")
        if jumped.where("next is not null").isEmpty():
            return jumped.select("word", "root")
        at = jumped.select("word", F.coalesce("next", "root").alias("root"))


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``) of each word of the texts."""
    found = staged(words(docs, doc_id, text), "words")
    linked = staged(
        found.join(near(found), "word", "left").select(
            "word",
            F.when(F.col("best_n") >= RATIO * F.col("n"), F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("best_n") >= RATIO * F.col("n"), F.col("best_n")).alias("form_n"),
        ),
        "linked",
    )
    ends = roots(linked.where("form is not null").select("word", "form"))
    return linked.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
