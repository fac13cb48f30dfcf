"""Benchmark passages in documents by spaced seeds, in DataFrame functions only.

Tokens are lower-cased runs of letters and digits; in scripts that put no blanks between words each character is
a token. A spaced seed hashes some positions of a window and
ignores the others, so that a substituted token breaks only the windows that look at it. Document and
benchmark windows meet on their hashes; each hit names a document, an item and an alignment. There all
tokens are compared: a passage counts as found if ``WINDOW`` aligned tokens in a row (all of a shorter
item) agree in at least ``AGREEMENT`` percent of the positions. Items of fewer than ``MIN_TOKENS`` tokens are too
short for the seeds: they are hashed whole and count as found where a document holds all their tokens in a row.

The benchmark's hashes are broadcast only if there are at most ``BROADCAST_HASHES`` (24 bytes each);
a larger set is joined by shuffle. Hits are reduced to distinct alignments before anything is moved, so
a passage that very many documents share costs one row for each. Texts are moved only where they may have a hit:
the hits are written once, and a bitmap of their texts' hashes, ``FILTER_BITS`` in size whatever the input,
is broadcast to drop all others before the exchange.

Defined results: null and empty texts have no tokens and no hits; items with equal tokens are one item, under
the smallest ``item_id``; repeated rows of documents are all found; an empty table on either side gives an
empty result; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import fresh, staged

MASKS = ("1101011", "1110011", "111011")  # 1: the token counts, 0: it is ignored
MIN_TOKENS = 8
WINDOW = 25
AGREEMENT = 80
BROADCAST_HASHES = 1_000_000
FILTER_BITS = 1 << 25

SPAN = max(map(len, MASKS))
# Thai, Lao, Myanmar, Khmer, Tai, kana, Bopomofo, Han, Yi: scripts without blanks between words.
UNSPACED = (
    r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u1950-\u19DF\u1A20-\u1AAF\u3005-\u3007\u3040-\u312F\u31A0-\u31BF"
    r"\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uA000-\uA4CF\uA9E0-\uA9FF\uAA60-\uAA7F\uF900-\uFAFF\uFF66-\uFF9F"
    r"\x{20000}-\x{3FFFF}]"
)


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, and single characters of ``UNSPACED``, as 64-bit hashes."""
    low = F.lower(F.coalesce(text, F.lit("")))
    # the test for any later character is one comparison each, and spares most texts the replacement
    spaced = F.when(low.rlike(r"[\u0E00-\x{10FFFF}]"), F.regexp_replace(low, f"({UNSPACED})", " $1 ")).otherwise(low)
    runs = F.array_remove(F.split(spaced, r"[^\p{L}\p{N}]+"), "")
    return F.transform(runs, lambda w: F.xxhash64(w))


def _windows(frame: DataFrame, array: str, names: list[str], lengths: list[int] = ()) -> DataFrame:
    """A row for each window and seed: ``names``, ``at`` and ``seed_hash``; runs of ``lengths`` are hashed whole.

    The shifted copies of the token array are zipped and laid out as columns, so that the seeds are
    hashed by generated code. Windows at the end that a shorter mask still fits have nulls behind.
    """
    size = f"greatest(size({array}), 0)"
    shifted = ", ".join(f"slice({array}, {k + 1}, {size})" for k in range(SPAN))
    zipped = F.expr(f"arrays_zip({shifted})")
    laid = frame.select(*names, F.posexplode(zipped).alias("at", "w"))
    hashes = []
    for number, mask in enumerate(MASKS):
        parts = [F.col("w").getField(str(k)) for k, bit in enumerate(mask) if bit == "1"]
        whole = F.col("w").getField(str(len(mask) - 1)).isNotNull()
        hashes.append(F.when(whole, F.xxhash64(F.lit(number), *parts)))
    for length in lengths:
        parts = [F.col("w").getField(str(k)) for k in range(length)]
        hashes.append(F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(-length), *parts)))
    out = laid.select(*names, "at", F.explode(F.array(*hashes)).alias("seed_hash"))
    return out.where("seed_hash is not null")


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    listed = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(text)).alias("item"))
    return listed.where(F.size("item") > 0).groupBy("item").agg(F.min("item_id").alias("item_id"))


def _bit(text_hash: Column) -> tuple[Column, Column]:
    """The word of the bitmap that a hash falls into, and its bit there."""
    low = text_hash.bitwiseAND(F.lit(FILTER_BITS - 1))
    return F.shiftright(low, 6).cast("int"), low.bitwiseAND(F.lit(63)).cast("int")


def _maybe(frame: DataFrame, text_hash: Column, bitmap: DataFrame) -> tuple[DataFrame, str]:
    """``frame`` and, in a column of its own, whether the hash's bit is set; the name of that column.

    The bitmap's size is bounded whatever the input, so it is broadcast.
    """
    columns = frame.columns
    word, bit, own, bits, maybe = (fresh(x, columns) for x in ("hash_word", "hash_bit", "own_word", "own_bits", "maybe"))
    at, which = _bit(text_hash)
    named = bitmap.select(F.col("bit_word").alias(own), F.col("bits").alias(bits))
    joined = frame.withColumns({word: at, bit: which}).join(F.broadcast(named), F.col(word) == F.col(own), "left")
    is_set = F.expr(f"coalesce(getbit(`{bits}`, `{bit}`), 0) = 1")
    return joined.withColumn(maybe, is_set).drop(word, bit, own, bits), maybe


def _bitmap(hashes: DataFrame, column: str) -> DataFrame:
    """(``bit_word``, ``bits``): a bitmap of the hashes, at most ``FILTER_BITS`` / 64 rows."""
    word, bit = _bit(F.col(column))
    marked = hashes.select(word.alias("bit_word"), bit.alias("bit"))
    marked = marked.select("bit_word", F.expr("shiftleft(1L, bit)").alias("bits"))
    return marked.groupBy("bit_word").agg(F.bit_or("bits").alias("bits"))


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    agreement: int = AGREEMENT,
) -> DataFrame:
    """(``doc_id``, ``text_hash``, ``item_id``, ``compared``, ``agreeing``) of each passage found.

    Rows of equal ``doc_id`` and text give one row for an item.
    """
    items = _items(benchmark, item_id, item_text)
    is_short = F.size("item") < MIN_TOKENS
    lengths = sorted(r[0] for r in items.where(is_short).select(F.size("item")).distinct().collect())
    seeds = _windows(items.where(~is_short), "item", ["item_id"])
    seeds = seeds.select("seed_hash", "item_id", F.col("at").alias("item_at"), F.lit(False).alias("short"))
    for length in lengths:
        whole = F.xxhash64(F.lit(-length), *[F.col("item")[k] for k in range(length)])
        of_length = items.where(F.size("item") == length)
        seeds = seeds.unionByName(
            of_length.select(whole.alias("seed_hash"), "item_id", F.lit(0).alias("item_at"), F.lit(True).alias("short"))
        )
    if seeds.count() <= BROADCAST_HASHES:
        seeds = F.broadcast(seeds)
    value = F.col(text)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(value).alias("text_hash"), value.alias("text"))
    listed = keyed.select("doc_id", "text_hash", tokens(F.col("text")).alias("doc"))
    diagonal = F.col("at") - F.col("item_at")
    # every alignment of a longer item, the first of a short one however often a document holds it
    hits = (
        _windows(listed, "doc", ["doc_id", "text_hash"], lengths)
        .join(seeds, "seed_hash")
        .groupBy("doc_id", "text_hash", "item_id", F.when(~F.col("short"), diagonal).alias("own"))
        .agg(F.min(diagonal).alias("diagonal"))
    )
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "item_id", "diagonal")
    hits = staged(hits, "hits")
    same = (F.col("text_hash") == F.col("hit_hash")) & F.col("doc_id").eqNullSafe(F.col("hit_id"))
    marked, maybe = _maybe(keyed, F.col("text_hash"), _bitmap(hits, "hit_hash"))
    aligned = marked.where(maybe).join(hits, same).join(items, "item_id")
    # arrays are bound by lambdas over one-element arrays: they are made once for each alignment
    compared = f"IF(size(item) < {MIN_TOKENS}, size(item), least(size(item), {window}))"
    agree = "transform(item, (t, k) -> IF(k + diagonal >= 0 AND get(doc, k + diagonal) <=> t, 1, 0))"
    most = (
        f"array_max(transform(sequence(0, size(item) - {compared}), "
        f"i -> aggregate(slice(agree, i + 1, {compared}), 0, (a, b) -> a + b)))"
    )
    scored = (
        aligned.withColumn("docs", F.array(tokens(F.col("text"))))
        .select(
            "doc_id",
            "text_hash",
            "item_id",
            F.expr(f"IF(size(item) < {MIN_TOKENS}, 100, {agreement})").alias("least"),
            F.expr(compared).alias("compared"),
            F.expr(f"transform(docs, doc -> transform(array({agree}), agree -> {most})[0])[0]").alias("agreeing"),
        )
    )
    found = scored.where(F.col("agreeing") * 100 >= F.col("compared") * F.col("least"))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("compared").alias("compared"), F.max("agreeing").alias("agreeing")
    )


def remove(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 1, **options
) -> DataFrame:
    """The documents in which no passage of at least ``least`` tokens was found, with the columns of ``docs``.

    ``least`` is for benchmarks with items of a word or two, which stand in countless documents that have nothing
    to do with them. Documents whose text has no bit among those with a passage stay without being moved.
    """
    found = find(docs, benchmark, doc_id, text, **options).where(F.col("compared") >= least)
    bad_id, bad_hash = fresh("bad_id", docs.columns), fresh("bad_hash", docs.columns)
    bad = staged(found.select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct(), "passages")
    marked, maybe = _maybe(docs, F.xxhash64(docs[text]), _bitmap(bad, bad_hash))
    same = (F.xxhash64(F.col(text)) == F.col(bad_hash)) & F.col(doc_id).eqNullSafe(F.col(bad_id))
    checked = marked.where(F.col(maybe)).join(bad, same, "left_anti")
    return marked.where(~F.col(maybe)).unionByName(checked).select(*docs.columns)
