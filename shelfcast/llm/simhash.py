"""Near-duplicates by 64-bit SimHash fingerprints and meet-in-the-middle ball hashing.

Fingerprints at three or fewer differing bits have a meeting point at one step from the one and two
steps from the other. By the parity of the number of set bits only these variants are needed:

* every fingerprint's 64 variants at one step. Two fingerprints of the same parity that share one
  differ in two bits; two that differ in two bits share one.
* the 2,016 variants at two steps of the odd fingerprints, looked up among the one-step variants of
  the even ones. A hit differs in one or three bits, and all such pairs hit.

So a variant that several fingerprints share links them all, and a star of links around one of them
loses no component. Every link is verified by counting bits before it is kept.

Variants are dealt to buckets by a linear code: the XOR of the numbers of the set bits (six bits, more
for large inputs). Since the code of a variant follows from that of its fingerprint, a task gets the
fingerprints of which some variant lies in its bucket and expands the variants there; what is shuffled
is an entry for each bucket that a fingerprint reaches: 64 while there are 64 buckets, and at most one for each of
its variants (64 of an even fingerprint, 2,080 of an odd one) however many buckets there are. Only distinct
fingerprints take part, so groups of copies, however large, are one entry. There are as many buckets as
keep each at about ``BUCKET_ROWS`` fingerprints (``extra_bits``).

Defined results: null and empty texts have the fingerprint zero, which links like any other; repeated
rows share their class; a null ``doc_id`` is never a class's name unless the class has no other; an
empty table gives an empty result; texts of any length are read whole; ``components`` returns its three
columns, ``keep_one`` all columns of its input, however they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .components import HOT_SHARE, connected, split_join
from .staging import fresh, slices, staged

SEED = 42
SHINGLE = 3
RADIUS = 3
BUCKET_ROWS = 1 << 21
BLOCK = 1 << 15


def fingerprint(text: bytes | None) -> int:
    """SimHash of the lower-cased words' three-word shingles; a bit is set if more than half have it."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - SHINGLE + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, BLOCK):
        upto = min(at + BLOCK, count)
        spans = zip(starts[at:upto].tolist(), ends[at + SHINGLE - 1 : upto + SHINGLE - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, upto - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", keep_text: bool = True) -> DataFrame:
    """``docs`` and the fingerprint of every text as a (signed) long."""
    kept = [c for c in docs.columns if keep_text or c != text]
    schema = StructType([docs.schema[c] for c in kept] + [StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
            columns = [batch.column(c) for c in kept] + [pa.array(prints)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    return docs.select(*{c: None for c in [*kept, text]}).mapInArrow(run, schema)


def hexed(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# Codes of the 64 bits: bit i has the code i, and in larger inputs further bits from fixed odd factors.
def _codes(extra: int) -> np.ndarray:
    i = np.arange(64, dtype=np.uint64)
    mixed = (i + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return i | ((mixed >> np.uint64(64 - extra)) << np.uint64(6) if extra else np.uint64(0))


def _code_of(prints: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The XOR of the codes of the set bits of each fingerprint."""
    out = np.zeros(len(prints), np.uint64)
    for i in range(64):
        out ^= codes[i] * ((prints >> np.uint64(i)) & np.uint64(1))
    return out


def _star(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint with the first one of the same key, where that is another one."""
    order = np.lexsort((prints.view(np.int64), keys))
    keys, prints = keys[order], prints[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    centre = prints[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
    other = ~first
    return prints[other], centre[other]


def links_in_bucket(prints: np.ndarray, bucket: int, extra: int, chunk: int = 1 << 20) -> np.ndarray:
    """Verified links between the distinct fingerprints of one bucket, as rows of two."""
    codes, bucket = _codes(extra), np.uint64(bucket)
    one = np.uint64(1)
    masks = one << np.arange(64, dtype=np.uint64)
    wanted = _code_of(prints, codes) ^ bucket  # the code that a variant's flipped bits must have
    odd = (np.bitwise_count(prints) & 1).astype(bool)
    keys, owners, found = {}, {}, []
    for parity in (False, True):
        near_keys, near_owners = [], []
        for i in range(64):
            own = prints[(odd == parity) & (wanted == codes[i])]
            near_keys.append(own ^ masks[i])
            near_owners.append(own)
        keys[parity], owners[parity] = np.concatenate(near_keys), np.concatenate(near_owners)
        if len(keys[parity]):
            found.append(np.stack(_star(keys[parity], owners[parity]), axis=1))
    if len(keys[False]) and odd.any():
        order = np.lexsort((owners[False].view(np.int64), keys[False]))
        even_keys, even_owners = keys[False][order], owners[False][order]
        size = max(16, int(32 * len(even_keys)).bit_length())
        shift, factor = np.uint64(64 - size), np.uint64(0x9E3779B97F4A7C15)
        seen = np.zeros(1 << size, bool)
        seen[(even_keys * factor) >> shift] = True
        a, b = np.triu_indices(64, 1)
        pair_masks, pair_codes = masks[a] | masks[b], codes[a] ^ codes[b]
        by_code = np.argsort(pair_codes, kind="stable")
        pair_masks, pair_codes = pair_masks[by_code], pair_codes[by_code]
        odds, odd_wanted = prints[odd], wanted[odd]
        order = np.argsort(odd_wanted, kind="stable")
        odds, odd_wanted = odds[order], odd_wanted[order]
        values, at = np.unique(odd_wanted, return_index=True)
        for value, start, stop in zip(values, at, [*at[1:], len(odds)], strict=True):
            flips = pair_masks[np.searchsorted(pair_codes, value, "left") : np.searchsorted(pair_codes, value, "right")]
            for flip in flips:
                for lo in range(int(start), int(stop), chunk):
                    own = odds[lo : min(lo + chunk, int(stop))]
                    variants = own ^ flip
                    maybe = np.flatnonzero(seen[(variants * factor) >> shift])
                    if not len(maybe):
                        continue
                    own, variants = own[maybe], variants[maybe]
                    place = np.minimum(np.searchsorted(even_keys, variants), len(even_keys) - 1)
                    hit = even_keys[place] == variants
                    if hit.any():
                        found.append(np.stack([own[hit], even_owners[place[hit]]], axis=1))
    if not found:
        return np.zeros((0, 2), np.int64)
    pairs = np.concatenate(found)
    pairs = pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= RADIUS]
    return np.unique(pairs.view(np.int64), axis=0)


def _forest(pairs: np.ndarray) -> np.ndarray:
    """The same components with one link for each member but the smallest."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while (up := parent[x]) != root:
            parent[x], x = root, up
        return root

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.array([(x, find(x)) for x in parent if find(x) != x], np.int64).reshape(-1, 2)


def extra_bits(rows: int, bucket_rows: int) -> int:
    """Bits of the code beyond six, so that a bucket holds about ``bucket_rows`` of ``rows`` fingerprints.

    Half of the fingerprints reach 64 of the buckets, the other half one for each of up to 2,080 variants.
    """
    extra = 0
    while extra < 40 and rows * (64 + min(2080, 64 << extra)) > bucket_rows * (128 << extra):
        extra += 1
    return extra


def links(prints: DataFrame, name: str = "fingerprint", rows: int | None = None) -> DataFrame:
    """Links (``a``, ``b``) whose components are those of all pairs within ``RADIUS``.

    ``prints`` holds distinct fingerprints; ``rows`` is their number, counted where not given.
    """
    rows = prints.count() if rows is None else rows
    extra = extra_bits(rows, BUCKET_ROWS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _codes(extra)
        a, b = np.triu_indices(64, 1)
        steps = np.unique(np.concatenate([codes, codes[a] ^ codes[b]])) if extra else codes
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            base = _code_of(own, codes)
            if not extra:  # every fingerprint has variants in each of the 64 buckets
                buckets, members = list(range(64)), [own.tobytes()] * 64
            else:
                even = (np.bitwise_count(own) & 1) == 0
                reach = [(base[even, None] ^ codes[None, :]).ravel(), (base[~even, None] ^ steps[None, :]).ravel()]
                source = [np.repeat(own[even], len(codes)), np.repeat(own[~even], len(steps))]
                reach, source = np.concatenate(reach), np.concatenate(source)
                order = np.argsort(reach, kind="stable")
                reach, source = reach[order], source[order]
                buckets, at = np.unique(reach, return_index=True)
                members = [x.tobytes() for x in np.split(source, at[1:])]
                buckets = buckets.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int64()), pa.array(members, pa.binary())], names=["bucket", "members"]
            )

    def meet(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        own = np.unique(np.frombuffer(b"".join(frame["members"]), np.uint64))
        forest = _forest(links_in_bucket(own, int(key[0]), extra))
        return pd.DataFrame({"a": forest[:, 0], "b": forest[:, 1]})

    dealt = prints.select(name).mapInArrow(deal, "bucket long, members binary")
    return dealt.groupBy("bucket").applyInPandas(meet, "a long, b long")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``fingerprint`` in hex, ``component_id``) for each row of ``docs``."""
    rows = staged(
        with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), keep_text=False),
        "fingerprints",
    )
    counts = rows.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    distinct = staged(counts, "prints")
    named = class_ids(distinct, "fingerprint")
    # a fingerprint of more than 1 in HOT_SHARE rows: fewer than HOT_SHARE of them exist, so their names
    # are broadcast, and no task receives all their rows
    total = distinct.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in distinct.where(F.col("n") * HOT_SHARE > total).select("fingerprint").collect()]
    is_hot = F.col("fingerprint").isin(hot) if hot else F.lit(False)
    joined = rows.where(~is_hot).join(named.where(~is_hot), "fingerprint")
    if hot:
        joined = joined.unionByName(rows.where(is_hot).join(F.broadcast(named.where(is_hot)), "fingerprint"))
    return joined.select("doc_id", hexed(F.col("fingerprint")).alias("fingerprint"), "component_id")


def class_ids(distinct: DataFrame, name: str) -> DataFrame:
    """(fingerprint, ``component_id``): the smallest ``least`` of all fingerprints of the class."""
    found = staged(connected(staged(links(distinct, name), "links")), "roots")
    members = distinct.join(found.withColumnRenamed("node", name), name).select(name, "root", "least")
    least = members.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    linked = split_join(members, least, "root", found.count()).select(name, "component_id")
    return distinct.join(linked, name, "left").select(
        name, F.coalesce("component_id", "least").alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: that of the smallest ``doc_id`` (nulls last), the first of equal ones.

    Rows get a number when they are staged, so that exactly one of several equal rows stays.
    """
    prints, row = fresh("near_print", docs.columns), fresh("near_row", docs.columns)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    rows = staged(with_fingerprints(numbered, text, prints), "documents")
    narrow = rows.select(F.col(prints).alias("print"), F.col(doc_id).alias("doc_id"), F.col(row).alias("row"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    distinct = staged(narrow.groupBy("print").agg(F.min(order).alias("first")), "prints")
    found = staged(connected(staged(links(distinct, "print"), "links")), "roots")
    classed = distinct.join(found.withColumnRenamed("node", "print"), "print", "left")
    first = classed.groupBy(F.coalesce("root", "print").alias("class")).agg(F.min("first").alias("first"))
    kept = first.select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)
