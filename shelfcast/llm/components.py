"""Connected components of a distributed list of links (large-star and small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


#: A key is hot if it has more than 1 in HOT_SHARE of the rows, so fewer than HOT_SHARE keys are.
HOT_SHARE = 1000


def split_join(frame: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``frame`` with ``table``, which has one row for each key and, as ``n``, how many rows share it.

    ``total`` is at least the sum of all ``n``. Hot keys are few, so their rows of ``table`` are broadcast and
    the rows that share them stay where they are; all others meet in a shuffle.
    """
    is_hot = F.col("n") * HOT_SHARE > total
    hot, cold = F.broadcast(table.where(is_hot).drop("n")), table.where(~is_hot).drop("n")
    rest = frame.join(hot.select(key), key, "left_anti").join(cold, key)
    return frame.join(hot, key).unionByName(rest)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        F.bit_xor(F.xxhash64("b", "a")).alias("x"),
    ).first()
    return tuple(row)


def connected(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) of each node of the links (``a``, ``b``); the root is the smallest node.

    Large-star: each node hands its larger neighbours to its smallest one. Small-star: each node hands
    its smaller neighbours and itself to the smallest. Rounds repeat until the links no longer change,
    which is when all of them lead to roots. Sums of a node are combined before the shuffle; the links of
    a node that has very many do not meet in one task (``split_join``). Each round is written to the
    shared folder.
    """
    edges = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star"
    )
    last = _signature(edges)
    while last[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        least = least.select("a", F.least("a", "m").alias("m"), "n")
        large = split_join(both.where("b > a"), least, "a", 2 * last[0]).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "star")
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = split_join(large, least, "a", 2 * last[0]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "star")
        now = _signature(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
