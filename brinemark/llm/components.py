"""Connected components of a link table, by alternating stars (distributed union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brinemark.llm.columns import stored
from brinemark.session import clear_work, work_mark


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) of every node that has a link.

    ``links``: two columns of one orderable type. Direction, repeats and links of a
    node with itself do not matter; rows with a NULL are void; no links give no rows.

    Each round hangs the neighbours of every node below the smallest one, first the
    larger neighbours, then the smaller; rounds grow with the logarithm of the longest
    path. A hub's rows are merged before the shuffle for the minimum and split by
    AQE in the join; every round is written to the shared folder.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    links = links.distinct()
    before, mark = None, work_mark()
    while True:
        links = stored(links, "components")
        clear_work(links.sparkSession, mark, [links])  # the round before
        now = _mark(links)
        if now == before or now[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        larger = both.join(least, both["a"] == least["u"]).where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        below = larger.join(least.select(F.col("a").alias("u"), "m"), larger["a"] == F.col("u")).where(
            F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = below.union(least.select("a", F.col("m").alias("b"))).distinct()
