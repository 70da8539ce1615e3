"""Connected components by alternating large-star and small-star steps.

Every step is one aggregation and one join on the edges; the edges are
written to the shared folder once a round. Hubs are safe: minima are
partially aggregated before the shuffle, and the join that hands them back is
one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize


def _with_least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.filter("u <> v").distinct()
    small = _with_least(large)
    out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m"))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has an edge and isn't the
    smallest of its component; ``component`` is that smallest node. Null ends
    and loops are ignored; an empty input gives an empty result."""
    spark = edges.sparkSession
    hi, lo = F.greatest(a, b), F.least(a, b)
    now = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = materialize(now.select(hi.alias("u"), lo.alias("v")).distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(now)
    while seen[0]:
        after = materialize(_round(now), "edges")
        drop_table(spark, now)
        now, last, seen = after, seen, mark(after)
        if seen == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
