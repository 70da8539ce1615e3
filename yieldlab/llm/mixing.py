"""Mixing sources to target weights by Poisson replication, in DataFrame
operations only.

A source with ``n`` rows and target weight ``w`` (of all weights' sum) gets a
mean repetition rate of ``w * total / n``. Each row's count is the inverse of
the Poisson distribution at a number in [0, 1) hashed from the row and the
seed; the row is exploded by it, and the copies are shuffled globally: dealt
out by a hash of row, copy and seed, and sorted by it within partitions.

A rate above ``RATE`` is the sum of that many more draws with equal parts of
the rate, as sums of Poisson numbers are Poisson numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions

__all__ = ["hashed", "mix_sources", "poisson", "rates", "row_keys"]

RATE = 16.0
#: P(X > 80) of a Poisson number X with mean 16 is below 1e-29, smaller than a step of the hashed number.
TAIL = 80
#: Rates of sources, or ids of several rows, that are sent to every executor; with more, they are joined.
SMALL = 100_000


def hashed(*parts: Column) -> Column:
    """A number in [0, 1): the first 52 bits of the MD5 of the parts' text."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson(rate: Column, u: Column) -> Column:
    """The smallest k whose distribution function at ``rate`` (at most
    ``RATE``) exceeds ``u``: the terms are summed as far as needed."""
    zero = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.when(u < F.exp(-rate), 0).otherwise(1).alias("k"))

    def add(acc: Column, i: Column) -> Column:
        p = acc["p"] * rate / i
        s = acc["sum"] + p
        return F.struct(p.alias("p"), s.alias("sum"), (acc["k"] + F.when(u < s, 0).otherwise(1)).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TAIL)), zero, add, lambda acc: acc["k"])


def rates(docs: DataFrame, targets: DataFrame | None = None, source_col: str = "source", power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """``(source, rate)``, a row for each source of ``docs`` (null is one).

    ``targets`` (``source``, ``weight``) gives the weights; sources that it
    doesn't name, or with a null or negative weight, get 0, and the rows of a
    source named twice are summed. Without it a source's weight is its number
    of rows to ``power``. The mean size of the mixture is ``epochs`` times the
    input. If all weights are 0 all rates are."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if targets is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        given = targets.groupBy(F.col("source").alias("_named")).agg(F.sum(F.greatest(F.col("weight").cast("double"), F.lit(0.0))).alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("_named")), "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    total = weighed.agg(F.struct(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))).scalar()
    share = F.when(total["weights"] > 0, F.col("weight") / total["weights"]).otherwise(0.0)
    return weighed.select("source", (share * F.lit(float(epochs)) * total["rows"] / F.col("n")).alias("rate"))


def row_keys(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with a text ``row`` that is one row's alone: its id's, and
    where an id is null or several rows have it, a number after the id.

    Only ids are counted and shuffled. The rows that need a number get it by
    their place in the input, while they are written to the checkpoint folder,
    so that it stays whatever is computed again."""
    key = F.col(id_col)
    ids = docs.filter(key.isNotNull()).groupBy(key.alias("shared")).count().filter("count > 1").select("shared")
    shared = materialize(ids, "shared-ids")
    n = shared.count()
    nameless = docs.filter(key.isNull())
    if not n and nameless.isEmpty():
        return docs.withColumn("row", key.cast("string"))
    shared = F.broadcast(shared) if n <= SMALL else shared
    named = docs.filter(key.isNotNull())
    several = named.join(shared, key == F.col("shared"), "left_semi").unionByName(nameless)
    several = materialize(several.withColumn("at", F.monotonically_increasing_id()), "shared-rows")
    row = F.concat_ws("#", F.coalesce(key.cast("string"), F.lit("null")), F.col("at"))
    own = named.join(shared, key == F.col("shared"), "left_anti").withColumn("row", key.cast("string"))
    return own.unionByName(several.withColumn("row", row).drop("at"))


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", power: float = 0.5, epochs: float = 1.0, seed: int = 1, extras: bool = True) -> DataFrame:
    """The mixture: the columns of ``docs``, then, with ``extras``, ``_copy``
    (from 1), ``_rate`` and ``_order`` (hash in [0, 1) of the global shuffle).
    Rows come out in shuffled order, partition by partition.

    Every row has a draw of its own: an id that is one row's alone gives the
    same count wherever the row lies; rows with a null id, or with an id that
    other rows have as well, draw by id and place in the input. All columns
    pass through, nulls included, whatever their names (those that are called
    like an extra column want ``extras=False``), and a source is only compared
    with itself. An empty table gives an empty mixture."""
    names = docs.columns
    plain = row_keys(docs.toDF(*[f"c{i}" for i in range(len(names))]), f"c{names.index(id_col)}")
    row = F.col("row")
    per = materialize(rates(docs, targets, source_col, power, epochs), "rates")
    per = F.broadcast(per) if per.count() <= SMALL else per
    source = F.col(f"c{names.index(source_col)}")
    joined = plain.join(per, source.eqNullSafe(F.col("source")), "left").drop("source")
    draws = F.greatest(F.ceil(F.col("rate") / RATE), F.lit(1)).cast("int")
    each = F.col("rate") / draws
    count = F.aggregate(F.sequence(F.lit(1), draws), F.lit(0), lambda acc, i: acc + poisson(each, hashed(F.lit(seed), row, i)))
    copies = joined.withColumn("copy", F.explode(F.when(F.col("rate") > 0, F.sequence(F.lit(0), count)).otherwise(F.array(F.lit(0)))))
    copies = copies.filter("copy > 0").withColumn("order", hashed(F.lit("order"), F.lit(seed), row, F.col("copy")))
    shuffled = copies.repartition(partitions(docs.sparkSession), "order").sortWithinPartitions("order", "copy")
    own = shuffled.select(*[f"c{i}" for i in range(len(names))], "copy", "rate", "order")
    return own.toDF(*names, "_copy", "_rate", "_order") if extras else own.drop("copy", "rate", "order").toDF(*names)
