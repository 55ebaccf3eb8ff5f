"""Exact order statistics of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.joins import lookup_join
from parley.session import materialize

# Distance in rank share between a wanted rank and the splits around it, and the sketch's accuracy.
MARGIN = 0.0005
ACCURACY = 20_000
# Different values that one task ranks, and the parts into which a larger piece is cut.
PIECE_VALUES = 1_000_000
PARTS = 16


def _pieces(placed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, piece, size, values, start): rows and different values of each piece, and the rows in the pieces before it."""
    sizes = placed.groupBy(*keys, "piece").agg(F.sum("n").alias("size"), F.count("*").alias("values"))
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))


def _holding() -> Column:
    return (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("size"))


def _inside(counts: DataFrame, targets: DataFrame, group: str) -> DataFrame:
    """The different values in the targets' pieces, (low, high], with the target."""
    listed = targets.groupBy(group).agg(F.collect_list(F.struct("name", "rank", "start", "low", "high")).alias("t"))
    # as many targets as there are shares, for each group
    met = lookup_join(counts, listed, [group], "v").select(group, "v", "n", F.explode("t").alias("t"))
    above = F.col("t.low").isNull() | (F.col("v") > F.col("t.low"))
    return met.filter(above & (F.col("t.high").isNull() | (F.col("v") <= F.col("t.high")))).select(group, "v", "n", "t.*")


def _narrowed(counts: DataFrame, targets: DataFrame, group: str, parts: int = PARTS) -> DataFrame:
    """The targets with pieces of about 1 / ``parts`` of the values they had: each piece is split and counted again."""
    keys = [group, "name"]
    inside = materialize(_inside(counts, targets, group), "inside")
    points = [i / parts for i in range(1, parts)]
    splits = inside.groupBy(*keys).agg(F.percentile_approx("v", points, ACCURACY).alias("splits"))
    splits = materialize(splits, "piece_splits")
    above = [(F.col("v") > F.col("splits")[i]).cast("int") for i in range(len(points))]
    placed = lookup_join(inside, splits, keys, "v").withColumn("piece", sum(above[1:], above[0]))
    found = _pieces(placed, keys).withColumnRenamed("start", "inner")
    known = targets.select(*keys, "rank", "start", "low", "high").join(splits, keys)
    found = found.join(known, keys).withColumn("start", F.col("start") + F.col("inner")).filter(_holding())
    low = F.when(F.col("piece") > 0, F.get("splits", F.col("piece") - 1)).otherwise(F.col("low"))
    high = F.when(F.col("piece") < len(points), F.get("splits", F.col("piece"))).otherwise(F.col("high"))
    return found.select(*keys, "rank", "start", low.alias("low"), high.alias("high"), "values")


def ranked_values(
    df: DataFrame,
    group: str,
    value: str,
    shares: dict[str, float],
    also: dict[str, Column] | None = None,
    margin: float = MARGIN,
    accuracy: int = ACCURACY,
    piece_values: int = PIECE_VALUES,
) -> DataFrame:
    """One row per group: the value at 0-based rank floor(n * share) under each name, and the aggregates in ``also``.

    A ranking of a whole group would put it into one task. Instead each group gets splits just below
    and above the wanted ranks from a mergeable quantile sketch, equal values are counted together, and
    the counts between splits tell exactly which piece holds a wanted rank and where it starts. A piece of more than
    ``piece_values`` different values is split and counted again, until what is left can be ranked in one task. The sketch merely
    sets how even the pieces are; the result does not depend on it. The rows are read twice: for the sketch and for the counts.
    """
    also = also or {}
    rows = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    points = sorted({min(max(p + s, 0.0), 1.0) for p in shares.values() for s in (-margin, margin)})
    sketch = rows.groupBy(group).agg(
        F.percentile_approx(value, points, accuracy).alias("splits"),
        F.count(value).alias("total"),
        *[c.alias(name) for name, c in also.items()],
    )
    sketch = materialize(sketch, "sketch")
    counts = materialize(rows.groupBy(group, F.col(value).alias("v")).agg(F.count("*").alias("n")), "value_counts")
    # number of splits below the value: a sum over the few points, evaluated in generated code
    above = [(F.col("v") > F.col("splits")[i]).cast("int") for i in range(len(points))]
    placed = lookup_join(counts, sketch.select(group, "splits"), [group], "v").withColumn("piece", sum(above[1:], above[0]))
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(p).alias("share")) for k, p in shares.items()])
    targets = (
        _pieces(placed, [group]).join(sketch.select(group, "total", "splits"), group)
        .select("*", F.inline(wanted))
        .withColumn("rank", F.floor(F.col("total") * F.col("share")))
        .filter(_holding())
        .select(group, "name", "rank", "start", F.get("splits", F.col("piece") - 1).alias("low"), F.get("splits", F.col("piece")).alias("high"), "values")
    )
    # a row per group and share
    targets = materialize(targets, "targets")
    while not (large := targets.filter(F.col("values") > piece_values)).isEmpty():
        targets = materialize(targets.filter(F.col("values") <= piece_values).unionByName(_narrowed(counts, large, group)), "targets")
    upto = Window.partitionBy(group, "name").orderBy("v")
    found = (
        _inside(counts, targets, group)
        .withColumn("seen", F.col("start") + F.sum("n").over(upto))
        .filter(F.col("seen") > F.col("rank"))
        .groupBy(group)
        .agg(*[F.min(F.when(F.col("name") == k, F.col("v"))).alias(k) for k in shares])
    )
    return sketch.drop("splits").join(found, group, "left")
