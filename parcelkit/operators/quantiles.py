"""Exact quantiles without a whole group in one task.

Spark's exact ``percentile`` merges a group's distinct values in one task:
for a global or hot group of a continuous column that is the whole column.
Here a quantile is found by rank brackets, in three partially aggregated
passes over the input:

1. per group, for all columns and quantiles at once: the row counts and, from
   one bounded ``percentile_approx`` sketch per column, the values at
   ``p - MARGIN`` and ``p + MARGIN``.  The sketch's rank error is at most
   1 / ACCURACY, so the wanted ranks lie between them, whatever the
   distribution of the values;
2. the exact number of rows below each bracket, and the nearest values on
   either side of it;
3. rows per distinct value inside the brackets, at most a share of about
   2 * (MARGIN + 1 / ACCURACY) of the rows besides ties; running counts give
   the values at the two ranks around ``p * (n - 1)``.

A group's table has one row, joined back where NULL matches NULL; without
groups it is a scalar subquery, so no join is planned at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10000
MARGIN = 2.5 / ACCURACY

Items = Mapping[str, tuple[str | Column, float]]


def _same_group(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on the group key where NULL matches NULL, one copy of the key."""
    r = right.select(*[F.col(c).alias(f"_rk_{c}") for c in by],
                     *[c for c in right.columns if c not in by])
    cond = left[by[0]].eqNullSafe(r[f"_rk_{by[0]}"])
    for c in by[1:]:
        cond = cond & left[c].eqNullSafe(r[f"_rk_{c}"])
    return left.join(r, cond, "inner").drop(*[f"_rk_{c}" for c in by])


def group_quantiles(df: DataFrame, items: Items, by: Sequence[str] = ()) -> DataFrame:
    """One row per group (one row without groups): ``*by`` and each item's quantile.

    ``items`` maps an output name to (column, p); the quantile is the linear
    interpolation at position ``p * (n - 1)`` of the column's non-NULL
    values, NULL where there are none.  Rows with a NULL group key are a
    group of their own.
    """
    by, names = list(by), list(items)
    values = [F.col(c) if isinstance(c, str) else c for c, _ in items.values()]
    src = df.select(*by, *[v.cast("double").alias(f"_v{i}") for i, v in enumerate(values)])
    stats = [F.struct(
        F.count(f"_v{i}").alias("n"),
        F.percentile_approx(f"_v{i}", F.array(F.lit(max(0.0, p - MARGIN)), F.lit(min(1.0, p + MARGIN))),
                            ACCURACY).alias("b")).alias(f"_s{i}") for i, (_, p) in enumerate(items.values())]
    keep = [f"_v{i}" for i in range(len(names))]
    if by:
        group = src.groupBy(*by).agg(*stats)
        wide = _same_group(src, group, by)
    else:
        row = src.agg(F.struct(*stats).alias("r")).scalar()
        wide = src.select(*keep, row.alias("_r")).select(*keep, "_r.*")

    def low(i):
        return F.col(f"_s{i}")["b"][0]

    def high(i):
        return F.col(f"_s{i}")["b"][1]

    # rows below the bracket, and its nearest values on either side (in small groups a rank can be one off)
    side = [F.struct(F.count_if(F.col(f"_v{i}") < low(i)).alias("below"),
                     F.max(F.when(F.col(f"_v{i}") < low(i), F.col(f"_v{i}"))).alias("prev"),
                     F.min(F.when(F.col(f"_v{i}") > high(i), F.col(f"_v{i}"))).alias("next")) for i in range(len(names))]
    side = F.array(*side).alias("_side")
    under = wide.groupBy(*by).agg(side) if by else wide.agg(side)
    inside = F.filter(F.array(*[F.struct(
        F.lit(i).alias("i"), F.when(F.col(f"_v{i}").between(low(i), high(i)), F.col(f"_v{i}")).alias("v"),
        F.col(f"_s{i}")["n"].alias("n"), F.lit(float(p)).alias("p"))
        for i, (_, p) in enumerate(items.values())]), lambda s: s["v"].isNotNull())
    band = (wide.select(*by, F.explode(inside).alias("s")).groupBy(*by, "s.i", "s.v")
            .agg(F.count(F.lit(1)).alias("c"), F.first("s.n").alias("n"), F.first("s.p").alias("p")))
    before = F.sum("c").over(Window.partitionBy(*by, "i").orderBy("v")
                             .rowsBetween(Window.unboundedPreceding, -1))
    band = band.withColumn("inside", F.coalesce(before, F.lit(0)))
    band = _same_group(band, under, by) if by else band.withColumn("_side", under.scalar())
    band = band.withColumn("_side", F.col("_side")[F.col("i")])
    band = band.withColumn("place", F.col("p") * (F.col("n") - 1) - F.col("_side.below"))

    def at(rank: Column) -> Column:
        found = F.max(F.when((F.col("inside") <= rank) & (rank < F.col("inside") + F.col("c")), F.col("v")))
        return F.coalesce(found, F.max(F.when(rank < 0, F.col("_side.prev")).otherwise(F.col("_side.next"))))

    picked = band.groupBy(*by, "i").agg(at(F.floor("place")).alias("v1"), at(F.ceil("place")).alias("v2"),
                                        F.max(F.col("place") - F.floor("place")).alias("f"))
    q = F.when(F.col("v1") == F.col("v2"), F.col("v1")).otherwise(
        F.col("v1") + F.col("f") * (F.col("v2") - F.col("v1")))
    out = [F.max(F.when(F.col("i") == i, q)).alias(name) for i, name in enumerate(names)]
    return picked.groupBy(*by).agg(*out) if by else picked.agg(*out)


def partitioned_median(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact (interpolated) median of ``value`` per ``by`` group: ``*by, median_value``."""
    return group_quantiles(df, {"median_value": (value, 0.5)}, by)


def partitioned_quantile(df: DataFrame, value: str, by: Sequence[str] = (), p: float = 0.5,
                         out: str = "quantile_value") -> DataFrame:
    """Exact quantile with linear interpolation at position p * (n - 1): ``*by, out``."""
    return group_quantiles(df, {out: (value, p)}, by)


def group_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the most frequent non-NULL value of each column (the smallest of equals): one partial
    count per (column, value), then one pick per column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"))
                                for i, c in enumerate(cols)]))
    counted = (df.select(pairs.alias("s")).where(F.col("s.v").isNotNull()).groupBy("s.i", "s.v")
               .agg(F.count(F.lit(1)).alias("c")))
    return counted.agg(*[F.max_by(F.when(F.col("i") == i, F.col("v")),
                                  F.when(F.col("i") == i, F.struct(F.col("c"), -F.col("v")))).alias(c)
                         for i, c in enumerate(cols)])
