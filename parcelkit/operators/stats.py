"""Single-pass statistics (A4-A13, U1, I12 layer rules, T6).

Every statistic over many columns is one ``agg`` (one scan, partial
aggregation on the map side) followed by a reshape of the one-row result;
nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quantile cut points for n = 5 buckets (min and max included).
QUANTILE_POINTS_5 = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
QUANTILE_ACCURACY = 10000
PROFILE_POINTS = [0.0, 0.25, 0.5, 0.75, 1.0]


def _stack(one_row: DataFrame, names: Sequence[str], fields: Sequence[str],
           name_col: str) -> DataFrame:
    """Turn columns ``{name}__{field}`` of a one-row frame into one row per name."""
    parts = ", ".join(
        [f"'{n}', " + ", ".join(f"`{n}__{f}`" for f in fields) for n in names])
    cols = ", ".join([name_col, *fields])
    return one_row.selectExpr(f"stack({len(names)}, {parts}) AS ({cols})")


def field_stats(df: DataFrame, cols: Sequence[str], n: int = 5,
                accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Per column: min, max, non-NULL count and n-quantiles (n + 1 values).

    One scan for all columns (the two-branch UNION ALL becomes one
    aggregate + ``stack``).  Quantiles come from ``percentile_approx``
    (bounded-memory sketch, relative rank error 1/accuracy); a column with
    no values gets NULL quantiles.
    Output: field, min_value, max_value, value_count, quantiles.
    """
    points = F.array(*[F.lit(i / n) for i in range(n + 1)])
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__min_value"), F.max(x).alias(f"{c}__max_value"),
                 F.count(x).alias(f"{c}__value_count"),
                 F.percentile_approx(x, points, accuracy).alias(f"{c}__quantiles")]
    return _stack(df.agg(*aggs), cols, ["min_value", "max_value", "value_count", "quantiles"],
                  "field")


def style_layers(stats: DataFrame) -> DataFrame:
    """Map-style layers: skip empty fields; breakpoints = quantiles without
    the first and last value (empty when fewer than two)."""
    q = F.col("quantiles")
    bps = F.when(F.size(q) >= 2, F.slice(q, 2, F.size(q) - 2)).otherwise(
        F.array().cast("array<double>"))
    return (stats.where((F.col("value_count") > 0) & q.isNotNull())
            .select("field", F.col("min_value").alias("min"), F.col("max_value").alias("max"),
                    F.col("value_count").alias("count"), bps.alias("breakpoints")))


def median_by(df: DataFrame, group: str, value: str, min_count: int = 0,
              top: int | None = None, where: Column | None = None,
              exact: bool = True, accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Median and row count per group; optional HAVING count >= min_count
    and top-N by median (ties broken by group).

    exact=True: :func:`partitioned_median` (rank brackets, no group is
    ever merged in one task; three passes).  exact=False: one-pass
    bounded ``percentile_approx`` sketch.
    """
    from parcelkit.operators.quantiles import partitioned_median
    src = df if where is None else df.where(where)
    src = src.where(F.col(group).isNotNull())
    counts = src.groupBy(group).agg(F.count(F.lit(1)).alias("row_count"))
    if exact:
        out = counts.join(partitioned_median(src, value, [group]), group, "left")
    else:
        out = (src.groupBy(group).agg(F.percentile_approx(value, 0.5, accuracy)
                                      .alias("median_value"),
                                      F.count(F.lit(1)).alias("row_count")))
    out = out.select(group, "median_value", "row_count").where(F.col("row_count") >= min_count)
    if top is not None:
        out = out.orderBy(F.col("median_value").desc(), F.col(group)).limit(top)
    return out


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every pair i < j over complete cases.

    The means come first (a scalar subquery), then ONE aggregate of plain
    sums of centred products, n (n + 1) / 2 of them: no buffer per pair, and
    centring keeps the sums accurate.  Output: var1, var2, corr."""
    cc = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    mean = cc.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    centred = cc.select("*", mean.alias("_m")).select(*[(F.col(c) - F.col(f"_m.{c}")).alias(c) for c in cols])
    every = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = centred.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in every])
    pairs = [(a, b) for a, b in every if a != b]
    corr = {(a, b): F.try_divide(F.col(f"{a}|{b}"), F.sqrt(F.col(f"{a}|{a}")) * F.sqrt(F.col(f"{b}|{b}")))
            for a, b in pairs}
    row = row.select(*[e.alias(f"{a}||{b}") for (a, b), e in corr.items()])
    parts = ", ".join(f"'{a}', '{b}', `{a}||{b}`" for a, b in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {parts}) AS (var1, var2, corr)")


def missing_rate(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Percentage of NULLs per column, only columns with any, descending."""
    cols = list(cols or df.columns)
    row = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in cols])
    parts = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = row.selectExpr(f"stack({len(cols)}, {parts}) AS (variable, missing_pct)")
    return long.where(F.col("missing_pct") > 0).orderBy(F.col("missing_pct").desc(), "variable")


def profile(df: DataFrame, cols: Sequence[str], exact: bool = True,
            accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Summary per numeric column: n, missing, mean, sd, p0/p25/p50/p75/p100.

    Count, missing, mean, sd, min (p0) and max (p100) come from one
    aggregate.  exact=True: p25/p50/p75 are interpolated like R's default
    quantile type, found by :func:`group_quantiles` for all columns in the
    same three passes; no column is ever merged in one task.
    exact=False: ``percentile_approx`` sketches.
    """
    inner = [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.count_if(x.isNull()).alias(f"{c}__n_missing"),
                 F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__sd"),
                 F.min(x).alias(f"{c}__p0"), F.max(x).alias(f"{c}__p100")]
        if not exact:
            approx = F.percentile_approx(x, F.array(*[F.lit(p) for _, p in inner]), accuracy)
            aggs += [approx.alias(f"{c}__approx")]
    row = df.agg(*aggs)
    fields = ["n", "n_missing", "mean", "sd", "p0", "p25", "p50", "p75", "p100"]
    if not exact:
        row = row.select("*", *[F.col(f"{c}__approx")[i].alias(f"{c}__{lbl}")
                                for c in cols for i, (lbl, _) in enumerate(inner)])
        return _stack(row, cols, fields, "variable")
    from parcelkit.operators.quantiles import group_quantiles
    q = group_quantiles(df, {f"{c}__{lbl}": (c, p) for c in cols for lbl, p in inner})
    one = q.select(F.struct("*").alias("q")).scalar()
    row = row.select("*", one.alias("_q")).select("*", "_q.*")
    return _stack(row, cols, fields, "variable")


def histogram(df: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """Equal-width histogram between the column's min and max.

    min/max come from a scalar subquery (one extra, tiny pass).  The top
    edge falls in the last bin.  Output: bin, bin_lower, bin_upper, row_count.
    """
    x = F.col(col).cast("double")
    rng = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = rng["lo"], rng["hi"]
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(width > 0, F.least(F.floor((x - lo) / width), F.lit(bins - 1))).otherwise(0)
    counted = (df.where(x.isNotNull()).select(idx.cast("int").alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("row_count")))
    return counted.select("bin", (lo + F.col("bin") * width).alias("bin_lower"),
                          (lo + (F.col("bin") + 1) * width).alias("bin_upper"), "row_count")


def linear_trend(df: DataFrame, x: str, y: str, where: Column | None = None) -> DataFrame:
    """Least-squares line of y on x, one pass."""
    src = df if where is None else df.where(where)
    return src.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                   F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def sample_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, repeatable: the smallest MD5 of the seed and
    the key, ties by the key.  Every task keeps its n smallest rows and the
    last merge reads n per task; ``n`` is the caller's report size."""
    text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *text))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")


def window_report(df: DataFrame, keep: Column) -> DataFrame:
    """Row counts before and after a filter, one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(keep).alias("rows_after"),
                  (F.count(F.lit(1)) - F.count_if(keep)).alias("rows_removed"))
