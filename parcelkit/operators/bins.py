"""Fixed-width value bins and the calculations done on bin tables
(S10, A1, F5, W3, D1-D4, D13, A14, A15, W5).

Bin tables are aggregates: their size is (groups x value range / width),
independent of row count, so windows over them are cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.functions.scalar import js_round, value_bin_lower, value_bin_lower_decimal

# Bin width, chart cap and the year-significance thresholds.
BIN_WIDTH = 50000
CHART_CAP = 2000000
YEAR_MIN_TOTAL = 10000
YEAR_SELECTABLE_TOTAL = 100000
YEAR_SELECTABLE_LAST = 4
SHIFT_BAND_PCT = 5


def value_bins(df: DataFrame, value: str, width: int = BIN_WIDTH,
               by: Sequence[str] = ()) -> DataFrame:
    """Count rows per fixed-width bin of ``value`` (NULL and negative dropped).

    Output: ``*by, lower_bound, upper_bound, property_count``.  One shuffle
    keyed by (by, lower_bound), with map-side partial counts.
    """
    v = F.col(value)
    is_decimal = dict(df.dtypes)[value].startswith("decimal")
    lower = value_bin_lower_decimal(v, width) if is_decimal else value_bin_lower(v, width)
    return (df.where(v.isNotNull() & (v >= 0))
            .select(*by, lower.alias("lower_bound"))
            .groupBy(*by, "lower_bound")
            .agg(F.count(F.lit(1)).alias("property_count"))
            .select(*by, "lower_bound",
                    (F.col("lower_bound") + F.lit(width)).alias("upper_bound"),
                    "property_count"))


def binned_median(bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Median estimated from bins: first bin whose running count reaches
    half the total, interpolated linearly inside that bin.

    Zero-count bins are ignored.  Output: ``*by, property_total, median_value``.
    """
    b = bins.where(F.col("property_count") > 0)
    grp = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    run = grp.orderBy("lower_bound").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cnt = F.col("property_count")
    half = F.sum(cnt).over(grp) / F.lit(2.0)
    with_cum = b.select(*by, "lower_bound", "upper_bound", cnt,
                        F.sum(cnt).over(grp).alias("property_total"),
                        F.sum(cnt).over(run).alias("cum"), half.alias("half"))
    frac = (F.col("cum") - F.col("half")) / F.col("property_count")
    est = F.col("lower_bound") + (F.col("upper_bound") - F.col("lower_bound")) * (F.lit(1.0) - frac)
    return (with_cum.where(F.col("cum") >= F.col("half"))
            .groupBy(*by)
            .agg(F.first("property_total").alias("property_total"),
                 F.min_by(est, F.col("lower_bound")).alias("median_value")))


def chart_bins(bins: DataFrame, year_col: str | None = "tax_year", year: int | None = None,
               cap: int = CHART_CAP) -> DataFrame:
    """Bins of one year (the latest when ``year`` is None) below the cap."""
    out = bins.where(F.col("lower_bound") < cap)
    if year_col is not None:
        target = F.lit(year) if year is not None else bins.select(F.max(year_col)).scalar()
        out = out.where(F.col(year_col) == target)
    return out


def year_overview(bins: DataFrame, year_col: str = "tax_year") -> DataFrame:
    """Per year: total over non-empty bins, binned median, the year's
    position among all years (1 = most recent) and the number of years."""
    med = binned_median(bins, by=[year_col])
    return med.select(year_col, "property_total", "median_value",
                      F.dense_rank().over(Window.orderBy(F.col(year_col).desc()))
                      .alias("recency_rank"),
                      F.count(F.lit(1)).over(Window.partitionBy()).alias("year_count"))


def significant_years(bins: DataFrame, year_col: str = "tax_year",
                      min_total: int = YEAR_MIN_TOTAL,
                      selectable_total: int = YEAR_SELECTABLE_TOTAL,
                      last: int = YEAR_SELECTABLE_LAST) -> DataFrame:
    """Years whose bin total exceeds ``min_total``; ``selectable`` marks the
    most recent ``last`` of those whose total exceeds ``selectable_total``.

    The window runs over one row per year.
    """
    totals = (bins.groupBy(year_col).agg(F.sum("property_count").alias("property_total"))
              .where(F.col("property_total") > min_total))
    big = F.col("property_total") > selectable_total
    rank = F.sum(F.when(big, 1).otherwise(0)).over(
        Window.orderBy(F.col(year_col).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return totals.select(year_col, "property_total", (big & (rank <= last)).alias("selectable"))


def breakpoint_median(breakpoints: Column) -> Column:
    """Model median estimated from quintile breakpoints: the rounded mean of
    the 2nd and 3rd breakpoint (40th and 60th percentile); NULL when fewer
    than three breakpoints exist."""
    return F.when(F.size(breakpoints) >= 3,
                  js_round((breakpoints[1] + breakpoints[2]) / F.lit(2.0)))


def layer_model_median(layers: DataFrame, field: str = "current_assessed_value") -> Column:
    """Scalar subquery: :func:`breakpoint_median` of one style layer."""
    return (layers.where(F.col("field") == field)
            .select(breakpoint_median(F.col("breakpoints"))).scalar())


def market_shift(overview: DataFrame, model_median: Column,
                 band: float = SHIFT_BAND_PCT) -> DataFrame:
    """Compare a model median with each year's official binned median and
    classify the shift in % (above / below / neutral within +-band).

    ``model_median`` is a scalar column, typically
    :func:`layer_model_median` (one scalar subquery, reused).
    """
    model = model_median
    official = F.col("median_value")
    shift = (model - official) / official * F.lit(100.0)
    cls = (F.when(shift > band, "above").when(shift < -band, "below")
           .when(shift.isNotNull(), "neutral"))
    return overview.select("*", model.alias("model_median"), shift.alias("shift_pct"),
                           cls.alias("shift_class"))
