"""Per-property value change, classes and breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.functions.scalar import (both_positive, category_label, dollar_change_class,
                                        js_round, pct_change_class, value_class)

# Discrepancy slider range and default, year-change flag threshold.
DISCREPANCY_THRESHOLDS = list(range(5, 61, 5))
DISCREPANCY_DEFAULT = 20
YOY_THRESHOLD_PCT = 10


def _ratio(cur: str, tax: str) -> Column:
    return (F.col(cur) - F.col(tax)) / F.col(tax)


def discrepancy(df: DataFrame, cur: str = "current_assessed_value",
                tax: str = "tax_year_assessed_value", threshold_pct: float = DISCREPANCY_DEFAULT) -> DataFrame:
    """Rows where both values are positive and |cur - tax| / tax >= t%."""
    keep = both_positive(cur, tax) & (F.abs(_ratio(cur, tax)) >= F.lit(threshold_pct) / F.lit(100))
    return df.where(keep)


def discrepancy_counts(df: DataFrame, cur: str = "current_assessed_value",
                       tax: str = "tax_year_assessed_value",
                       thresholds: Sequence[int] = DISCREPANCY_THRESHOLDS) -> DataFrame:
    """Rows kept at every slider threshold, one scan (conditional counts)."""
    r = F.when(both_positive(cur, tax), F.abs(_ratio(cur, tax)))
    row = df.agg(*[F.count_if(r >= F.lit(t) / F.lit(100)).alias(f"t{t}") for t in thresholds])
    parts = ", ".join(f"{t}, t{t}" for t in thresholds)
    return row.selectExpr(f"stack({len(thresholds)}, {parts}) AS (threshold_pct, property_count)")


def yoy_change(df: DataFrame, key: str, order: str, value: str,
               threshold: float = YOY_THRESHOLD_PCT) -> DataFrame:
    """Change against the previous row of the same key ((key, order) unique).

    Missing values count as 0; no change when either side is 0.  ``flagged``
    when |pct| >= threshold; ``pct_label`` rounds half towards +infinity.
    One lag window per key: the input has one row per (key, order), a year,
    so a key's window is as long as the list of years.  Rows with a NULL key
    are one series of their own.
    """
    cur = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    with_prev = df.select("*", cur.alias("_cur")).withColumn(
        "prev_value", F.lag("_cur").over(Window.partitionBy(key).orderBy(order)))
    ok = F.col("prev_value").isNotNull() & (F.col("prev_value") != 0) & (F.col("_cur") != 0)
    pct = F.when(ok, (F.col("_cur") - F.col("prev_value")) / F.col("prev_value") * F.lit(100.0))
    return (with_prev.withColumn("pct_change", pct)
            .withColumn("flagged", F.coalesce(F.abs(F.col("pct_change")) >= threshold, F.lit(False)))
            .withColumn("pct_label", F.when(F.col("flagged"), js_round(F.col("pct_change"))))
            .drop("_cur"))


def exempt_flags(df: DataFrame, key: str = "property_id") -> DataFrame:
    """Per key: whether any row has a positive exempt amount (partial ``bool_or``)."""
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.groupBy(key).agg(F.bool_or(z("exempt_land") + z("exempt_building") > 0).alias("has_exempt"))


def value_breakdown(df: DataFrame, key: str = "property_id") -> DataFrame:
    """Taxable land / building, exempt = land + building (missing as 0), and
    whether the key has any positive exempt amount.

    The flag is :func:`exempt_flags` joined back where NULL matches NULL
    (not a window), so a key with very many rows is reduced map-side."""
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    out = df.select("*", z("taxable_land").alias("taxable_land_value"),
                    z("taxable_building").alias("taxable_building_value"),
                    (z("exempt_land") + z("exempt_building")).alias("exempt_value"))
    flag = exempt_flags(df, key).withColumnRenamed(key, "_flag_key")
    return out.join(flag, out[key].eqNullSafe(flag["_flag_key"]), "left").drop("_flag_key")


def value_per_area(df: DataFrame, value: str = "market_value",
                   area: str = "total_livable_area") -> DataFrame:
    a = F.coalesce(F.col(area).cast("double"), F.lit(0.0))
    v = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    return df.withColumn("value_per_area", F.when(a > 0, js_round(v / a)))


def with_category_label(df: DataFrame, code: str = "category_code") -> DataFrame:
    return df.withColumn("category_label", category_label(F.coalesce(F.col(code).cast("string"),
                                                                     F.lit("null"))))


def assessment_change(df: DataFrame, cur: str = "current_assessed_value",
                      tax: str = "tax_year_assessed_value") -> DataFrame:
    ok = both_positive(cur, tax)
    return (df.withColumn("dollar_change", F.when(ok, F.col(cur) - F.col(tax)))
            .withColumn("pct_change", F.when(ok, _ratio(cur, tax) * F.lit(100.0))))


def change_classes(df: DataFrame, cur: str = "current_assessed_value",
                   tax: str = "tax_year_assessed_value",
                   cur_breakpoints: Column | Sequence[float] | None = None,
                   tax_breakpoints: Column | Sequence[float] | None = None) -> DataFrame:
    """Value classes for both values and the two change classes."""
    from parcelkit.functions.scalar import (VALUE_BREAKPOINTS_CURRENT,
                                            VALUE_BREAKPOINTS_TAX_YEAR, step_class)

    def vclass(c: str, bps, default):
        if bps is None:
            return value_class(c, default)
        if isinstance(bps, Column):
            v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            return F.aggregate(bps, F.lit(0), lambda acc, b: acc + F.when(v >= b, 1).otherwise(0))
        return step_class(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), bps)

    return df.select("*", vclass(cur, cur_breakpoints, VALUE_BREAKPOINTS_CURRENT).alias("current_class"),
                     vclass(tax, tax_breakpoints, VALUE_BREAKPOINTS_TAX_YEAR).alias("tax_year_class"),
                     pct_change_class(cur, tax).alias("pct_class"),
                     dollar_change_class(cur, tax).alias("dollar_class"))
