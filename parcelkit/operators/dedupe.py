"""Latest row per key, bundle-sale removal and first-wins de-duplication
(W1, W2, A2, J3, J4, A16, F7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list:
    return [xs] if isinstance(xs, (str, Column)) else list(xs)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                   tie: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Keep the row with the greatest ``order`` (then ``tie``) per key.

    ``ROW_NUMBER() = 1`` lets Spark insert a partial WindowGroupLimit
    before the shuffle, so each map task ships at most one row per key: a
    hot key cannot pile up in one reducer.  ``where`` filters before the
    ranking (rows failing it can never be the latest).
    """
    src = df if where is None else df.where(where)
    ordering = [F.col(c).desc() for c in _cols(order) + list(tie)]
    w = Window.partitionBy(*_cols(keys)).orderBy(*ordering)
    return (src.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First-wins de-duplication: the smallest ``order`` per key survives."""
    ordering = [F.col(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*_cols(keys)).orderBy(*ordering)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def bundle_keys(df: DataFrame, keys: Sequence[str] = ("sale_price", "sale_date"),
                scope: Column | None = None) -> DataFrame:
    """Keys shared by more than one row (``GROUP BY keys HAVING COUNT(*) > 1``).

    Only key columns are shuffled, with map-side partial counts.
    """
    src = df if scope is None else df.where(scope)
    nn = None
    for k in keys:
        c = F.col(k).isNotNull()
        nn = c if nn is None else nn & c
    return (src.where(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1).drop("_n"))


def drop_bundles(df: DataFrame, keys: Sequence[str] = ("sale_price", "sale_date"),
                 scope: Column | None = None, mode: str = "anti") -> DataFrame:
    """Remove rows whose key is shared with another row.

    mode="anti":   anti-join against :func:`bundle_keys` (NULL keys never
                   match, so rows with a NULL key are kept).  ``scope``
                   restricts which rows *define* bundles.
    mode="window": keep rows alone in their key group (``count(*) over
                   (partition by keys) = 1``); NULL keys form a group like
                   any other value.  Planned as a partially aggregated
                   count per key + null-safe anti-join with the few shared
                   keys, not as a window, so a hot key is counted map-side
                   and its rows are split by AQE's skew handling instead
                   of sorted in one task.
    The anti-join ships only duplicate keys to the join; AQE turns it into
    a broadcast join when they are few and splits skewed partitions.
    """
    if mode == "anti":
        return df.join(bundle_keys(df, keys, scope), list(keys), "left_anti")
    if mode == "window":
        src = df if scope is None else df.where(scope)
        shared = (src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") > 1).select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
        cond = None
        for k in keys:
            c = src[k].eqNullSafe(shared[f"_k_{k}"])
            cond = c if cond is None else cond & c
        return src.join(shared, cond, "left_anti")
    raise ValueError(f"unknown mode {mode!r}")


def latest_group_rows(df: DataFrame, group: str) -> DataFrame:
    """Rows whose ``group`` equals the global maximum (scalar subquery,
    handed to the scan as a runtime filter)."""
    return df.where(F.col(group) == df.select(F.max(group)).scalar())
