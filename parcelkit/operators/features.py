"""Model feature frames, model-input filters, imputation and target
encoding (M1-M3, M8-M10, F1-F4, S4-S7).

A feature frame is a single ``select`` of expressions over a filtered
frame: no shuffle unless bundle removal is part of the version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.functions.casts import safe_double
from parcelkit.functions.scalar import (REF_YEAR, days_since, log1p_safe, prefix_group,
                                        property_age)
from parcelkit.operators.dedupe import drop_bundles
from parcelkit.operators.quantiles import group_modes, group_quantiles

# Residential category descriptions used by train and predict.
MODEL_CATEGORIES = ["SINGLE FAMILY", "MULTI FAMILY", "APARTMENTS > 4 UNITS", "MIXED USE"]
# Residential category codes of the training table and the tile table.
TRAINING_CODES = ["1", "2"]
TILE_CODES = ["1", "2", "8", "13", "14"]
# Price floor/cap of the model filter, training window and range.
PRICE_FLOOR, PRICE_CAP = 1000, 2000000
TRAIN_SINCE = "2020-01-01"
TRAIN_PRICE_MIN, TRAIN_PRICE_MAX = 10000, 3000000
YEAR_BUILT_FLOOR = 1800

_BASE_V0 = ["total_livable_area", "number_of_bedrooms", "number_of_bathrooms",
            "exterior_condition", "interior_condition", "property_age", "days_since_sale",
            "zip_code"]
_DEPLOYED = ["total_livable_area", "log_livable_area", "total_area", "number_of_bedrooms",
             "number_of_bathrooms", "number_stories", "interior_condition",
             "exterior_condition", "property_age", "days_since_sale", "log_days_since_sale",
             "zip_code", "category_code_description", "building_code_description"]
_V2 = ["total_livable_area", "log_livable_area", "total_area", "number_of_bedrooms",
       "number_of_bathrooms", "number_stories", "garage_spaces", "exterior_condition",
       "interior_condition", "property_age", "days_since_sale", "log_days_since_sale",
       "zip_code", "category_code_description", "building_code_description",
       "geographic_ward", "quality_grade"]

# version -> (features, price cap?, drop bundles?, category filter?)
FEATURE_VERSIONS = {
    "v0": (_BASE_V0, False, False, False),
    "v1": (_BASE_V0, True, True, False),
    "v2": (_V2, True, True, False),
    "v3": (_V2, True, True, True),
    "deployed": (_DEPLOYED, True, False, True),
}
CATEGORICAL = {"zip_code", "category_code_description", "building_code_description",
               "geographic_ward", "quality_grade"}


def feature_exprs(as_of: str | None = None, ref_year: int = REF_YEAR) -> dict[str, Column]:
    days = days_since("sale_date", as_of)
    return {
        "total_livable_area": F.col("total_livable_area").cast("double"),
        "log_livable_area": log1p_safe("total_livable_area"),
        "total_area": F.col("total_area").cast("double"),
        "number_of_bedrooms": F.col("number_of_bedrooms").cast("double"),
        "number_of_bathrooms": F.col("number_of_bathrooms").cast("double"),
        "number_stories": F.col("number_stories").cast("double"),
        "garage_spaces": F.col("garage_spaces").cast("double"),
        "exterior_condition": safe_double("exterior_condition"),
        "interior_condition": safe_double("interior_condition"),
        "property_age": property_age("year_built", ref_year),
        "days_since_sale": days,
        "log_days_since_sale": log1p_safe(days),
        "zip_code": F.col("zip_code"),
        "category_code_description": F.col("category_code_description"),
        "building_code_description": F.col("building_code_description"),
        "geographic_ward": F.col("geographic_ward"),
        "quality_grade": F.col("quality_grade"),
    }


def model_input_filter(price_cap: bool = True, categories: Sequence[str] | None = MODEL_CATEGORIES,
                       label: str = "sale_price") -> Column:
    """Conjunctive train-time filter on the label and required inputs."""
    p = F.col(label)
    cond = (p.isNotNull() & (p > PRICE_FLOOR) & F.col("total_livable_area").isNotNull()
            & F.col("year_built").isNotNull() & F.col("sale_date").isNotNull())
    if price_cap:
        cond = cond & (p < PRICE_CAP)
    if categories is not None:
        cond = cond & F.col("category_code_description").isin(list(categories))
    return cond


def predict_input_filter(categories: Sequence[str] = MODEL_CATEGORIES) -> Column:
    a, y = F.col("total_livable_area"), F.col("year_built")
    return (a.isNotNull() & (a > 0) & y.isNotNull() & (y > YEAR_BUILT_FLOOR)
            & F.col("sale_date").isNotNull() & F.col("category_code_description").isin(list(categories)))


def feature_frame(df: DataFrame, version: str = "deployed", as_of: str | None = None,
                  ref_year: int = REF_YEAR, label: str | None = "sale_price",
                  keep: Sequence[str] = (), for_predict: bool = False) -> DataFrame:
    """Model-version feature frame: filter ladder (floor, cap, bundles,
    categories) then one projection of feature expressions.  Bundles are
    removed from training rows only: every eligible property is scored."""
    feats, cap, bundles, cats = FEATURE_VERSIONS[version]
    src = drop_bundles(df, ("sale_price", "sale_date")) if bundles and not for_predict else df
    if for_predict:
        src = src.where(predict_input_filter())
    else:
        src = src.where(model_input_filter(cap, MODEL_CATEGORIES if cats else None))
    ex = feature_exprs(as_of, ref_year)
    head = [F.col(k) for k in keep] + ([F.col(label).cast("double").alias(label)]
                                       if label and not for_predict else [])
    return src.select(*head, *[ex[f].alias(f) for f in feats])


def training_rows(df: DataFrame, since: str = TRAIN_SINCE,
                  price_between=(TRAIN_PRICE_MIN, TRAIN_PRICE_MAX),
                  codes: Sequence[str] = TRAINING_CODES) -> DataFrame:
    """Arm's-length sales for training: window filters, then bundles found
    *inside* the window removed by anti-join (NOT EXISTS semantics)."""
    p, d = F.col("sale_price"), F.col("sale_date")
    scope = (p.isNotNull() & d.isNotNull() & (d >= F.to_date(F.lit(since)))
             & p.between(*price_between) & F.col("category_code").isin(list(codes)))
    cols = ["property_id", "sale_price", "sale_date", "total_livable_area", "total_area",
            "number_of_bedrooms", "number_of_bathrooms", "number_stories", "year_built",
            "zip_code", "category_code_description", "building_code_description",
            "interior_condition", "exterior_condition"]
    scoped = df.where(scope)
    return drop_bundles(scoped, ("sale_price", "sale_date"), mode="anti").select(*cols)


def impute(df: DataFrame, plan: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Fill NULLs per column: ("zero", None), ("median", by), ("mode", None).

    Medians are exact, by rank brackets (:func:`group_quantiles`): one row per
    group for all columns with the same ``by``, joined back on the group key,
    and one row for the whole table, used as a scalar subquery (the fallback
    for NULL and unseen groups).  Modes come from one partial count per
    (column, value); of equal counts the smallest value wins.  No group and no
    column is ever held in one buffer.
    """
    dtypes = dict(df.dtypes)
    by_groups: dict[str, dict] = {}
    overall, modes = {}, []
    for c, (how, by) in plan.items():
        if how == "median":
            overall[c] = (c, 0.5)
            if by:
                by_groups.setdefault(by, {})[f"_{by}_{c}_med"] = (c, 0.5)
        elif how == "mode":
            modes.append(c)
        elif how != "zero":
            raise ValueError(how)
    glob = group_quantiles(df, overall).select(F.struct("*").alias("g")).scalar() if overall else None
    mode = group_modes(df, modes).select(F.struct("*").alias("g")).scalar() if modes else None
    out = df
    if glob is not None:
        out = out.withColumn("_glob", glob)
    if mode is not None:
        out = out.withColumn("_mode", mode)
    for by, items in by_groups.items():
        out = out.join(group_quantiles(df.where(F.col(by).isNotNull()), items, [by]), on=by, how="left")
    fills = []
    for c in df.columns:
        if c not in plan:
            fills.append(F.col(c))
            continue
        how, by = plan[c]
        if how == "zero":
            e = F.coalesce(F.col(c), F.lit(0).cast(dtypes[c])).cast(dtypes[c])
        elif how == "median":
            e = F.coalesce(F.col(c), *([F.col(f"_{by}_{c}_med")] if by else []), F.col(f"_glob.{c}"))
        else:
            e = F.coalesce(F.col(c), F.col(f"_mode.{c}")).cast(dtypes[c])
        fills.append(e.alias(c))
    return out.select(*fills)


def target_encode(df: DataFrame, col: str, label: str, out: str | None = None) -> DataFrame:
    """Replace a category by the mean label of its group (global mean for
    NULL or unseen groups).  Group means: one partial aggregate joined back."""
    out = out or f"{col}_te"
    means = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.avg(label).alias("_te"))
    glob = df.select(F.avg(label)).scalar()
    return (df.join(means, on=col, how="left")
            .withColumn(out, F.coalesce(F.col("_te"), glob)).drop("_te"))


def target_encode_cv(df: DataFrame, col: str, label: str, key: str, folds: int = 5, smoothing: float = 10.0,
                     out: str | None = None) -> DataFrame:
    """Mean label of a row's category over the *other* folds, drawn to their overall mean by ``smoothing`` rows:
    no row's own label is in its code.  Folds go by a hash of ``key``, which SQL can repeat.

    One partial aggregate over (category, fold); the sums of the other folds are totals less the fold's own, so the
    table is not passed once for each fold.  A NULL category, or one that no other fold has, gets the overall mean."""
    out = out or f"{col}_te"
    fold = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 6), 16, 10).cast("int") % folds
    rows = df.withColumn("_fold", fold)
    y = F.col(label).cast("double")
    part = rows.groupBy(col, "_fold").agg(F.sum(y).alias("s"), F.count(y).alias("n"))
    every = Window.partitionBy(F.lit(None).cast("int"))
    by_fold = part.groupBy("_fold").agg(F.sum("s").alias("fs"), F.sum("n").alias("fn")).select(
        "_fold", ((F.sum("fs").over(every) - F.col("fs")) / F.nullif(F.sum("fn").over(every) - F.col("fn"), F.lit(0))).alias("_mean"))
    total = part.where(F.col(col).isNotNull()).groupBy(col).agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    others = F.col("ts") - F.coalesce("s", F.lit(0.0)) + F.lit(smoothing) * F.col("_mean")
    codes = part.join(total, col).join(by_fold, "_fold").select(
        col, "_fold", F.try_divide(others, F.col("tn") - F.col("n") + F.lit(smoothing)).alias("_te"))
    return (rows.join(codes, [col, "_fold"], "left").join(by_fold, "_fold", "left")
            .withColumn(out, F.coalesce("_te", "_mean")).select(*df.columns, out))


# The imputation plan of the feature notes.
IMPUTE_PLAN = {
    "garage_spaces": ("zero", None),
    "fireplaces": ("zero", None),
    "number_of_bathrooms": ("median", "zip_code"),
    "number_of_bedrooms": ("median", "zip_code"),
    "total_livable_area": ("median", "building_code_description"),
    "exterior_condition": ("mode", None),
    "interior_condition": ("mode", None),
    "year_built": ("median", "zip_code"),
}


def assessment_inputs(df: DataFrame, as_of: str | None = None, ref_year: int = REF_YEAR,
                      label: str = "sale_price") -> DataFrame:
    """Assessment inputs table: 10 numeric features + target-encoded zip +
    zoning group, after the imputation plan."""
    typed = df.select(
        "property_id", "zip_code", "zoning", "building_code_description", "total_area",
        "sale_date", F.col(label).cast("double").alias(label),
        F.col("garage_spaces").cast("double").alias("garage_spaces"),
        safe_double("fireplaces").alias("fireplaces"),
        F.col("number_of_bathrooms").cast("double").alias("number_of_bathrooms"),
        F.col("number_of_bedrooms").cast("double").alias("number_of_bedrooms"),
        F.col("total_livable_area").cast("double").alias("total_livable_area"),
        safe_double("exterior_condition").alias("exterior_condition"),
        safe_double("interior_condition").alias("interior_condition"),
        F.col("year_built").cast("double").alias("year_built"))
    filled = impute(typed, IMPUTE_PLAN)
    enc = target_encode(filled, "zip_code", label, "zip_code_te")
    return enc.select(
        "property_id",
        log1p_safe("total_livable_area").alias("log_livable_area"),
        property_age("year_built", ref_year).alias("property_age"),
        days_since("sale_date", as_of).alias("days_since_sale"),
        "number_of_bathrooms", "number_of_bedrooms", "exterior_condition",
        "interior_condition", "garage_spaces", "fireplaces",
        F.col("total_area").cast("double").alias("total_area"),
        "zip_code_te", prefix_group("zoning").alias("zoning_group"))
