"""Random-forest regression: train and predict (M4-M7, P5).

Training is Spark ML's distributed forest (per-node histograms merged
with treeAggregate); categorical columns go through StringIndexer with
``handleInvalid='keep'`` (unseen categories at predict time get their own
index), numeric columns through a median Imputer (approximate quantiles,
distributed).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.operators.quantiles import group_quantiles

# Deployed forest settings and the automatic split.
NUM_TREES, MAX_DEPTH, SUBSAMPLE = 200, 10, 0.8
# Fixed values: (trees, depth) of each model version.
FOREST_SETTINGS = {"v0": (100, 8), "v1": (100, 8), "v2": (100, 8), "v3": (200, 10), "deployed": (200, 10)}
EVAL_FRACTION = 0.2


def held_out(key: str | Column, fraction: float = EVAL_FRACTION, seed: int = 0) -> Column:
    """Whether a row is held out: by a hash of its key, so that SQL, and every later run, makes the same split."""
    k = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), k.cast("string"))), 1, 6)
    return F.conv(digits, 16, 10).cast("long") % 1000 < int(fraction * 1000)


def fit_forest(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
               label: str = "sale_price", trees: int = NUM_TREES, depth: int = MAX_DEPTH,
               subsample: float = SUBSAMPLE, seed: int = 0,
               eval_fraction: float = EVAL_FRACTION,
               key: str | None = None) -> tuple[PipelineModel | None, DataFrame | None]:
    """Fit indexers + imputer + assembler + forest.  With ``eval_fraction``
    > 0 a split is held out (the automatic split) and returned for evaluation: by a hash of
    ``key`` (``held_out``), or a seeded random one without a key.  No row to fit on: no model (None).
    A numeric column without any value in the rows has no median and is left out."""
    # Materialise the training rows once in the shared checkpoint folder:
    # the indexer, imputer and every tree level read them again, and a lost
    # executor then re-reads the checkpoint instead of recomputing joins.
    data = train.where(F.col(label).isNotNull()).checkpoint(eager=True)
    if eval_fraction and eval_fraction > 0 and key:
        out = F.coalesce(held_out(key, eval_fraction, seed), F.lit(False))
        fit_part, eval_part = data.where(~out), data.where(out)
    elif eval_fraction and eval_fraction > 0:
        fit_part, eval_part = data.randomSplit([1 - eval_fraction, eval_fraction], seed)
    else:
        fit_part, eval_part = data, None
    values = [F.count(F.when(~F.isnan(c), F.col(c))).alias(c) for c in numeric]
    found = fit_part.agg(F.count(F.lit(1)), *values).first()
    if not found[0]:
        return None, eval_part
    numeric = [c for c, n in zip(numeric, found[1:], strict=True) if n]
    idx_models = []
    max_cats = 2
    if categorical:
        # one multi-column indexer: a single pass over the data for all labels
        indexer = StringIndexer(inputCols=list(categorical),
                                outputCols=[f"{c}__idx" for c in categorical], handleInvalid="keep")
        idx_model = indexer.fit(fit_part)
        idx_models = [idx_model]
        # maxBins must cover the largest category count (+1 for the unseen bucket).
        max_cats = max(len(lbls) + 1 for lbls in idx_model.labelsArray)
    imputed = [f"{c}__imp" for c in numeric]
    stages = list(idx_models) + ([Imputer(inputCols=list(numeric), outputCols=imputed, strategy="median")] if numeric else []) + [
        VectorAssembler(inputCols=imputed + [f"{c}__idx" for c in categorical],
                        outputCol="features", handleInvalid="keep"),
        RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees,
                              maxDepth=depth, subsamplingRate=subsample, seed=seed,
                              maxBins=max(32, max_cats), featureSubsetStrategy="onethird",
                              checkpointInterval=10, cacheNodeIds=True),
    ]
    model = Pipeline(stages=stages).fit(fit_part)
    return model, eval_part


def with_prediction(model: PipelineModel | None, df: DataFrame) -> DataFrame:
    """``df`` with its ``prediction``: NULL without a model."""
    return df.withColumn("prediction", F.lit(None).cast("double")) if model is None else model.transform(df)


def predict(model: PipelineModel | None, df: DataFrame, key: str = "property_id",
            run_at: str | None = None) -> DataFrame:
    """property_id, predicted_value, predicted_at for every input row."""
    at = F.current_timestamp() if run_at is None else F.to_timestamp(F.lit(run_at))
    return with_prediction(model, df).select(key, F.col("prediction").alias("predicted_value"),
                                      at.alias("predicted_at"))


def fit_version(train: DataFrame, version: str = "deployed", key: str = "property_id", label: str = "sale_price",
                seed: int = 0, trees: int | None = None, depth: int | None = None,
                eval_fraction: float = EVAL_FRACTION) -> tuple[PipelineModel | None, DataFrame | None]:
    """The forest of a model version on its feature frame (with ``key``): text columns are its categories."""
    settings = FOREST_SETTINGS[version]
    text = [c for c, t in train.dtypes if t == "string" and c not in (key, label)]
    numeric = [c for c in train.columns if c not in (*text, key, label)]
    return fit_forest(train, numeric, text, label, trees or settings[0], depth or settings[1], seed=seed,
                      eval_fraction=eval_fraction, key=key)


def regression_metrics(scored: DataFrame, label: str = "sale_price", prediction: str = "predicted_value",
                       constant: float | None = None, groups: dict[str, Column] | None = None) -> DataFrame:
    """One row for all rows with label and prediction, and one for each value of each grouping: ``grouping``,
    ``value``, ``n_rows``, ``rmse``, ``mae``, ``bias``, ``r2`` and ``constant_rmse``, the error of predicting
    ``constant`` (the training rows' mean; the rows' own mean if it is not given).  One aggregate, combined before the shuffle."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    kinds = {"all": F.lit("all")} | (groups or {})
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("grouping"), v.cast("string").alias("value")) for k, v in kinds.items()]))
    rows = scored.where(y.isNotNull() & p.isNotNull()).select(y.alias("y"), (p - y).alias("err"), each.alias("g"))
    flat = F.sqrt(F.avg(F.pow(F.col("y") - F.lit(constant), 2))) if constant is not None else F.stddev_pop("y")
    return rows.groupBy("g.grouping", "g.value").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("rmse"),
        F.avg(F.abs("err")).alias("mae"), F.avg("err").alias("bias"),
        (F.lit(1.0) - F.try_divide(F.avg(F.col("err") * F.col("err")), F.var_pop("y"))).alias("r2"), flat.alias("constant_rmse"))


def value_deciles(scored: DataFrame, label: str = "sale_price") -> Column:
    """Decile (1 to 10) of the label, by exact quantiles of the given rows: nine numbers from one aggregate."""
    items = {f"d{i}": (label, i / 10) for i in range(1, 10)}
    edges = group_quantiles(scored, items).first()
    over = [F.when(F.col(label) > F.lit(edges[f"d{i}"]), 1).otherwise(0) for i in range(1, 10)]
    return reduce(lambda a, b: a + b, over, F.lit(1))


def evaluate(model: PipelineModel | None, held_out_rows: DataFrame, constant: float | None, label: str = "sale_price",
             groups: dict[str, Column] | None = None) -> DataFrame:
    """Metrics of a forest on held-out rows, beside those of a constant."""
    return regression_metrics(with_prediction(model, held_out_rows), label, "prediction", constant, groups)


def rmse(model: PipelineModel, df: DataFrame, label: str = "sale_price") -> DataFrame:
    err = F.col("prediction") - F.col(label)
    return model.transform(df).agg(F.sqrt(F.avg(err * err)).alias("rmse"),
                                   F.count(F.lit(1)).alias("n"))
