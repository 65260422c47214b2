"""Forest: shape, determinism by seed, unseen categories, better than a constant."""

from pyspark.sql import functions as F

from parcelkit.operators import features as FE
from parcelkit.operators.model import fit_forest, predict, rmse
from parcelkit.plans import fixtures as X

SF = "/root/testdata/sf0.01"
CATS = ["zip_code", "category_code_description", "building_code_description"]


def _train(spark):
    s = X.fx_sale(spark, SF)
    train = FE.feature_frame(FE.training_rows(s), "deployed", X.AS_OF)
    # a learnable target: price driven by area (plus the fixture's own price)
    train = train.withColumn("sale_price", F.col("total_livable_area") * 100 + F.col("sale_price") * 0.01)
    nums = [c for c in train.columns if c not in CATS and c != "sale_price"]
    return s, train, nums


def test_forest_shape_determinism_and_error(spark):
    s, train, nums = _train(spark)
    m1, ev = fit_forest(train, nums, CATS, trees=8, depth=5, seed=3)
    m2, _ = fit_forest(train, nums, CATS, trees=8, depth=5, seed=3)
    score = FE.feature_frame(s, "deployed", X.AS_OF, label=None, keep=["property_id"],
                             for_predict=True)
    p1 = predict(m1, score, run_at=X.RUN_AT)
    assert p1.columns == ["property_id", "predicted_value", "predicted_at"]
    assert p1.where(F.col("predicted_value").isNull()).count() == 0
    a = sorted((r.property_id, r.predicted_value) for r in p1.collect())
    b = sorted((r.property_id, r.predicted_value) for r in predict(m2, score).collect())
    assert len(a) == len(b) and all(x[0] == y[0] and abs(x[1] - y[1]) < 1e-9 for x, y in zip(a, b))
    err = rmse(m1, ev).collect()[0].rmse
    mean = ev.agg(F.avg("sale_price")).collect()[0][0]
    base = ev.agg(F.sqrt(F.avg((F.col("sale_price") - mean) ** 2))).collect()[0][0]
    assert err < base


def test_unseen_category_and_null_numeric(spark):
    s, train, nums = _train(spark)
    m, _ = fit_forest(train, nums, CATS, trees=3, depth=3, seed=1, eval_fraction=0)
    row = train.limit(1).withColumn("zip_code", F.lit("99999")).withColumn(
        "total_area", F.lit(None).cast("double")).withColumn("property_id", F.lit("x"))
    out = predict(m, row).collect()
    assert len(out) == 1 and out[0].predicted_value is not None


def _all_bundles(spark, folder):
    """A lineitem table in which every sale shares its price and date with another one."""
    rows = spark.range(400).selectExpr(
        "id DIV 7 AS l_orderkey", "id * 31 % 200 AS l_partkey", "id % 10 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "20D AS l_quantity", "30000D + id AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'N' AS l_returnflag",
        "'O' AS l_linestatus", "TIMESTAMP'1996-09-13' AS l_shipdate")
    rows.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_without_training_rows_every_property_is_listed(spark, tmp_path):
    from parcelkit.plans.queries import REGISTRY
    d = _all_bundles(spark, tmp_path / "t")
    assert REGISTRY["training_data"](spark, d).count() == 0
    s = X.fx_sale(spark, d)
    score = FE.feature_frame(s, "deployed", X.AS_OF, label=None, keep=["property_id"], for_predict=True)
    want = sorted(r.property_id for r in score.collect())
    preds = REGISTRY["rf_train_predict"](spark, d).collect()
    assert want and sorted(r.property_id for r in preds) == want and {r.predicted_value for r in preds} == {None}
    checks = REGISTRY["rf_checks"](spark, d).collect()
    assert sorted(r.property_id for r in checks) == want
    assert {r.in_label_range for r in checks} == {False} and not any(r.beats_constant for r in checks)


def test_numeric_column_without_values_is_left_out(spark):
    _, train, nums = _train(spark)
    empty = train.withColumn("total_area", F.lit(None).cast("double"))
    m, _ = fit_forest(empty, nums, CATS, trees=2, depth=3, seed=1, eval_fraction=0)
    out = predict(m, train.limit(1).withColumn("property_id", F.lit("x"))).collect()
    assert len(out) == 1 and out[0].predicted_value is not None
