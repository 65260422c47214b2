"""Plan-shape checks: the physical strategy we rely on at scale."""

SF_SMALL = "/root/testdata/sf0.001"

import __spark_entry__ as E


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_anti_join_is_left_anti(spark):
    p = optimized_of(E.queries()["bundle_anti_left"](spark, SF_SMALL))
    assert "LeftAnti" in p


def test_latest_row_has_partial_group_limit(spark):
    p = plan_of(E.queries()["latest_per_key"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_field_stats_scans_once(spark):
    p = plan_of(E.queries()["field_stats"](spark, SF_SMALL))
    # tile_info reads orders twice (latest year subquery + rows), nothing else repeats
    assert p.count("customer.parquet") == 2  # properties + parcels
    assert "Union" not in p


def test_scan_prunes_columns_and_pushes_filters(spark, tmp_path):
    """On a written core table the model filter reaches the scan and only used columns are read."""
    from parcelkit.operators import features as FE
    from parcelkit.plans import fixtures as X
    X.fx_sale(spark, SF_SMALL).write.parquet(str(tmp_path / "core"))
    core = spark.read.parquet(str(tmp_path / "core"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = plan_of(core.where(FE.model_input_filter()).select("property_id", "sale_price"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = p[p.index("PushedFilters:"):].split("ReadSchema")[0]
    for f in ("IsNotNull(total_livable_area)", "GreaterThan(sale_price", "LessThan(sale_price", "In(category_code_desc"):
        assert f in pushed, f
    schema = p[p.index("ReadSchema:"):].splitlines()[0]
    assert "zoning" not in schema and "garage_spaces" not in schema


def test_no_python_udf_in_registered_queries(spark):
    qs = E.queries()
    for name in ("tile_info", "corr_matrix", "tile_stats", "impute", "yoy_change", "profile"):
        p = plan_of(qs[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_quantiles_without_buffers_or_products(spark):
    qs = E.queries()
    for name in ("median_by_year", "top_zip_median", "profile", "impute", "assessment_inputs"):
        p = plan_of(qs[name](spark, SF_SMALL))
        for bad in ("percentile(", "median(", "mode(", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_sample_has_one_path(spark):
    p = plan_of(E.queries()["sample_n"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p and "CartesianProduct" not in p and "NestedLoop" not in p


def test_yoy_uses_one_lag_window(spark):
    p = optimized_of(E.queries()["yoy_change"](spark, SF_SMALL))
    assert p.count("Window [") == 1 and "Join" not in p


def test_window_bundles_are_an_anti_join(spark):
    assert "LeftAnti" in optimized_of(E.queries()["bundle_window"](spark, SF_SMALL))


def test_geometry_is_parsed_after_the_join(spark):
    p = optimized_of(E.queries()["tile_info"](spark, SF_SMALL))
    assert 0 < p.lower().index("json") < p.index("Join")


def test_correlations_are_plain_sums(spark):
    p = plan_of(E.queries()["corr_matrix"](spark, SF_SMALL))
    assert "corr(" not in p


def test_geometry_is_parsed_in_many_tasks(spark, tmp_path):
    """One row group of short rows makes one scan task; the parse must not stay in it, not even as a filter."""
    from parcelkit.operators import tiles as T
    from parcelkit.plans import queries as Q
    d = str(tmp_path / "t")
    (spark.range(1, 400).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "CAST(id % 5 AS INT) AS c_nationkey",
                                    "id * 1.25D AS c_acctbal", "'X' AS c_mktsegment").coalesce(1).write.parquet(f"{d}/customer.parquet"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert n > 1
    made = {q: Q.REGISTRY[q](spark, d) for q in ("geo_bbox", "geojson_parse", "core_parcels", "core_parcel_shapes", "tile_assign",
                                                 "tile_cover")}
    made |= {"features": Q._parcel_features(spark, d)}
    for name, df in made.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        above, below = plan.split("Exchange RoundRobinPartitioning", 1)
        assert "parseJson" in above and "parseJson" not in below, name
        assert df.rdd.getNumPartitions() == n, name
    assert len(T.tile_rows(made["features"]).inputFiles()) == n      # no reader has to take a single large row group
