"""Operator edge rows (FIXTURES section 4) and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from parcelkit.functions import geo
from parcelkit.operators import bins as B
from parcelkit.operators import change as C
from parcelkit.operators import dedupe as D
from parcelkit.operators import lookup as L
from parcelkit.operators import stats as S
from parcelkit.plans import products as P


def test_latest_row_tie_null_and_filter_order(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("a", 10.0, t1, 1), ("a", 20.0, t2, 2), ("a", 30.0, t2, 3),   # tie on time -> event 3
         ("b", 5.0, t1, 4), ("b", None, t2, 5),                        # latest value NULL
         ("c", 7.0, t1, 6), ("c", -1.0, t2, 7)],                       # latest negative
        "property_id string, predicted_value double, predicted_at timestamp, event_id long")
    latest = {r.property_id: r.predicted_value for r in P.latest_predictions(df).collect()}
    assert latest == {"a": 30.0, "b": None, "c": -1.0}
    valid = {r.property_id: r.predicted_value
             for r in P.latest_predictions(df, valid_only=True).collect()}
    assert valid == {"a": 30.0, "b": 5.0, "c": 7.0}
    assert P.latest_predictions(df).count() == 3


def test_bundle_modes(spark):
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 2, 1)
    df = spark.createDataFrame(
        [("p1", 100.0, d1), ("p2", 100.0, d1),          # pair: same price and date
         ("p3", 100.0, d2),                             # same price other date
         ("p4", 200.0, None), ("p5", 200.0, None),      # NULL date pair
         ("p6", 300.0, dt.date(2019, 1, 1)), ("p7", 300.0, dt.date(2019, 1, 1))],
        "property_id string, sale_price double, sale_date date")
    anti = {r.property_id for r in D.drop_bundles(df).collect()}
    assert anti == {"p3", "p4", "p5"}
    win = {r.property_id for r in D.drop_bundles(df, mode="window").collect()}
    assert win == {"p3"}
    scope = F.col("sale_date") >= F.lit("2020-01-01").cast("date")
    scoped = {r.property_id for r in D.drop_bundles(df, scope=scope).collect()}
    assert scoped == {"p3", "p4", "p5", "p6", "p7"}   # the 2019 pair is outside the window
    keys = D.bundle_keys(df).collect()
    assert len(keys) == 2


def test_quantile_layers(spark):
    empty = spark.createDataFrame([], "a double, b double")
    st = S.field_stats(empty, ["a", "b"])
    assert S.style_layers(st).count() == 0          # no values -> layer skipped
    one = spark.createDataFrame([(5.0, None)], "a double, b double")
    lay = {r.field: r for r in S.style_layers(S.field_stats(one, ["a", "b"])).collect()}
    assert set(lay) == {"a"} and lay["a"].breakpoints == [5.0] * 4
    eq = spark.createDataFrame([(3.0,)] * 5, "a double")
    row = S.field_stats(eq, ["a"]).collect()[0]
    assert row.quantiles == [3.0] * 6 and row.value_count == 5
    vals = spark.createDataFrame([(float(i),) for i in range(1, 101)], "a double")
    q = S.field_stats(vals, ["a"]).collect()[0].quantiles
    assert q[0] == 1.0 and q[-1] == 100.0 and q == sorted(q)


def test_binned_median_cases(spark):
    bins = spark.createDataFrame(
        [(2020, 0, 10, 2), (2020, 10, 20, 2),      # half exactly on the first bin's edge
         (2021, 0, 10, 5),                         # one bin
         (2022, 0, 10, 0), (2022, 10, 20, 4)],     # zero-count bin ignored
        "tax_year long, lower_bound long, upper_bound long, property_count long")
    got = {r.tax_year: (r.property_total, r.median_value)
           for r in B.binned_median(bins, ["tax_year"]).collect()}
    assert got[2020] == (4, 10.0)
    assert got[2021] == (5, 5.0)
    assert got[2022] == (4, 15.0)


def test_value_bins_invariants(spark):
    df = spark.createDataFrame([(0.0,), (49999.99,), (50000.0,), (-1.0,), (None,)], "v double")
    b = B.value_bins(df, "v", 50000).collect()
    assert sum(r.property_count for r in b) == 3
    assert all(r.upper_bound - r.lower_bound == 50000 for r in b)


def test_yoy_change_cases(spark):
    df = spark.createDataFrame(
        [("a", 2019, 0.0), ("a", 2020, 100.0),       # previous 0 -> no change
         ("b", 2019, None), ("b", 2020, 100.0),      # NULL as 0
         ("c", 2019, 100.0), ("c", 2020, 110.0),     # exactly +10 %
         ("d", 2019, 100.0), ("d", 2020, 90.0),      # exactly -10 %
         ("e", 2018, 100.0), ("e", 2020, 105.0)],    # missing year between: previous row
        "property_id string, year long, market_value double")
    out = {(r.property_id, r.year): r for r in
           C.yoy_change(df, "property_id", "year", "market_value").collect()}
    assert out[("a", 2020)].pct_change is None and not out[("a", 2020)].flagged
    assert out[("b", 2020)].pct_change is None
    assert out[("c", 2020)].flagged and out[("c", 2020)].pct_label == 10
    assert out[("d", 2020)].flagged and out[("d", 2020)].pct_label == -10
    assert abs(out[("e", 2020)].pct_change - 5.0) < 1e-9 and not out[("e", 2020)].flagged


def test_discrepancy_threshold_and_counts(spark):
    df = spark.createDataFrame([(120.0, 100.0), (80.0, 100.0), (119.0, 100.0), (0.0, 100.0)],
                               "current_assessed_value double, tax_year_assessed_value double")
    assert C.discrepancy(df).count() == 2            # +20 % and -20 % kept
    counts = {r.threshold_pct: r.property_count for r in C.discrepancy_counts(df).collect()}
    assert counts[20] == 2 and counts[5] == 3 and counts[25] == 0


def test_value_breakdown_flag(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, None, 0.0), ("a", 1.0, 2.0, 0.0, 3.0),
                                ("b", None, 2.0, None, None)],
                               "property_id string, taxable_land double, taxable_building double, "
                               "exempt_land double, exempt_building double")
    out = {(r.property_id, r.exempt_value): r.has_exempt for r in C.value_breakdown(df).collect()}
    assert out == {("a", 0.0): True, ("a", 3.0): True, ("b", 0.0): False}


def test_geometry_parse_cases(spark):
    sq = "[[[-75.1,39.9],[-75.0,39.9],[-75.0,40.0],[-75.1,40.0],[-75.1,39.9]]]"
    rows = [("poly", '{"type":"Polygon","coordinates":%s}' % sq),
            ("multi", '{"type":"MultiPolygon","coordinates":[%s,%s]}' % (sq, sq.replace("-75.1", "-75.3").replace("-75.0", "-75.2"))),
            ("overlap", '{"type":"MultiPolygon","coordinates":[%s,%s]}' % (sq, sq.replace("-75.1", "-75.2"))),
            ("bad", '{"type":"Polygon","coordinates":[[[1,2]'),
            ("open", '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1]]]}'),
            ("three", '{"type":"Polygon","coordinates":[[[0,0],[1,0],[0,0]]]}'),
            ("lon200", '{"type":"Polygon","coordinates":[[[200,0],[201,0],[201,1],[200,0]]]}'),
            ("null", None)]
    df = spark.createDataFrame(rows, "k string, g string")
    out = {r.k: r for r in geo.with_polygons(df, "g", "p").select(
        "k", "p", geo.bbox("p").alias("b")).collect()}
    assert out["poly"].p is not None and out["multi"].p is not None
    assert all(out[k].p is None for k in ("overlap", "bad", "open", "three", "lon200", "null"))
    assert tuple(out["poly"].b) == (-75.1, 39.9, -75.0, 40.0)
    assert out["multi"].b.west == -75.3


def test_tile_assignment_covers_bbox(spark):
    from parcelkit.operators.tiles import tile_assign
    sq = '{"type":"Polygon","coordinates":[[[-75.1,39.95],[-75.09,39.95],[-75.09,39.96],[-75.1,39.96],[-75.1,39.95]]]}'
    df = geo.with_polygons(spark.createDataFrame([("a", sq)], "property_id string, g string"), "g")
    tiles = tile_assign(df).collect()
    assert {t.z for t in tiles} == set(range(12, 19))
    z12 = [t for t in tiles if t.z == 12]
    # public slippy-map formula: lon -75.1 -> x 1193 at z12
    assert z12[0].x == int((-75.1 + 180) / 360 * 4096)


def test_profile_cases(spark):
    props = spark.createDataFrame(
        [("k1", "1 MAIN", "o", 1.0, 1.0, 1.0, 0.0, 0.0, 1900, 2, 1.0, 100.0, "1"),
         ("k2", "2 MAIN", "o", 1.0, 1.0, 1.0, 0.0, 0.0, 1900, 2, 1.0, 100.0, "1")],
        ", ".join(f"{c} {t}" for c, t in zip(L.PROFILE_FIELDS, [
            "string", "string", "string", "double", "double", "double", "double", "double",
            "long", "long", "double", "double", "string"])))
    hist = spark.createDataFrame([("k1", 1950 + i, float(i), 0.0, 0.0, 0.0, 0.0) for i in range(51)],
                                 "property_id string, year long, market_value double, taxable_land double, "
                                 "taxable_building double, exempt_land double, exempt_building double")
    keys = spark.createDataFrame([("k1",), ("k2",), ("missing",)], "property_id string")
    out = {r.property_id: r for r in L.property_profile(keys, props, hist).collect()}
    assert set(out) == {"k1", "k2"}                       # key without property dropped
    assert len(out["k1"].assessments) == 50               # capped, ascending by year
    assert out["k1"].assessments[0].year == 1950 and out["k1"].assessments[-1].year == 1999
    assert out["k2"].assessments == []                    # property without history


def test_prefix_search_literal_and_like(spark):
    df = spark.createDataFrame([("1", "100 MAIN ST", "1"), ("2", "100 MARKET ST", "1"),
                                ("3", "100 MAIN ST", "4"), ("4", "1005 MAIN", "2")],
                               "property_id string, location string, category_code string")
    got = [r.property_id for r in L.prefix_search(df, " 100 ma ").collect()]
    assert got == ["1", "2"]
    wild = [r.property_id for r in L.prefix_search(df, "10_5 ").collect()]
    assert wild == ["4"]                       # '_' stays a live wildcard, as in LIKE
    assert L.prefix_search(df, "10_5", literal=True).count() == 0


def test_significant_years_and_shift(spark):
    bins = spark.createDataFrame([(y, 0, 10, n) for y, n in
                                  [(2018, 50), (2019, 200), (2020, 300), (2021, 400), (2022, 500),
                                   (2023, 600)]],
                                 "tax_year long, lower_bound long, upper_bound long, property_count long")
    sig = {r.tax_year: r.selectable for r in
           B.significant_years(bins, min_total=100, selectable_total=250, last=3).collect()}
    assert set(sig) == {2019, 2020, 2021, 2022, 2023}
    assert [y for y, s in sorted(sig.items()) if s] == [2021, 2022, 2023]
    ov = B.year_overview(bins)
    shift = B.market_shift(ov, B.breakpoint_median(F.array(F.lit(1.0), F.lit(4.0), F.lit(6.0),
                                                           F.lit(9.0))))
    r = {x.tax_year: x for x in shift.collect()}[2023]
    assert r.model_median == 5 and r.shift_class == "neutral"


def test_chart_bins_cap(spark):
    bins = spark.createDataFrame([(2020, 0, 50000, 1), (2021, 0, 50000, 2), (2021, 2000000, 2050000, 3)],
                                 "tax_year long, lower_bound long, upper_bound long, property_count long")
    assert [tuple(r) for r in B.chart_bins(bins).collect()] == [(2021, 0, 50000, 2)]


def test_tile_assignment_skips_invalid_geometry(spark):
    from parcelkit.operators.tiles import tile_assign, tile_stats
    sq = '{"type":"Polygon","coordinates":[[[-75.1,39.95],[-75.09,39.95],[-75.09,39.96],[-75.1,39.96],[-75.1,39.95]]]}'
    df = spark.createDataFrame([("a", sq), ("b", None), ("c", "not json")],
                               "property_id string, g string")
    parsed = geo.with_polygons(df, "g")
    assert {t.property_id for t in tile_assign(parsed).collect()} == {"a"}
    st = tile_stats(parsed, feature_text="g").collect()
    assert all(r.feature_count == 1 and r.tile_bytes == len(sq) for r in st)
    assert {r.z for r in st} == set(range(12, 19))


def test_sample_n_matches_brute_force(spark):
    rows = [(f"k{i}", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "property_id string, v double")
    got = [r.property_id for r in S.sample_n(df, 40, ["property_id"], seed=7).collect()]
    import hashlib
    ranked = sorted((hashlib.md5(f"7|{k}".encode()).hexdigest(), k) for k, _ in rows)
    assert got == [k for _, k in ranked[:40]]
    assert S.sample_n(df, 5000, ["property_id"]).count() == 300   # min(n, rows)


def test_impute_groups_fallbacks_and_modes(spark):
    from parcelkit.operators.features import impute
    df = spark.createDataFrame(
        [("a", "z1", 1.0, 2.0, 5.0), ("b", "z1", 3.0, None, 5.0), ("c", "z1", None, 2.0, 7.0),
         ("d", "z2", 10.0, 3.0, 7.0), ("e", "z2", None, 3.0, None), ("f", None, None, None, None),
         ("g", "z3", None, None, 9.0)],
        "property_id string, zip_code string, baths double, garage double, cond double")
    plan = {"baths": ("median", "zip_code"), "garage": ("zero", None), "cond": ("mode", None)}
    out = {r.property_id: r for r in impute(df, plan).collect()}
    assert out["c"].baths == 2.0          # median of z1 (1, 3)
    assert out["e"].baths == 10.0         # median of z2
    assert out["f"].baths == 3.0          # NULL group -> global median of (1, 3, 10)
    assert out["g"].baths == 3.0          # group with no values -> global median
    assert out["b"].garage == 0.0
    assert out["e"].cond == 5.0 and out["f"].cond == 5.0   # mode tie 5/7 -> smallest


def test_yoy_null_key_is_a_series(spark):
    rows = [(None, 2020, 1.0), (None, 2021, 2.0), ("a", 2020, 4.0), ("a", 2022, 4.2), ("a", 2023, None)]
    df = spark.createDataFrame(rows, "property_id string, year long, market_value double")
    got = {(r.property_id, r.year): r for r in C.yoy_change(df, "property_id", "year", "market_value").collect()}
    assert got[None, 2021].prev_value == 1.0 and got[None, 2021].pct_change == 100.0 and got[None, 2021].flagged
    assert got["a", 2020].prev_value is None and not got["a", 2022].flagged
    assert got["a", 2023].prev_value == 4.2 and got["a", 2023].pct_change is None


def test_breakdown_flags_null_keys(spark):
    rows = [(None, 1.0, 1.0, 0.0, 5.0), (None, 1.0, 1.0, 0.0, 0.0), ("a", 1.0, None, None, 0.0)]
    df = spark.createDataFrame(rows, "property_id string, taxable_land double, taxable_building double, "
                                     "exempt_land double, exempt_building double")
    got = [(r.property_id, r.has_exempt) for r in C.value_breakdown(df).collect()]
    assert sorted(got, key=str) == [("a", False), (None, True), (None, True)]


def test_tiles_of_far_parts_and_poles(spark):
    from parcelkit.functions import geo
    from parcelkit.operators.tiles import tile_assign
    def ring(x, y):
        return f"[[[{x},{y}],[{x + 0.01},{y}],[{x + 0.01},{y + 0.01}],[{x},{y + 0.01}],[{x},{y}]]]"
    far = '{"type":"MultiPolygon","coordinates":[%s,%s]}' % (ring(-170, -40), ring(170, 40))
    south = '{"type":"Polygon","coordinates":%s}' % ring(0, -90)
    df = geo.with_polygons(spark.createDataFrame([("far", far), ("south", south)], "property_id string, g string"),
                           "g", "polygons")
    rows = tile_assign(df, min_zoom=10, max_zoom=12).collect()
    assert sum(r.property_id == "far" for r in rows) < 40
    assert {r.y for r in rows if r.property_id == "south" and r.z == 12} == {4095}


def test_tile_tree_holds_each_feature_row_once_per_tile(spark, tmp_path):
    import json

    from parcelkit.functions import geo
    from parcelkit.operators.tiles import read_tiles, tile_assign, write_tiles
    from parcelkit.sources.sinks import geojson_features
    square = '{"type":"Polygon",\n "coordinates":[[[0,0],[0.001,0],[0.001,0.001],[0,0.001],[0,0]]]}'
    rows = [("k", "a", square, 1.0, 2.0), ("k", "a", square, None, 3.0), ("m", "b", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "property_id string, address string, geog string, "
                                     "current_assessed_value double, tax_year_assessed_value double")
    feats = geo.with_polygons(geojson_features(df, carry=("geog",)), "geog")
    write_tiles(feats, str(tmp_path / "t"))
    lines = [json.loads(r.value) for r in read_tiles(spark, str(tmp_path / "t")).collect()]
    assert len(lines) == tile_assign(feats).count() and len(lines) % 2 == 0
    assert {x["layer"] for x in lines} == {"property_tile_info"}
    assert all(x["feature"]["geometry"]["type"] == "Polygon" for x in lines)
    assert {x["feature"]["properties"]["tax_year_assessed_value"] for x in lines} == {2.0, 3.0}


def test_v3_scores_every_eligible_property(spark):
    from parcelkit.operators import features as FE
    from parcelkit.plans import fixtures as X
    s = X.fx_sale(spark, "/root/testdata/sf0.001")
    assert (FE.feature_frame(s, "v3", X.AS_OF, label=None, for_predict=True).count()
            == s.where(FE.predict_input_filter()).count())


def test_latest_predictions_without_a_tie_column(spark):
    from parcelkit.plans import products as P
    df = spark.createDataFrame([("a", 1.0, "2026-01-01"), ("a", 2.0, "2026-01-01"), ("a", 9.0, "2025-01-01")],
                               "property_id string, predicted_value double, predicted_at string")
    assert [r.predicted_value for r in P.latest_predictions(df).collect()] == [2.0]


def test_records_keep_null_fields_and_decimals(spark):
    from parcelkit.sources.sinks import records_with_strings
    df = spark.createDataFrame([("a", None)], "k string, v decimal(10,2)").unionByName(
        spark.sql("SELECT 'b' AS k, CAST(1.50 AS DECIMAL(10,2)) AS v"))
    assert sorted(r.record for r in records_with_strings(df).collect()) == [
        '{"k":"a","v":null}', '{"k":"b","v":"1.50"}']


def test_core_types_and_vanished_columns(spark):
    import pytest

    from parcelkit.plans import job
    from parcelkit.plans.queries import _core_text
    raw = _core_text(spark, "/root/testdata/sf0.001")
    kinds = dict(job.core_properties(raw).dtypes)
    for c, t in job.PROPERTY_TYPES.items():
        assert kinds[c].startswith({"decimal": "decimal", "long": "bigint", "date": "date"}[t]), c
    with pytest.raises(ValueError, match="year_built"):
        job.core_properties(raw.drop("year_built"))
