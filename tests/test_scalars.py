"""Hand-made edge rows for casts and scalar expressions (FIXTURES section 4)."""

import datetime as dt


from parcelkit.functions import casts, scalar


def one_col(spark, values, name="x", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")


def test_safe_long(spark):
    vals = ["12", " 12 ", "+5", "12.6", "1e3", "0x10", "", "abc", None]
    got = [r[0] for r in one_col(spark, vals).select(casts.safe_long("x")).collect()]
    assert got == [12, 12, 5, None, None, None, None, None, None]


def test_safe_decimal_rounds_half_up_at_scale_9(spark):
    got = one_col(spark, ["1.2345678905", "abc", "17"]).select(casts.safe_decimal("x")).collect()
    assert str(got[0][0]) == "1.234567891"
    assert got[1][0] is None
    assert str(got[2][0]) == "17.000000000"


def test_safe_date_guard(spark):
    vals = ["2023-05-12", "2023-05-12 00:00:00", "2023-05-12T00:00:00",
            "2023-05-12 23:30:00-05:00", "2023", "2023-05", "12:30", "05/12/2023", "1700-01-01"]
    got = [r[0] for r in one_col(spark, vals).select(casts.safe_date("x")).collect()]
    d = dt.date
    assert got == [d(2023, 5, 12), d(2023, 5, 12), d(2023, 5, 12), d(2023, 5, 13),
                   None, None, None, None, d(1700, 1, 1)]


def test_retype_keeps_unknown_columns_and_key(spark):
    df = spark.createDataFrame([("007", "12.5", "x", "2020")],
                               "parcel_number string, market_value string, other string, year string")
    out = casts.retype(df, {"market_value": "decimal", "year": "long"}, key="property_id",
                       key_from="parcel_number")
    assert out.columns == ["property_id", "parcel_number", "market_value", "year", "other"]
    r = out.collect()[0]
    assert r.property_id == "007" and r.year == 2020 and r.other == "x"


def test_retype_missing_column_raises(spark):
    import pytest
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError):
        casts.retype(df, {"b": "long"})


def test_value_bin_edges(spark):
    df = spark.createDataFrame([(0.0,), (49999.99,), (50000.0,)], "v double")
    got = [r[0] for r in df.select(scalar.value_bin_lower("v", 50000)).collect()]
    assert got == [0, 0, 50000]
    dec = spark.createDataFrame([("49999.99998",)], "v string").select(
        casts.safe_decimal("v").alias("v"))
    assert dec.select(scalar.value_bin_lower_decimal("v", 50000)).collect()[0][0] == 0


def test_logs_and_age(spark):
    df = spark.createDataFrame([(0.0, 1800), (-5.0, 2030), (None, None)], "a double, y long")
    rows = df.select(scalar.log1p_safe("a"), scalar.property_age("y", bounded=True)).collect()
    assert rows[0][0] == 0.0 and rows[0][1] is None  # age 225 > 200
    assert rows[1][0] is None and rows[1][1] is None  # ln(-4) and age -5
    assert rows[2][0] is None and rows[2][1] is None


def test_prefix_groups(spark):
    vals = ["RM1", "RSA5", "RSD1", "CMX2", "CA1", "ICMX", None, "rm1"]
    got = [r[0] for r in one_col(spark, vals).select(scalar.prefix_group("x")).collect()]
    assert got == ["Residential_Multi", "Residential_Single", "Residential_Single", "Commercial",
                   "Commercial", "Industrial", "Other", "Other"]


def test_address_key_and_house_number(spark):
    df = one_col(spark, ["  2201 park towne pl ", "MARKET", None])
    got = df.select(scalar.address_key("x"), scalar.house_number("x")).collect()
    assert tuple(got[0]) == ("2201 PARK", "2201")
    assert tuple(got[1]) == ("MARKET", "")


def test_zip_valid(spark):
    got = [r[0] for r in one_col(spark, ["19104", "1910", "19104-1", None]).select(
        scalar.zip_valid("x")).collect()]
    assert got == [True, False, False, False]


def test_js_round_half_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (-2.6,)], "x double")
    assert [r[0] for r in df.select(scalar.js_round("x")).collect()] == [3, -2, -3]


def test_category_label(spark):
    got = [r[0] for r in one_col(spark, ["1", "14", "99"]).select(
        scalar.category_label("x")).collect()]
    assert got == ["Single Family", "Apartment 5+ Units", "Category 99"]


def test_class_edges(spark):
    df = spark.createDataFrame([(100.0, 80.0), (95.0, 100.0), (105.0, 100.0), (150.0, 100.0),
                                (0.0, 100.0), (None, None), (120.0, 100.0)],
                               "cur double, tax double")
    got = [tuple(r) for r in df.select(scalar.pct_change_class("cur", "tax"),
                                       scalar.dollar_change_class("cur", "tax")).collect()]
    # ratios 0.25, -0.05, 0.05, 0.5, no data, no data, 0.2 -- each edge starts its class
    assert [g[0] for g in got] == [4, 2, 3, 5, None, None, 4]
    assert [g[1] for g in got] == [2, 2, 2, 2, None, None, 2]
    vc = [r[0] for r in spark.createDataFrame([(49999.0,), (50000.0,), (None,), (600000.0,)],
                                              "v double").select(scalar.value_class("v")).collect()]
    assert vc == [0, 1, 0, 4]
