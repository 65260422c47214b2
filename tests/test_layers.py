"""Versioned tables, the search index, page rules, metrics and cross-fitted codes."""

import hashlib
import math
import statistics

import pytest
from pyspark.sql import functions as F

from parcelkit.operators import lookup as L
from parcelkit.operators.features import target_encode_cv
from parcelkit.operators.model import FOREST_SETTINGS, fit_version, held_out, regression_metrics, value_deciles
from parcelkit.sources import files, layers


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    layers.create_layers(spark, str(tmp_path_factory.mktemp("layers")), "t_")
    return "t_derived"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_layers_are_there_by_name(spark, layer):
    have = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert {"t_source", "t_core", "t_derived"} <= have
    for name in ("t_source", "t_core", "t_derived"):
        layers.publish(spark.range(3), name, "here")
        assert spark.table(f"{name}.here").count() == 3


def test_a_run_that_dies_leaves_the_old_table(spark, layer, monkeypatch):
    assert layers.publish(spark.range(5), layer, "t") == 5
    with monkeypatch.context() as m:
        m.setattr(layers, "switch", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            layers.publish(spark.range(100, 200), layer, "t")
    assert ids(spark.table(f"{layer}.t")) == [0, 1, 2, 3, 4]
    broken = spark.range(9).select((F.lit(1) / F.when(F.col("id") < 99, 0).otherwise(1)).alias("id"))
    with pytest.raises(Exception):                          # noqa: B017  (while writing)
        layers.publish(broken, layer, "t")
    assert ids(spark.table(f"{layer}.t")) == [0, 1, 2, 3, 4]
    layers.publish(spark.range(2), layer, "t")
    assert ids(spark.table(f"{layer}.t")) == [0, 1]


def test_old_readers_keep_theirs_and_old_versions_go(spark, layer):
    layers.publish(spark.range(3), layer, "r")
    old = spark.table(f"{layer}.r")
    layers.publish(spark.table(f"{layer}.r").selectExpr("id + 10 AS id", "'x' AS more"), layer, "r")   # reads itself
    assert ids(old) == [0, 1, 2]
    new = spark.table(f"{layer}.r")
    assert ids(new) == [10, 11, 12] and new.columns == ["id", "more"]
    for i in range(3):
        layers.publish(spark.range(i), layer, "r")
    assert len(layers.versions(spark, layer, "r")) == layers.KEEP
    assert ids(spark.table(f"{layer}.r")) == [0, 1]
    assert layers.publish(spark.range(0).withColumn("p", F.lit("a")), layer, "r", ["p"]) == 0
    assert spark.table(f"{layer}.r").count() == 0 and spark.table(f"{layer}.r").columns == ["id", "p"]


def rows_for_search(spark):
    names = ["1 Main St", "1 MAIN ST", "10 main st", "12 Oak", "2 Elm", None, "", "É Rue", "é rue", "a", "abÿ", "ab\U0010ffffz",
             "ab", "AB_C", "ABXC", "AB%C", "ab퟿q", "straße", "100% Way", "İzmir"]
    rows = [(f"k{i % 13}", n, str(i % 3)) for i, n in enumerate(names * 3)]
    return spark.createDataFrame(rows, "property_id string, location string, category_code string")


def test_index_finds_what_the_plain_search_finds(spark, layer):
    df = rows_for_search(spark)
    L.write_search_index(df, layer, "search")
    index = spark.table(f"{layer}.search")
    for text in ("1", "1 main", " 1 MAIN ST ", "ab", "AB_", "ab%c", "%oak", "_", "", "ab\U0010ffff", "\U0010ffff", "ab퟿", "é",
                 "STRASSE", "straß", "100%", "İ", "zz", "a", "\\"):
        for literal in (False, True):
            if text == "\\" and not literal:        # not a pattern
                continue
            for codes in (None, ["1", "2"]):
                got = L.indexed_search(index, text, codes=codes, literal=literal, n=7).collect()
                want = L.prefix_search(df, text, codes=codes, literal=literal, n=7).collect()
                assert [tuple(r) for r in got] == [tuple(r) for r in want], (text, literal)


def test_index_reads_the_range_only(spark, layer):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("property_id"),
                                    F.concat(F.col("id") % 90 + 10, F.lit(" STREET "), "id").alias("location"),
                                    F.lit("1").alias("category_code"))
    L.write_search_index(df, layer, "streets")
    index = spark.table(f"{layer}.streets")
    found = L.indexed_search(index, "42 street 1", n=50)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = plan[plan.index("PartitionFilters"):]
    assert "bucket" in scan.split("PushedFilters")[0] and "= 42)" in scan.split("PushedFilters")[0]
    for f in ("GreaterThanOrEqual(search_key,42 STREET 1)", "LessThan(search_key,42 STREET 2)"):
        assert f in scan
    files_of = spark.table(f"{layer}.{layers.versions(spark, layer, 'streets')[-1]}").select("bucket", "_metadata.file_path")
    every = files_of.select("file_path").distinct().count()
    read = files_of.where("bucket = '42'").select("file_path").distinct().count()
    assert read * 20 < every and found.count() == 50


def test_profiles_of_keys_reach_the_scan(spark, layer):
    props = spark.range(3000).select(F.col("id").cast("string").alias("property_id"), *[
        F.lit("1").alias(c) for c in L.PROFILE_FIELDS if c != "property_id"])
    hist = spark.range(9000).select((F.col("id") % 3000).cast("string").alias("property_id"), (F.col("id") % 7).alias("year"),
                                    *[F.lit(1.0).alias(c) for c in L.HISTORY_FIELDS if c != "year"])
    L.write_key_index(props, layer, "p")
    L.write_key_index(hist, layer, "h", ["year"])
    got = L.profile_of(["17", "2999", "nobody"], spark.table(f"{layer}.p"), spark.table(f"{layer}.h"))
    assert {r.property_id: len(r.assessments) for r in got.collect()} == {"17": 3, "2999": 3}
    again = L.profile_of(["17", "2999", "nobody"], spark.table(f"{layer}.p"), spark.table(f"{layer}.h"))
    assert again._jdf.queryExecution().executedPlan().toString().count("In(property_id, [17,2999,nobody])") == 2


def plain_pages(pages, size):
    """Line by line, page after page, up to the first short or empty one."""
    out = []
    for text in pages:
        lines = [x for x in text.strip().split("\n")[1:] if x.strip()] if text.strip() else []
        out += [tuple(x.split(",")) for x in lines]
        if len(lines) < size:
            break
    return out


@pytest.mark.parametrize("pages", [
    ["a,B\n1,x\n2,y\n", "A,B\n3,z\n4,w\n", "A,B\n5,v\n"],
    ["a,B\n1,x\n\n2,y\n\n", "A,B\n3,z\n", "A,B\n5,v\n6,u\n"],                 # a short page ends it
    ["a,B\n1,x\n2,y\n", "A,B\n", "A,B\n5,v\n6,u\n"],                          # a header alone is empty
    ["a,B\n1,x\n2,y\n", "", "A,B\n5,v\n6,u\n"],
    ["a,B\n1,x\n2,y\n", "A,B\n3,z\n4,w\n"]])                                  # no short page
def test_pages_end_like_a_reader_s(spark, tmp_path, pages):
    for i, text in enumerate(pages):
        (tmp_path / f"page-{i:04d}.csv").write_text(text)
    got = files.read_pages(spark, str(tmp_path), ["a", "b"], page_rows=2)
    assert sorted(map(tuple, got.collect())) == sorted(plain_pages(pages, 2))


def test_metrics_and_split(spark):
    rows = [(f"k{i}", float(i % 37), float(i % 37) + (i % 5 - 2), f"z{i % 3}") for i in range(400)] + [("n", None, 1.0, "z0"), ("m", 1.0, None, None)]
    df = spark.createDataFrame(rows, "property_id string, sale_price double, predicted_value double, zip string")
    got = {(r.grouping, r.value): r for r in regression_metrics(
        df, constant=10.0, groups={"zip": F.col("zip"), "decile": value_deciles(df)}).collect()}
    for key, keep in ((("all", "all"), lambda r: True), (("zip", "z1"), lambda r: r[3] == "z1")):
        part = [r for r in rows if None not in r[1:3] and keep(r)]
        err = [r[2] - r[1] for r in part]
        mse, y = statistics.fmean(e * e for e in err), [r[1] for r in part]
        want = (len(part), math.sqrt(mse), statistics.fmean(map(abs, err)), statistics.fmean(err), 1 - mse / statistics.pvariance(y),
                math.sqrt(statistics.fmean((10 - v) ** 2 for v in y)))
        assert tuple(got[key])[2:] == pytest.approx(want)
    assert sum(r.n_rows for k, r in got.items() if k[0] == "decile") == 400
    assert {k[1] for k in got if k[0] == "decile"} == {str(i) for i in range(1, 11)}
    held = {r.property_id for r in df.where(held_out("property_id", 0.2, seed=3)).collect()}
    assert held == {r[0] for r in rows if int(hashlib.md5(f"3|{r[0]}".encode()).hexdigest()[:6], 16) % 1000 < 200}


@pytest.mark.parametrize("version", list(FOREST_SETTINGS))
def test_every_version_trains_with_its_settings(spark, version):
    from parcelkit.operators.features import feature_frame, training_rows
    from parcelkit.plans import fixtures as X
    sales = X.fx_sale(spark, "/root/testdata/sf0.001")
    rows = sales if version in ("v0", "v1", "v2", "v3") else training_rows(sales)
    model, held = fit_version(feature_frame(rows, version, X.AS_OF, keep=["property_id"]), version, trees=2, depth=2)
    assert model.transform(held).where("prediction IS NULL").count() == 0 < held.count()
    assert FOREST_SETTINGS[version] == ((200, 10) if version in ("v3", "deployed") else (100, 8))


def test_cross_fitted_codes_see_no_own_price(spark):
    rows = [(f"k{i}", f"z{i % 4}" if i % 11 else None, float(i * i % 101)) for i in range(300)] + [("solo", "alone", 1e6)]
    df = spark.createDataFrame(rows, "property_id string, zip string, price double")
    got = {r.property_id: r.zip_te for r in target_encode_cv(df, "zip", "price", "property_id", folds=4, smoothing=3.0).collect()}
    fold = {r[0]: int(hashlib.md5(r[0].encode()).hexdigest()[:6], 16) % 4 for r in rows}
    for k, z, _ in rows:
        rest = [p for j, _, p in rows if fold[j] != fold[k]]
        mean = sum(rest) / len(rest)
        same = [p for j, y, p in rows if fold[j] != fold[k] and z is not None and y == z]
        assert got[k] == pytest.approx((sum(same) + 3.0 * mean) / (len(same) + 3.0) if z is not None else mean), k
    bumped = spark.createDataFrame([(k, z, p + (1e9 if k == "k7" else 0)) for k, z, p in rows], df.schema)
    again = {r.property_id: r.zip_te for r in target_encode_cv(bumped, "zip", "price", "property_id", folds=4, smoothing=3.0).collect()}
    assert again["k7"] == pytest.approx(got["k7"]) and again != got
