"""The batch job end to end on CSV files written by the test."""

import csv
import os

from parcelkit.plans.job import Paths, run

PROP_COLS = ["PARCEL_NUMBER", "market_value", "sale_price", "taxable_land", "taxable_building",
             "exempt_land", "exempt_building", "total_livable_area", "total_area", "depth",
             "frontage", "off_street_open", "garage_spaces", "number_of_bedrooms",
             "number_of_bathrooms", "number_stories", "year_built", "sale_date", "recording_date",
             "market_value_date", "assessment_date", "location", "owner_1", "zip_code",
             "category_code", "category_code_description", "building_code_description",
             "exterior_condition", "interior_condition", "zoning", "fireplaces", "unknown_extra"]
DESCS = ["SINGLE FAMILY", "MULTI FAMILY", "APARTMENTS > 4 UNITS", "MIXED USE"]


def _write(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def test_job_end_to_end(spark, tmp_path):
    props, assess, parcels = [], [], []
    for i in range(120):
        pid = f"{i:09d}"
        price = "NA" if i % 17 == 0 else str(20000 + (i % 40) * 5000)
        props.append([pid, str(100000 + i * 1000), price, "1", "2", "0", "0", str(800 + i),
                      str(1000 + i), "", "", "", str(i % 2), str(i % 5 + 1), "1.5", "2",
                      str(1900 + i % 100), f"2021-{i % 12 + 1:02d}-15 00:00:00", "", "", "",
                      f"{i} MAIN ST", "OWNER", str(19100 + i % 5), str(i % 3 + 1),
                      DESCS[i % 4], "ROW", str(i % 7), str(i % 6), "RSA5", str(i % 3), "x"])
        for y in (2023, 2024, 2025):
            assess.append([pid, str(y), str(90000 + i * 900 + (y - 2023) * 5000), "1", "2", "0", "0"])
        lon, lat = -75.2 + (i % 10) * 0.001, 39.95 + (i // 10) * 0.001
        ring = [[lon, lat], [lon + 0.0005, lat], [lon + 0.0005, lat + 0.0005], [lon, lat + 0.0005],
                [lon, lat]]
        geom = '{"type":"Polygon","coordinates":[%s]}' % str(ring).replace(" ", "")
        parcels.append([str(i), pid, f"{i} MAIN ST", geom if i % 9 else "not json"])
    d = tmp_path / "land"
    for sub in ("props", "assess", "parcels"):
        os.makedirs(d / sub)
    _write(d / "props" / "p.csv", PROP_COLS, props)
    _write(d / "assess" / "a.csv", ["parcel_number", "YEAR", "market_value", "taxable_land",
                                     "taxable_building", "exempt_land", "exempt_building"], assess)
    _write(d / "parcels" / "g.csv", ["objectid", "BRT_ID", "address", "geometry"], parcels)
    out = str(tmp_path / "out")
    counts = run(spark, Paths(str(d / "props"), str(d / "assess"), str(d / "parcels"), out, "job_"),
                 trees=3, depth=3, as_of="2026-06-30")
    assert counts["core.properties"] == 120 and counts["core.assessments"] == 360
    core = spark.table("job_core.properties")
    assert dict(core.dtypes)["sale_price"].startswith("decimal")
    assert "unknown_extra" in core.columns and core.columns[0] == "property_id"
    assert counts["derived.current_assessments"] > 0
    bins = spark.table("job_derived.tax_year_bins")
    assert bins.groupBy().sum("property_count").collect()[0][0] == 360
    tile = spark.table("job_derived.tile_info")
    assert tile.where("geog IS NULL").count() == 0
    assert "event_id" not in spark.table("job_derived.current_assessments").columns
    assert spark.table("job_derived.assessment_inputs").count() == 120
    from parcelkit.functions.geo import with_polygons
    from parcelkit.operators.tiles import tile_assign
    want = tile_assign(with_polygons(tile.select("property_id", "geog"), "geog")).count()
    tiles = spark.table("job_derived.tiles")
    (tree,) = {r.tree for r in tiles.select("tree").distinct().collect()}
    assert tree.startswith(f"{out}/public/tiles/") and spark.read.option("recursiveFileLookup", True).text(tree).count() == want
    assert tiles.agg({"kept_count": "sum"}).first()[0] == want
    metrics = {(r.grouping, r.value): r for r in spark.table("job_derived.model_metrics").collect()}
    assert metrics["all", "all"].n_rows > 0 and metrics["all", "all"].rmse > 0
    from parcelkit.operators.lookup import indexed_search, prefix_search, profile_of
    props = spark.table("job_core.properties")
    for text in ("1", "1%", ""):
        got = indexed_search(spark.table("job_derived.property_search"), text).collect()
        assert [r.property_id for r in got] == [r.property_id for r in prefix_search(props, text).collect()]
    key = props.first().property_id
    (one,) = profile_of([key], spark.table("job_derived.property_keys"), spark.table("job_derived.assessment_keys")).collect()
    assert one.property_id == key and len(one.assessments) == 3
    style = spark.read.text(f"{out}/public/style").collect()[0][0]
    assert '"layers"' in style
