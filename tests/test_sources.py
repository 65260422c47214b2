"""CSV / JSON sources and sinks on files the tests write themselves."""

import json

import pytest

from parcelkit.sources import files, sinks

NULLS = files.NULL_SPELLINGS


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


def test_raw_csv_nulls_and_quotes(spark, tmp_path):
    p = tmp_path / "raw.csv"
    lines = ['Parcel_Number,Location,NOTE']
    lines.append('001,"12 ""A"" ST",plain')
    for i, tok in enumerate(NULLS):
        lines.append(f'{100 + i},{tok},"{tok}"')
    lines.append('200,,""')
    write(p, "\n".join(lines) + "\n")
    df = files.read_raw_csv(spark, str(p))
    assert df.columns == ["parcel_number", "location", "note"]
    rows = {r.parcel_number: r for r in df.collect()}
    assert rows["001"].location == '12 "A" ST'
    for i, _ in enumerate(NULLS):
        r = rows[str(100 + i)]
        assert r.location is None and r.note is None
    assert rows["200"].location is None and rows["200"].note is None


def test_text_csv_keeps_empty_and_newlines(spark, tmp_path):
    p = tmp_path / "parcels.csv"
    write(p, 'BRT_ID,Address,Geometry\n1,"line1\nline2",NA\n2,,""\n')
    df = files.read_text_csv(spark, str(p))
    rows = {r.brt_id: r for r in df.collect()}
    assert rows["1"].address == "line1\nline2" and rows["1"].geometry == "NA"
    assert rows["2"].address == "" and rows["2"].geometry == ""
    out = tmp_path / "jsonl"
    n = sinks.write_jsonl_counted(df, str(out))
    assert n == 2
    back = files.read_jsonl_strings(spark, str(out), ["brt_id", "address", "geometry"])
    assert {r.brt_id for r in back.collect()} == {"1", "2"}


def test_pages_skip_every_header(spark, tmp_path):
    d = tmp_path / "pages"
    d.mkdir()
    write(d / "p1.csv", "objectid,address\n1,a\n2,b\n")
    write(d / "p2.csv", "objectid,address\n3,c\n\n4,d\n")
    write(d / "p3.csv", "objectid,address\n")            # header only
    df = files.read_pages(spark, str(d), ["objectid", "address"])
    assert sorted(r.objectid for r in df.collect()) == ["1", "2", "3", "4"]
    assert df.columns == ["objectid", "address"]
    with pytest.raises(ValueError, match="geometry"):       # a listed column that vanished is an error
        files.read_pages(spark, str(d), ["objectid", "address", "geometry"])


def test_parquet_sink_count_and_bins_document(spark, tmp_path):
    df = spark.createDataFrame([(2020, 50000, 100000, 3), (2020, 0, 50000, 2), (2019, 0, 50000, 1)],
                               "tax_year long, lower_bound long, upper_bound long, property_count long")
    assert sinks.write_parquet_counted(df, str(tmp_path / "pq")) == 3
    doc = json.loads(sinks.bins_document(df).collect()[0].document)
    assert [(d["tax_year"], d["lower_bound"]) for d in doc] == [("2019", 0), ("2020", 0), ("2020", 50000)]
    doc2 = json.loads(sinks.bins_document(df.drop("tax_year"), None).collect()[0].document)
    assert [d["lower_bound"] for d in doc2] == [0, 0, 50000] and "tax_year" not in doc2[0]


def test_style_document(spark):
    from pyspark.sql import functions as F

    from parcelkit.operators.stats import field_stats, style_layers
    df = spark.createDataFrame([(float(i), None) for i in range(10)], "a double, b double")
    docdf = sinks.style_document(style_layers(field_stats(df, ["a", "b"])), "tiles",
                                 F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    doc = json.loads(docdf.collect()[0].document)
    assert doc["generated_at"] == "2026-01-01T00:00:00Z" and doc["source"] == "tiles"
    assert set(doc["layers"]) == {"a"} and len(doc["layers"]["a"]["breakpoints"]) == 4


def test_geojson_feature_text(spark):
    df = spark.createDataFrame([("1", "A ST", 1.5, None, '{"type":"Point","coordinates":[1,2]}')],
                               "property_id string, address string, current_assessed_value double, "
                               "tax_year_assessed_value double, geog string")
    f = json.loads(sinks.geojson_features(df).collect()[0].feature)
    assert f["type"] == "Feature" and f["geometry"]["coordinates"] == [1, 2]
    assert f["properties"] == {"property_id": "1", "address": "A ST",
                               "current_assessed_value": 1.5, "tax_year_assessed_value": None}


def test_stream_prepare(spark, tmp_path):
    from parcelkit.streaming.ingest import prepare_stream
    land = tmp_path / "land"
    land.mkdir()
    write(land / "a.csv", "ID,NAME\n1,NA\n2,bob\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    prepare_stream(spark, str(land), ["ID", "NAME"], out, ck)
    write(land / "b.csv", "ID,NAME\n3,carl\n")
    prepare_stream(spark, str(land), ["ID", "NAME"], out, ck)   # resumes: only the new file
    rows = sorted((r.id, r.name) for r in spark.read.parquet(out).collect())
    assert rows == [("1", None), ("2", "bob"), ("3", "carl")]
