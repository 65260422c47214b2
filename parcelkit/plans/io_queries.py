"""Registered source/sink queries.  Each lands data that Spark derives
from a driver table under the shared checkpoint folder, then reads it
back through the operator under test, so the work grows with the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.functions.geo import with_polygons
from parcelkit.operators import lookup as L
from parcelkit.operators.tiles import read_tiles, write_tiles
from parcelkit.plans import fixtures as X
from parcelkit.plans import products as P
from parcelkit.plans.queries import PRED_BIN_WIDTH, PRED_TIE, register, rounded, tile_frame
from parcelkit.session import shared_dir, stored
from parcelkit.sources import files, layers, sinks
from parcelkit.streaming.ingest import prepare_stream


# Fixed value: rows per page of an export.
PAGE_ROWS = 50000
# Fixture scale: pages of the parcel export, and texts searched for.
EXPORT_PAGE_ROWS = 400
SEARCHES = ["customer#00000", " Customer#0000012", "customer#0%9", "customer#00000_2", "nowhere"]


def _land_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as CSV pages of at most ``PAGE_ROWS`` rows with an upper-cased header in every page."""
    up = df.select(*[F.col(c).cast("string").alias(c.upper()) for c in df.columns])
    (up.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", PAGE_ROWS)
     .option("escape", '"').csv(path))


@register("src_csv_strings")
def q_src_csv_strings(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "land-customer")
    _land_csv(X.table(spark, d, "customer"), path)
    return files.read_raw_csv(spark, path)


@register("src_csv_jsonl")
def q_src_csv_jsonl(spark, d):
    csv_path, out = shared_dir(spark, "land-parcels"), shared_dir(spark, "jsonl-parcels")
    _land_csv(X.fx_parcels(spark, d), csv_path)
    sinks.write_jsonl_counted(files.read_text_csv(spark, csv_path), out)
    return files.read_jsonl_strings(spark, out, ["property_id", "brt_id", "address", "geometry"])


@register("src_paged_csv")
def q_src_paged_csv(spark, d):
    path = shared_dir(spark, "land-pages")
    _land_csv(X.fx_parcels(spark, d).withColumnRenamed("geometry", "geom_text"), path)
    return files.read_pages(spark, path, ["property_id", "brt_id", "address", "geom_text"])


@register("sink_parquet")
def q_sink_parquet(spark, d):
    out = shared_dir(spark, "sink-orders")
    sinks.write_parquet_counted(X.fx_assess(spark, d), out)
    return rounded(spark.read.parquet(out))


@register("src_parquet")
def q_src_parquet(spark, d):
    return files.read_parquet_table(spark, f"{d.rstrip('/')}/orders*.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 6).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


@register("src_jsonl")
def q_src_jsonl(spark, d):
    out = shared_dir(spark, "jsonl-search")
    cols = ["property_id", "location", "owner_1", "year_built", "number_of_bedrooms", "category_code", "zip_code"]
    sinks.write_jsonl_counted(X.fx_search(spark, d).select(*cols), out)
    return files.read_jsonl_strings(spark, out, cols)


@register("ctas_roundtrip")
def q_ctas_roundtrip(spark, d):
    """A derived table, created and then replaced by its rows."""
    layers.create_layers(spark, shared_dir(spark, "layers"))
    bins = P.tax_year_bins(X.fx_assess(spark, d))
    layers.publish(bins.where("tax_year % 2 = 0"), "derived", "tax_year_assessment_bins")
    layers.publish(bins, "derived", "tax_year_assessment_bins")
    return spark.table("derived.tax_year_assessment_bins")


@register("layer_tables")
def q_layer_tables(spark, d):
    """Text rows in the source layer, typed ones in core, bins in derived: each step reads the layer before by name."""
    from parcelkit.plans.job import core_assessments
    layers.create_layers(spark, shared_dir(spark, "layers"), "weekly_")
    a = X.fx_assess(spark, d).drop("property_id", "assessment_id")
    layers.publish(a.select(*[F.col(c).cast("string").alias(c) for c in a.columns]), "weekly_source", "assessments")
    layers.publish(core_assessments(spark.table("weekly_source.assessments")), "weekly_core", "assessments", ["year"])
    layers.publish(P.tax_year_bins(spark.table("weekly_core.assessments")), "weekly_derived", "tax_year_bins")
    return spark.table("weekly_derived.tax_year_bins")


@register("indexed_search")
def q_indexed_search(spark, d):
    """Address searches through the index: with and without wildcards, and without a match."""
    layers.create_layers(spark, shared_dir(spark, "layers"))
    L.write_search_index(X.fx_search(spark, d), "derived", "property_search")
    index = spark.table("derived.property_search")
    found = [L.indexed_search(index, t).select(F.lit(t).alias("asked"), "property_id", "location", "owner_1", "market_value")
             for t in SEARCHES]
    return rounded(reduce(DataFrame.unionByName, found))


@register("src_parcel_pages")
def q_src_parcel_pages(spark, d):
    """An export of parcels with all listed columns, in pages of ``EXPORT_PAGE_ROWS`` rows, the last one short."""
    path = shared_dir(spark, "land-export")
    rows = X.fx_export(spark, d).coalesce(1)
    (rows.select(*[F.col(c).cast("string").alias(c.upper()) for c in rows.columns]).write.mode("overwrite")
     .option("header", True).option("maxRecordsPerFile", EXPORT_PAGE_ROWS).option("escape", '"').csv(path))
    return files.read_pages(spark, path, files.PARCEL_COLUMNS, page_rows=EXPORT_PAGE_ROWS)


@register("chart_config_json")
def q_chart_config_json(spark, d):
    tax_doc, cur_doc = P.chart_configs(X.fx_assess(spark, d), X.fx_pred(spark, d), tie=PRED_TIE)
    return tax_doc.unionByName(cur_doc)


@register("style_metadata")
def q_style_metadata(spark, d):
    return P.tile_style_metadata(tile_frame(spark, d), run_at=F.to_timestamp(F.lit(X.RUN_AT)))


@register("geojson_features")
def q_geojson_features(spark, d):
    return sinks.geojson_features(tile_frame(spark, d))


def _sale_records(spark, d) -> DataFrame:
    """A decimal, a date and a column with NULLs."""
    return sinks.records_with_strings(X.fx_sale(spark, d).select(
        "property_id", F.col("sale_price").cast("decimal(12,2)").alias("sale_price"), "sale_date",
        "total_livable_area"))


@register("records_json")
def q_records_json(spark, d):
    return _sale_records(spark, d)


def _write_tiles(spark, d) -> str:
    out = shared_dir(spark, "tiles")
    feats = stored(sinks.geojson_features(tile_frame(spark, d), carry=("geog",)), "features")
    write_tiles(with_polygons(feats, "geog", check_shapes=False), out)
    return out


@register("tile_write")
def q_tile_write(spark, d):
    return read_tiles(spark, _write_tiles(spark, d)).select("value", F.col("z").cast("bigint").alias("z"), "x")


@register("tile_write_items")
def q_tile_write_items(spark, d):
    schema = ("struct<layer:string,y:bigint,feature:struct<type:string,geometry:struct<type:string>,properties:struct<"
              "property_id:string,address:string,current_assessed_value:double,tax_year_assessed_value:double>>>")
    t = read_tiles(spark, _write_tiles(spark, d)).select("z", "x", F.from_json("value", schema).alias("j"))
    return rounded(t.select(F.col("z").cast("bigint").alias("z"), F.col("x").cast("bigint").alias("x"), "j.y", "j.layer",
                            F.col("j.feature.type").alias("feature_type"),
                            F.col("j.feature.geometry.type").alias("geometry_type"), "j.feature.properties.*"))


@register("tile_objects")
def q_tile_objects(spark, d):
    """The objects of a written tile tree and the features in each: one row for each file."""
    lines = spark.read.option("recursiveFileLookup", True).text(_write_tiles(spark, d))
    name = F.regexp_extract(F.col("_metadata.file_path"), "([0-9]+/[0-9]+/[0-9]+)[.]jsonl", 1)
    return lines.groupBy(name.alias("tile"), F.col("_metadata.file_path")).agg(F.count("value").alias("feature_count")).select(
        "tile", "feature_count")


@register("chart_config_current_items")
def q_chart_config_current_items(spark, d):
    _, cur_doc = P.chart_configs(X.fx_assess(spark, d), X.fx_pred(spark, d), PRED_BIN_WIDTH, PRED_TIE)
    items = cur_doc.select(F.posexplode(F.from_json("document", BIN_ITEM)).alias("position", "b"))
    return items.select(F.col("position").cast("bigint").alias("position"), "b.lower_bound", "b.upper_bound",
                        "b.property_count")


@register("stream_prepare")
def q_stream_prepare(spark, d):
    landing, out, ckpt = (shared_dir(spark, "land-stream"), shared_dir(spark, "prepared"),
                          shared_dir(spark, "stream-ckpt"))
    c = X.table(spark, d, "customer")
    _land_csv(c, landing)
    prepare_stream(spark, landing, [x.upper() for x in c.columns], out, ckpt)
    return spark.read.parquet(out)


# Parsed-back views of the JSON documents: content and order are checked
# against SQL without comparing JSON number formatting between engines.
BIN_ITEM = "array<struct<tax_year:string,lower_bound:bigint,upper_bound:bigint,property_count:bigint>>"


@register("chart_config_items")
def q_chart_config_items(spark, d):
    tax_doc, _ = P.chart_configs(X.fx_assess(spark, d), X.fx_pred(spark, d), tie=PRED_TIE)
    items = tax_doc.select(F.posexplode(F.from_json("document", BIN_ITEM)).alias("position", "b"))
    return items.select(F.col("position").cast("bigint").alias("position"), "b.*")


@register("style_metadata_items")
def q_style_metadata_items(spark, d):
    doc = P.tile_style_metadata(tile_frame(spark, d), run_at=F.to_timestamp(F.lit(X.RUN_AT)))
    schema = ("struct<generated_at:string,source:string,layers:map<string,"
              "struct<min:double,max:double,count:bigint,breakpoints:array<double>>>>")
    parsed = doc.select(F.from_json("document", schema).alias("j"))
    lay = parsed.select("j.generated_at", "j.source", F.explode("j.layers").alias("field", "l"))
    return rounded(lay.select("generated_at", "source", "field", F.col("l.min").alias("min"),
                              F.col("l.max").alias("max"), F.col("l.count").alias("count"),
                              *[F.col("l.breakpoints")[i].alias(f"bp{i}") for i in range(4)]))


@register("geojson_feature_props")
def q_geojson_feature_props(spark, d):
    f = sinks.geojson_features(tile_frame(spark, d))
    schema = ("struct<type:string,geometry:struct<type:string>,properties:struct<"
              "property_id:string,address:string,current_assessed_value:double,"
              "tax_year_assessed_value:double>>")
    j = f.select(F.from_json("feature", schema).alias("j"))
    return rounded(j.select(F.col("j.type").alias("feature_type"),
                            F.col("j.geometry.type").alias("geometry_type"), "j.properties.*"))


@register("records_json_items")
def q_records_json_items(spark, d):
    j = _sale_records(spark, d).select(F.from_json(
        "record", "struct<property_id:string,sale_price:string,sale_date:string,total_livable_area:double>").alias("j"))
    return rounded(j.select("j.*"))
