"""The weekly batch, in dependency order, as Spark jobs.

raw CSV pages -> all-string Parquet -> typed core tables -> training
rows -> forest -> predictions -> bins, tile table, style metadata,
chart documents, tile tree.  Training rows are rebuilt *before* the
model is trained (the source workflow trains on last week's rows).
Every table of the layers source, core and derived is written whole as a new
version and then switched to in one step (``sources.layers``): a run that
dies leaves last week's tables, and every step reads the layer before by
name.  Lineage is cut at each written table, so a lost executor only
recomputes the stage it was running.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.functions.casts import retype
from parcelkit.functions.geo import with_polygons
from parcelkit.operators.features import assessment_inputs, feature_frame, training_rows
from parcelkit.operators.lookup import write_key_index, write_search_index
from parcelkit.operators.model import evaluate, fit_version, predict
from parcelkit.operators.tiles import write_tiles
from parcelkit.plans import products
from parcelkit.sources.files import read_raw_csv, read_text_csv
from parcelkit.sources.layers import create_layers, publish
from parcelkit.sources.sinks import geojson_features, write_text

# Typed columns of the core tables.
PROPERTY_TYPES = {
    "market_value": "decimal", "sale_price": "decimal", "taxable_land": "decimal",
    "taxable_building": "decimal", "exempt_land": "decimal", "exempt_building": "decimal",
    "total_livable_area": "decimal", "total_area": "decimal", "depth": "decimal",
    "frontage": "decimal", "off_street_open": "decimal", "garage_spaces": "long",
    "number_of_bedrooms": "long", "number_of_bathrooms": "decimal", "number_stories": "long",
    "year_built": "long", "sale_date": "date", "recording_date": "date",
    "market_value_date": "date", "assessment_date": "date",
}
ASSESSMENT_TYPES = {
    "year": "long", "market_value": "decimal", "taxable_land": "decimal",
    "taxable_building": "decimal", "exempt_land": "decimal", "exempt_building": "decimal",
}


@dataclass
class Paths:
    properties_csv: str
    assessments_csv: str
    parcels_csv: str
    root: str
    prefix: str = ""        # of the layers' names


def core_properties(raw: DataFrame) -> DataFrame:
    """Every listed column must be there; a vanished one is an error, not NULLs."""
    missing = [c for c in PROPERTY_TYPES if c not in raw.columns]
    if missing:
        raise ValueError(f"listed columns are not in the source: {', '.join(missing)}")
    return retype(raw, PROPERTY_TYPES, key="property_id", key_from="parcel_number")


def core_assessments(raw: DataFrame) -> DataFrame:
    return retype(raw, ASSESSMENT_TYPES, key="property_id", key_from="parcel_number")


def core_parcels(raw: DataFrame) -> DataFrame:
    keyed = raw.select(F.col("brt_id").cast("string").alias("property_id"),
                       *[c for c in raw.columns if c != "geometry"], "geometry")
    return products.core_parcel_geometry(keyed)


def run(spark: SparkSession, paths: Paths, trees: int | None = None, depth: int | None = None,
        as_of: str | None = None) -> dict[str, int]:
    out, version = paths.root.rstrip("/"), uuid.uuid4().hex[:12]
    counts: dict[str, int] = {}
    create_layers(spark, out, paths.prefix)

    def put(layer: str, name: str, df: DataFrame, parts: tuple[str, ...] = ()) -> DataFrame:
        counts[f"{layer}.{name}"] = publish(df, f"{paths.prefix}{layer}", name, parts)
        return table(layer, name)

    def table(layer: str, name: str) -> DataFrame:
        return spark.table(f"`{paths.prefix}{layer}`.`{name}`")

    # prepare: all-string Parquet (splittable CSV for properties and
    # assessments, quoted newlines allowed for parcels)
    put("source", "properties", read_raw_csv(spark, paths.properties_csv))
    put("source", "assessments", read_raw_csv(spark, paths.assessments_csv))
    put("source", "parcels", read_text_csv(spark, paths.parcels_csv))
    # core
    # assessments are laid out by year: the tile table's "latest tax year"
    # scalar subquery then prunes to one folder at run time
    props = put("core", "properties", core_properties(table("source", "properties")))
    assess = put("core", "assessments", core_assessments(table("source", "assessments")), ("year",))
    parcels = put("core", "parcels", core_parcels(table("source", "parcels")))
    # for lookups: the same rows sorted by address, and by key
    counts["derived.property_search"] = write_search_index(props, f"{paths.prefix}derived", "property_search")
    counts["derived.property_keys"] = write_key_index(props, f"{paths.prefix}derived", "property_keys")
    counts["derived.assessment_keys"] = write_key_index(assess, f"{paths.prefix}derived", "assessment_keys", ["year"])
    # training rows, then model, its error on held-out rows, then predictions
    training = put("derived", "training", training_rows(props))
    train = feature_frame(training, "deployed", as_of, keep=["property_id"])
    model, held = fit_version(train, "deployed", trees=trees, depth=depth)
    if model is None:
        raise ValueError("no training rows: last week's model and predictions stay")
    model.write().overwrite().save(f"{out}/derived/model")
    mean = train.agg(F.avg("sale_price")).first()[0]
    put("derived", "model_metrics", evaluate(model, held, mean, groups={"zip_code": F.col("zip_code")}))
    scoring = feature_frame(props, "deployed", as_of, label=None, keep=["property_id"],
                            for_predict=True)
    preds = put("derived", "current_assessments", predict(model, scoring))
    # products
    put("derived", "tax_year_bins", products.tax_year_bins(assess))
    put("derived", "current_bins", products.current_bins(preds))
    put("derived", "tax_year_assessments", products.tax_year_assessments(assess))
    put("derived", "assessment_inputs", assessment_inputs(props, as_of))
    ti = put("derived", "tile_info", products.tile_info(props, parcels, assess, preds))
    write_text(products.tile_style_metadata(ti), "document", f"{out}/public/style")
    tax_doc, cur_doc = products.chart_configs(assess, preds)
    write_text(tax_doc, "document", f"{out}/public/tax_year_bins")
    write_text(cur_doc, "document", f"{out}/public/current_bins")
    feats_df = geojson_features(ti, carry=("geog",))
    write_text(feats_df, "feature", f"{out}/public/features")
    # a fresh tree of tiles; the table of its objects, with the tree's folder, becomes the current one in one step
    tree = f"{out}/public/tiles/{version}"
    put("derived", "tiles", write_tiles(with_polygons(feats_df, "geog", check_shapes=False), tree)
        .withColumn("tree", F.lit(tree)))
    return counts


def main(argv: list[str] | None = None) -> None:
    """``python -m parcelkit.plans.job PROPS_CSV ASSESS_CSV PARCELS_CSV OUT_ROOT``"""
    import argparse
    import json

    from parcelkit.session import cluster_conf, get_session
    ap = argparse.ArgumentParser(description="weekly appraisal batch")
    ap.add_argument("properties_csv")
    ap.add_argument("assessments_csv")
    ap.add_argument("parcels_csv")
    ap.add_argument("root")
    ap.add_argument("--trees", type=int, default=None, help="instead of the deployed version's")
    ap.add_argument("--depth", type=int, default=None)
    ap.add_argument("--prefix", default="", help="of the layers' names")
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--input-bytes", type=float, default=None, help="size of the inputs, for the shuffle partitions")
    a = ap.parse_args(argv)
    spark = get_session(extra=cluster_conf(input_bytes=a.input_bytes))
    counts = run(spark, Paths(a.properties_csv, a.assessments_csv, a.parcels_csv, a.root, a.prefix),
                 trees=a.trees, depth=a.depth, as_of=a.as_of)
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
