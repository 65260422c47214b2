"""Data products of the weekly pipeline (P1-P11), built from operators.

Inputs are core-shaped frames:
  assessments: property_id, year, market_value, taxable_*/exempt_*
  predictions: property_id, predicted_value, predicted_at (+ tie column)
  properties:  property_id, location, zip_code, category_code, ...
  parcels:     property_id, geometry (GeoJSON text)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.functions.geo import geojson_polygons
from parcelkit.operators.bins import BIN_WIDTH, value_bins
from parcelkit.operators.dedupe import latest_group_rows, latest_per_key
from parcelkit.operators.features import TILE_CODES
from parcelkit.operators.stats import field_stats, style_layers
from parcelkit.sources.sinks import bins_document, style_document

TILE_FIELDS = ["current_assessed_value", "tax_year_assessed_value"]


def core_parcel_geometry(parcels: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Core parcels: geometry text kept only where it parses as a valid
    Polygon / MultiPolygon (safe parse: invalid -> NULL).  Parsed once."""
    return parcels.withColumn(geometry, F.when(geojson_polygons(geometry).isNotNull(), F.col(geometry)))


def tax_year_bins(assessments: DataFrame, width: int = BIN_WIDTH, value: str = "market_value",
                  year: str = "year") -> DataFrame:
    """tax_year, lower_bound, upper_bound, property_count."""
    src = assessments.select(F.col(year).alias("tax_year"), F.col(value))
    return value_bins(src, value, width, by=["tax_year"])


def latest_predictions(predictions: DataFrame, tie: Sequence[str] = (),
                       valid_only: bool = False) -> DataFrame:
    """Latest prediction per property; ``valid_only`` drops NULL/negative
    values *before* ranking (the binning rule).  Ties go by ``tie``, then to
    the larger value."""
    v = F.col("predicted_value")
    where = (v.isNotNull() & (v >= 0)) if valid_only else None
    return latest_per_key(predictions, "property_id", "predicted_at", tie=(*tie, "predicted_value"),
                          where=where)


def current_bins(predictions: DataFrame, width: int = BIN_WIDTH,
                 tie: Sequence[str] = ()) -> DataFrame:
    """lower_bound, upper_bound, property_count over latest valid predictions."""
    return value_bins(latest_predictions(predictions, tie, valid_only=True),
                      "predicted_value", width)


def tile_info(properties: DataFrame, parcels: DataFrame, assessments: DataFrame,
              predictions: DataFrame, codes: Sequence[str] = TILE_CODES,
              tie: Sequence[str] = (), check_geometry: bool = False) -> DataFrame:
    """property_id, address, zip_code, geog, current_assessed_value,
    tax_year_assessed_value.

    Latest tax year via scalar subquery (runtime filter on the scan);
    one property may match several parcels and several latest-year
    assessment rows (fan-out kept, as in the source SQL).
    ``check_geometry``: the parcels are raw; their geometry is parsed after
    the category filter and the join, and invalid ones drop out."""
    la = (latest_group_rows(assessments, "year")
          .select("property_id", F.col("market_value").alias("tax_year_assessed_value")))
    cp = (latest_predictions(predictions, tie)
          .select("property_id", F.col("predicted_value").alias("current_assessed_value")))
    o = properties.where(F.col("category_code").isin(list(codes))).select(
        "property_id", F.col("location").alias("address"), "zip_code")
    par = parcels.where(F.col("geometry").isNotNull()).select(
        "property_id", F.col("geometry").alias("geog"))
    out = (o.join(par, "property_id", "inner").join(la, "property_id", "left")
           .join(cp, "property_id", "left")
           .select("property_id", "address", "zip_code", "geog", "current_assessed_value",
                   "tax_year_assessed_value"))
    if not check_geometry:
        return out
    # An explode, not a filter: a filter would be pushed below the join, onto every parcel.
    valid = F.explode(F.when(geojson_polygons("geog").isNotNull(), F.array("geog")))
    return out.select(*[valid.alias(c) if c == "geog" else F.col(c) for c in out.columns])


def tile_style_stats(tile_info_df: DataFrame, fields: Sequence[str] = TILE_FIELDS,
                     accuracy: int = 10000) -> DataFrame:
    return field_stats(tile_info_df, list(fields), 5, accuracy)


def tile_style_metadata(tile_info_df: DataFrame, source: str = "derived.property_tile_info",
                        run_at=None) -> DataFrame:
    return style_document(style_layers(tile_style_stats(tile_info_df)), source, run_at)


def tax_year_assessments(assessments: DataFrame) -> DataFrame:
    return assessments.select(F.col("year").alias("tax_year"), "property_id",
                              F.col("market_value").alias("assessed_value"))


def chart_configs(assessments: DataFrame, predictions: DataFrame, width: int = BIN_WIDTH,
                  tie: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    return (bins_document(tax_year_bins(assessments, width), "tax_year"),
            bins_document(current_bins(predictions, width, tie), None))
