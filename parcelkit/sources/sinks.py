"""Writers (I5, I6, I11-I14).  Counts come from an ``Observation`` on
the same pass as the write; JSON documents are built by aggregates over
already-small frames (bins, per-field statistics)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_parquet_counted(df: DataFrame, path: str,
                          partition_by: Sequence[str] = ()) -> int:
    """Overwrite ``path`` with ``df``; the row count comes from the same pass.

    ``partition_by`` lays out one folder per value, so filters on those
    columns, including runtime scalar-subquery filters, prune whole folders at
    read time; rows are rebalanced on them first, which gives a folder few
    files and splits a large one."""
    obs = Observation("parquet_sink")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def write_jsonl_counted(df: DataFrame, path: str) -> int:
    obs = Observation("jsonl_sink")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
    return int(obs.get["rows"])


def bins_document(bins: DataFrame, year_col: str | None = "tax_year") -> DataFrame:
    """One-row frame holding the ordered JSON array of bins.

    ``tax_year`` is emitted as a string.  The input is a bin table (years x
    value range / width rows), never raw rows.
    """
    fields = ([F.col(year_col).cast("string").alias("tax_year")] if year_col else []) + [
        F.col("lower_bound"), F.col("upper_bound"), F.col("property_count")]
    order = ([F.col(year_col).cast("string")] if year_col else [])
    items = bins.select(F.struct(*order, F.col("lower_bound"), F.struct(*fields).alias("v"))
                        .alias("s"))
    arr = F.transform(F.array_sort(F.collect_list("s")), lambda s: s["v"])
    return items.agg(F.to_json(arr).alias("document"))


def style_document(layers: DataFrame, source: str, run_at: Column | None = None) -> DataFrame:
    """``{generated_at, source, layers: {field: {min, max, count, breakpoints}}}``."""
    at = F.date_format(run_at if run_at is not None else F.current_timestamp(),
                       "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.struct(F.col("field"), F.struct(F.col("min").cast("double").alias("min"),
                                              F.col("max").cast("double").alias("max"),
                                              F.col("count"),
                                              F.col("breakpoints").cast("array<double>")
                                              .alias("breakpoints")))
    return layers.agg(F.to_json(F.struct(at.alias("generated_at"), F.lit(source).alias("source"),
                                         F.map_from_entries(F.collect_list(entry)).alias("layers")))
                      .alias("document"))


def geojson_features(df: DataFrame, geometry: str = "geog",
                     props: Sequence[str] = ("property_id", "address", "current_assessed_value",
                                             "tax_year_assessed_value"),
                     carry: Sequence[str] = ()) -> DataFrame:
    """One GeoJSON Feature (one line of text) per row; decimals as floats,
    geometry as an object, written anew from the parsed text (so white space
    and line breaks in it do not matter); unparsable geometry drops out."""
    cols = [F.col(p).cast("double").alias(p) if dict(df.dtypes)[p].startswith("decimal")
            else F.col(p) for p in props]
    props_json = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    shape = F.to_json(F.try_parse_json(F.col(geometry)))
    feat = F.concat(F.lit('{"type":"Feature","geometry":'), shape,
                    F.lit(',"properties":'), props_json, F.lit("}"))
    extra = [c for c in carry if c not in props]
    # Not a filter, which would be pushed down below a shuffle and parse the text a second time.
    return df.select(*props, *extra, F.explode(F.filter(F.array(feat), lambda f: f.isNotNull())).alias("feature"))


def write_text(df: DataFrame, col: str, path: str, compression: str | None = None) -> None:
    w = df.select(col).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def records_with_strings(df: DataFrame) -> DataFrame:
    """Record list where decimals, dates and timestamps become strings; NULL fields stay, as null."""
    cols = []
    for c, t in df.dtypes:
        if t.startswith("decimal") or t in ("date", "timestamp", "timestamp_ntz"):
            cols.append(F.col(c).cast("string").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))
