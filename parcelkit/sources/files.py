"""Landed-file readers.

CSV is read without schema inference: every column is a string, header
names are lower-cased.  A plain CSV read stays splittable; only the
quoted-newline reader (``multiLine``) reads each file whole, so landed
data should arrive as many page files.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings read as NULL by the raw CSV source (quoted or bare).
NULL_SPELLINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null"]

# Landed parcel columns (geometry as GeoJSON text).
PARCEL_COLUMNS = ["objectid", "parcelid", "tencode", "address", "owner1", "owner2",
                  "bldg_code", "bldg_desc", "brt_id", "num_brt", "num_accounts",
                  "gross_area", "pin", "parcel_id", "geometry"]


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def string_schema(cols: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def read_raw_csv(spark: SparkSession, path: str | Sequence[str],
                 null_tokens: Sequence[str] = NULL_SPELLINGS, multi_line: bool = False) -> DataFrame:
    """All-string CSV with lower-cased header; any null spelling -> NULL."""
    df = _lower(spark.read.csv(path, header=True, escape='"', inferSchema=False,
                               multiLine=multi_line))
    toks = list(null_tokens)
    return df.select(*[F.when(F.col(c).isin(toks), F.lit(None).cast("string"))
                       .otherwise(F.col(c)).alias(c) for c in df.columns])


def read_text_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All-string CSV that accepts quoted newlines; empty stays ''."""
    df = _lower(spark.read.csv(path, header=True, escape='"', inferSchema=False,
                               multiLine=True, emptyValue=""))
    return df.na.fill("")


def read_pages(spark: SparkSession, directory: str, columns: Sequence[str] | None = None,
               page_rows: int | None = None) -> DataFrame:
    """Page files of one export (each with its header) read as one table;
    blank lines are skipped, headers of every page are dropped.

    With ``page_rows`` the pages, in order of their file names, end at the first short or empty one, as a
    reader would that asks for page after page; a header alone counts as empty.  Rows are counted by page in
    one pass, combined before the shuffle."""
    raw = spark.read.csv(directory, header=True, escape='"', inferSchema=False)
    page = F.col("_metadata.file_name")
    if page_rows is not None:
        held = raw.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("n"))
        # Spark's scans pass over files of no bytes; its list of the files, which the driver holds anyway, has them.
        names = [(unquote(f.rpartition("/")[2]),) for f in raw.inputFiles()]
        pages = spark.createDataFrame(names, "page string")
        short = F.coalesce(F.col("n"), F.lit(0)) < page_rows
        last = pages.join(held, "page", "left").agg(F.min(F.when(short, F.col("page")))).scalar()
        raw = raw.where(page <= F.coalesce(last, page))
    df = _lower(raw)
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"listed columns are not in the export: {', '.join(missing)}")
        df = df.select(*columns)
    return df


def read_parquet_table(spark: SparkSession, glob: str, view: str | None = None) -> DataFrame:
    """External Parquet table over a glob of prepared files."""
    df = spark.read.parquet(glob)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_jsonl_strings(spark: SparkSession, glob: str, columns: Sequence[str]) -> DataFrame:
    """NDJSON with a given all-string schema, so ids are never inferred as numbers."""
    return spark.read.schema(string_schema(columns)).json(glob)
