"""Address prefix search, plain and through an index, and the batched property profile."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.operators.features import TILE_CODES
from parcelkit.sources.layers import publish

# Search result size and history length.
SEARCH_LIMIT = 5
HISTORY_LIMIT = 50
PROFILE_FIELDS = ["property_id", "location", "owner_1", "market_value", "taxable_land",
                  "taxable_building", "exempt_land", "exempt_building", "year_built",
                  "number_of_bedrooms", "number_of_bathrooms", "total_livable_area",
                  "category_code"]
HISTORY_FIELDS = ["year", "market_value", "taxable_land", "taxable_building",
                  "exempt_land", "exempt_building"]


def prefix_search(df: DataFrame, text: str, col: str = "location",
                  codes: Sequence[str] | None = TILE_CODES, key: str = "property_id",
                  n: int = SEARCH_LIMIT, literal: bool = False) -> DataFrame:
    """Top-n rows whose upper-cased ``col`` starts with the trimmed,
    upper-cased input.  ``literal=False`` keeps LIKE wildcards in the input
    live; ``literal=True`` matches the text verbatim."""
    p = text.strip().upper()
    up = F.upper(F.col(col))
    cond = up.startswith(p) if literal else up.like(p + "%")
    if codes is not None:
        cond = cond & F.col("category_code").isin(list(codes))
    return df.where(cond).orderBy(F.col(col), F.col(key)).limit(n)


BUCKET_LETTERS = 2      # of the upper-cased address: the index's folders
KEY_BLOOM = {"parquet.bloom.filter.enabled#property_id": "true"}


def write_search_index(df: DataFrame, layer: str, name: str, col: str = "location", key: str = "property_id") -> int:
    """Publish ``df`` laid out for ``indexed_search``: with its upper-cased address ``search_key``, in folders by
    the first letters, range-partitioned and sorted inside, so that a folder with many rows has several files
    with statistics of narrow ranges."""
    up = F.upper(F.col(col))
    out = df.withColumns({"search_key": up, "bucket": F.substring(up, 1, BUCKET_LETTERS)})
    out = out.repartitionByRange("search_key", key).sortWithinPartitions("bucket", "search_key", col, key)
    return publish(out, layer, name, ["bucket"], arranged=True, options=KEY_BLOOM)


def after_prefix(head: str) -> str | None:
    """The least text above all that begin with ``head``, in order of code points; None if there is none."""
    for i in range(len(head) - 1, -1, -1):
        c = ord(head[i]) + 1
        if c <= 0x10FFFF:
            return head[:i] + chr(0xE000 if 0xD800 <= c <= 0xDFFF else c)
    return None


def indexed_search(index: DataFrame, text: str, col: str = "location", codes: Sequence[str] | None = TILE_CODES,
                   key: str = "property_id", n: int = SEARCH_LIMIT, literal: bool = False) -> DataFrame:
    """``prefix_search`` on a search index, same rows: what stands before the first wildcard becomes a range of
    ``search_key`` and a choice of folders, which reach the scan."""
    p = text.strip().upper()
    head = p if literal else re.split(r"[%_\\]", p)[0]
    cond = F.col("search_key").startswith(p) if literal else F.col("search_key").like(p + "%")
    if head:
        cond = cond & (F.col("search_key") >= head)
        if (end := after_prefix(head)) is not None:
            cond = cond & (F.col("search_key") < end)
        if len(head) >= BUCKET_LETTERS:
            cond = cond & (F.col("bucket") == head[:BUCKET_LETTERS])
        else:
            cond = cond & F.col("bucket").startswith(head)
    if codes is not None:
        cond = cond & F.col("category_code").isin(list(codes))
    return index.where(cond).orderBy(F.col(col), F.col(key)).limit(n).drop("search_key", "bucket")


def write_key_index(df: DataFrame, layer: str, name: str, order: Sequence[str] = (), key: str = "property_id") -> int:
    """Publish ``df`` laid out for lookups by key: range-partitioned and sorted by it, with a bloom filter on it."""
    out = df.repartitionByRange(key).sortWithinPartitions(key, *order)
    return publish(out, layer, name, arranged=True, options=KEY_BLOOM)


def profile_of(keys: Sequence[str], properties: DataFrame, assessments: DataFrame, n: int = HISTORY_LIMIT,
               key: str = "property_id") -> DataFrame:
    """Profiles of some keys (a request's, not a table's): the keys reach both scans as a pushed filter, so on
    tables laid out by ``write_key_index`` only the row groups that may hold them are read."""
    asked = properties.sparkSession.createDataFrame([(k,) for k in keys], f"{key} string")
    hit = F.col(key).isin(list(keys))
    return property_profile(asked, properties.where(hit), assessments.where(hit), n, key)


def property_profile(keys: DataFrame, properties: DataFrame, assessments: DataFrame,
                     n: int = HISTORY_LIMIT, key: str = "property_id",
                     nested: bool = True) -> DataFrame:
    """Profiles for a frame of keys: property fields plus up to ``n``
    assessments ascending by year.  Keys without a property are dropped.

    The history cap is ``row_number <= n`` (partial WindowGroupLimit before
    the shuffle), so the collected array per key is bounded by ``n``.
    """
    k = keys.select(key).distinct()
    props = properties.select(*PROFILE_FIELDS)
    w1 = Window.partitionBy(key).orderBy(*[F.col(c) for c in PROFILE_FIELDS if c != key])
    prop1 = props.withColumn("_rn", F.row_number().over(w1)).where("_rn = 1").drop("_rn")
    hist_order = [F.col("year")] + [F.col(c) for c in HISTORY_FIELDS if c != "year"]
    w = Window.partitionBy(key).orderBy(*hist_order)
    hist = (assessments.join(k, key, "left_semi").select(key, *HISTORY_FIELDS)
            .withColumn("history_pos", F.row_number().over(w)).where(F.col("history_pos") <= n))
    base = k.join(prop1, key, "inner")
    if not nested:
        flat = hist.select(key, "year", "history_pos",
                           *[F.col(c).alias(f"{c}_h") for c in HISTORY_FIELDS if c != "year"])
        return base.join(flat, key, "left")
    agg = hist.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct("history_pos", *HISTORY_FIELDS))).alias("assessments"))
    return base.join(agg, key, "left").withColumn(
        "assessments", F.coalesce(F.col("assessments"), F.array()))
