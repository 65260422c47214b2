"""Named layers of tables that are replaced in one step.

A layer is a database.  What readers name, ``core.properties``, is a view of one
version, a table ``core.properties__v...`` that was written whole before.
Replacing writes a new version first and then points the view to it, one change of
one catalog entry: a job that dies before leaves the old rows, readers that
began before keep theirs, and the schema may change with the version.  The
newest ``keep`` versions stay; older ones are dropped with their files.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The layers.
LAYERS = ("source", "core", "derived")
KEEP = 2


def create_layers(spark: SparkSession, root: str, prefix: str = "", layers: Sequence[str] = LAYERS) -> None:
    """The layers as databases, in folders of ``root`` unless they are there already."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{root.rstrip('/')}/{layer}'")


def versions(spark: SparkSession, layer: str, name: str) -> list[str]:
    """Names of a table's versions, the newest last."""
    found = spark.sql(f"SHOW TABLES IN `{layer}` LIKE '{name}__v*'").collect()
    return sorted(r.tableName for r in found)


def write_version(df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (), arranged: bool = False,
                  options: dict | None = None) -> tuple[str, int]:
    """A new version of a table, not yet visible by its name, and its rows.  With ``partition_by`` the rows are
    rebalanced first, so that a folder gets few files and a large one is split; ``arranged`` rows stay as they are."""
    stamp = dt.datetime.now(dt.UTC).strftime("%Y%m%d%H%M%S%f")
    version = f"{name}__v{stamp}_{uuid.uuid4().hex[:6]}"
    obs = Observation("version")
    rows = df.hint("rebalance", *partition_by) if partition_by and not arranged else df
    (rows.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("parquet").options(**(options or {}))
     .partitionBy(*partition_by).saveAsTable(f"`{layer}`.`{version}`"))
    return version, int(obs.get["rows"])


def switch(spark: SparkSession, layer: str, name: str, version: str) -> None:
    """Point a table's name to a version: one change of one catalog entry."""
    verb = "ALTER VIEW" if spark.catalog.tableExists(f"`{layer}`.`{name}`") else "CREATE VIEW"
    spark.sql(f"{verb} `{layer}`.`{name}` AS SELECT * FROM `{layer}`.`{version}`")


def drop_old(spark: SparkSession, layer: str, name: str, current: str, keep: int = KEEP) -> None:
    """Drop all but the newest ``keep`` versions up to the current one, and what failed runs left before it."""
    older = [v for v in versions(spark, layer, name) if v <= current]
    for v in older[:-keep]:
        spark.sql(f"DROP TABLE `{layer}`.`{v}`")


def publish(df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (), arranged: bool = False,
            options: dict | None = None, keep: int = KEEP) -> int:
    """Replace ``layer.name`` by the rows of ``df`` (which may read the table itself); returns their number."""
    spark = df.sparkSession
    version, rows = write_version(df, layer, name, partition_by, arranged, options)
    switch(spark, layer, name, version)
    drop_old(spark, layer, name, version, max(keep, 1))
    return rows
