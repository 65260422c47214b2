"""Prepare step as an incremental file stream (I1 + I5).

New CSV pages landed in a folder are typed as all-string, lower-cased,
null-spelling-cleaned rows and appended to Parquet exactly once: the
checkpoint records which files were done, so a rerun after an executor
or driver loss resumes instead of re-reading everything.
``trigger(availableNow=True)`` processes what has landed and stops, which
matches a weekly batch cadence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from parcelkit.sources.files import NULL_SPELLINGS, string_schema


def prepare_stream(spark: SparkSession, landing: str, columns: Sequence[str], out: str,
                   checkpoint: str, null_tokens: Sequence[str] = NULL_SPELLINGS,
                   max_files_per_trigger: int | None = None) -> None:
    """Run the landed-CSV -> Parquet stream until the landed files are done.

    ``columns`` is the header (any case) of the landed files; output names
    are lower-cased.
    """
    reader = (spark.readStream.schema(string_schema(list(columns)))
              .option("header", True).option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing)
    toks = list(null_tokens)
    typed = raw.select(*[F.when(F.col(c).isin(toks), F.lit(None).cast("string"))
                         .otherwise(F.col(c)).alias(c.lower()) for c in columns])
    q = (typed.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(out))
    q.awaitTermination()
