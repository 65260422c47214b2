"""Safe casts and the retype-and-pass-through projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The NUMERIC type used for money and areas (precision is a
# choice; the source system does not state one).
DECIMAL_TYPE = "decimal(38,9)"

# A date string must start with a full calendar date.  Spark
# would otherwise accept '2023' or '12:30' as timestamps.
DATE_PREFIX = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_long(c: str | Column) -> Column:
    """String -> BIGINT, anything unparsable -> NULL (no rounding of '12.6')."""
    return _c(c).try_cast("bigint")


def safe_decimal(c: str | Column, dtype: str = DECIMAL_TYPE) -> Column:
    return _c(c).try_cast(dtype)


def safe_double(c: str | Column) -> Column:
    return _c(c).try_cast("double")


def safe_date(c: str | Column) -> Column:
    """String -> timestamp -> date; plain dates, 'T' and space forms accepted.

    Strings that do not begin with a full yyyy-m-d date give NULL.
    """
    col = _c(c).cast("string")
    return F.when(col.rlike(DATE_PREFIX), F.to_date(col.try_cast("timestamp")))


_CASTERS = {
    "long": safe_long,
    "bigint": safe_long,
    "decimal": safe_decimal,
    "double": safe_double,
    "date": safe_date,
    "string": lambda c: _c(c).cast("string"),
}


def retype(df: DataFrame, spec: Mapping[str, str], key: str | None = None,
           key_from: str | None = None) -> DataFrame:
    """Retype listed columns first, pass every other column through unchanged.

    ``spec`` maps column -> one of long/decimal/double/date/string.  When
    ``key`` and ``key_from`` are given, ``key_from`` is copied as a string
    key column placed first (the original is kept).  A listed column that is
    missing raises, unknown extra columns flow through as they are.
    """
    missing = [c for c in spec if c not in df.columns]
    if missing:
        raise ValueError(f"retype: columns not in input: {missing}")
    head = []
    if key and key_from:
        head.append(F.col(key_from).cast("string").alias(key))
        if key_from not in spec:
            head.append(F.col(key_from))
    typed = [_CASTERS[t](c).alias(c) for c, t in spec.items()]
    rest = [F.col(c) for c in df.columns
            if c not in spec and c != key_from and c != key]
    return df.select(*head, *typed, *rest)
