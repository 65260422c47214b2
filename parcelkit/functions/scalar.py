"""Scalar feature and classification expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference year for property age and the age validity window.
REF_YEAR = 2025
AGE_MIN, AGE_MAX = 0, 200

# Zoning prefix groups, first match wins, everything else Other.
ZONING_GROUPS = [
    (("RM",), "Residential_Multi"),
    (("RSA", "RSD"), "Residential_Single"),
    (("CMX", "CA"), "Commercial"),
    (("I",), "Industrial"),
]
ZONING_OTHER = "Other"

# Category code labels shown for a property, fallback "Category n".
CATEGORY_LABELS = {
    "1": "Single Family",
    "2": "Multi Family",
    "8": "Residential Garage",
    "13": "Vacant Land (Res.)",
    "14": "Apartment 5+ Units",
}

# Class edges for the three map colourings.
VALUE_BREAKPOINTS_CURRENT = [50000, 100000, 200000, 500000]
VALUE_BREAKPOINTS_TAX_YEAR = [136200, 191000, 254200, 335200]
PCT_CHANGE_EDGES = [-0.2, -0.05, 0.05, 0.2, 0.5]
DOLLAR_CHANGE_EDGES = [-50000, -10000, 10000, 50000, 100000]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_bin_lower(v: str | Column, width: int) -> Column:
    """Lower edge of the fixed-width bin holding ``v`` as BIGINT.

    Doubles use ``floor(v / width)``; decimals use ``v - pmod(v, width)`` so
    that a decimal division never rounds a value just under an edge upward.
    """
    col = _c(v)
    return F.floor(col / F.lit(width)).cast("bigint") * F.lit(width)


def value_bin_lower_decimal(v: str | Column, width: int) -> Column:
    col = _c(v)
    return (col - F.pmod(col, F.lit(width))).cast("bigint")


def log1p_safe(x: str | Column) -> Column:
    """``ln(x + 1)``; non-positive arguments give NULL instead of an error."""
    arg = _c(x).cast("double") + F.lit(1.0)
    return F.when(arg > 0, F.ln(arg))


def ln_safe(x: str | Column) -> Column:
    arg = _c(x).cast("double")
    return F.when(arg > 0, F.ln(arg))


def property_age(year_built: str | Column, ref_year: int = REF_YEAR,
                 bounded: bool = False) -> Column:
    age = F.lit(ref_year) - _c(year_built)
    if bounded:
        return F.when(age.between(AGE_MIN, AGE_MAX), age)
    return age


def days_since(d: str | Column, as_of: str | Column | None = None) -> Column:
    """Whole days from ``d`` to ``as_of`` (default: the current date)."""
    ref = F.current_date() if as_of is None else (
        F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)
    return F.datediff(ref, _c(d))


def starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    cond = None
    for p in prefixes:
        t = c.startswith(p)
        cond = t if cond is None else (cond | t)
    return cond


def prefix_group(c: str | Column, groups=ZONING_GROUPS, other: str = ZONING_OTHER) -> Column:
    """Case table on string prefixes; first match wins, NULL input -> other."""
    col = _c(c)
    out = None
    for prefixes, label in groups:
        cond = F.coalesce(starts_with_any(col, prefixes), F.lit(False))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(other)


def house_number(address: str | Column) -> Column:
    """Leading digits of an address ('' when there are none)."""
    return F.regexp_extract(F.trim(_c(address)), r"^\d+", 0)


def address_key(address: str | Column) -> Column:
    """Search key: first two whitespace-separated words, upper-cased."""
    words = F.split(F.trim(_c(address)), r"\s+")
    return F.upper(F.array_join(F.slice(words, 1, 2), " "))


def street_key(house: str | Column, street: str | Column, typed: str | Column) -> Column:
    """Search key of a geocoder's answer: the house number (if it gives none, the one that was typed) and the
    street's first word, upper-cased; an empty part is left out."""
    number = F.coalesce(F.nullif(_c(house), F.lit("")), house_number(typed), F.lit(""))
    word = F.coalesce(F.split(_c(street), " ")[0], F.lit(""))
    return F.upper(F.array_join(F.filter(F.array(number, word), lambda x: x != ""), " "))


def zip_valid(z: str | Column) -> Column:
    return F.coalesce(_c(z).rlike(r"^\d{5}$"), F.lit(False))


def js_round(x: str | Column) -> Column:
    """Half towards +infinity, as a browser rounds: floor(x + 0.5)."""
    return F.floor(_c(x) + F.lit(0.5)).cast("bigint")


def category_label(code: str | Column, labels: Mapping[str, str] = CATEGORY_LABELS) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    col = _c(code).cast("string")
    return F.coalesce(F.element_at(lookup, col), F.concat(F.lit("Category "), col))


def step_class(x: str | Column, edges: Sequence[float]) -> Column:
    """Class index 0..len(edges): number of edges at or below ``x``."""
    col = _c(x)
    total = None
    for e in edges:
        t = F.when(col >= F.lit(e), 1).otherwise(0)
        total = t if total is None else total + t
    return total.cast("int")


def both_positive(cur: str | Column, tax: str | Column) -> Column:
    return (F.coalesce(_c(cur), F.lit(0)) > 0) & (F.coalesce(_c(tax), F.lit(0)) > 0)


def value_class(v: str | Column, breakpoints: Sequence[float] = VALUE_BREAKPOINTS_CURRENT) -> Column:
    """Five value classes (0-4); missing counts as 0."""
    return step_class(F.coalesce(_c(v).cast("double"), F.lit(0.0)), breakpoints)


def pct_change_class(cur: str | Column, tax: str | Column) -> Column:
    """Six classes 0-5 of (cur - tax) / tax; NULL is the no-data class."""
    ratio = (_c(cur) - _c(tax)) / _c(tax)
    return F.when(both_positive(cur, tax), step_class(ratio, PCT_CHANGE_EDGES))


def dollar_change_class(cur: str | Column, tax: str | Column) -> Column:
    return F.when(both_positive(cur, tax), step_class(_c(cur) - _c(tax), DOLLAR_CHANGE_EDGES))
