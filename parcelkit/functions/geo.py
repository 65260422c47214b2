"""GeoJSON parsing, bounding boxes and slippy-map tile math.

Geometry is kept as GeoJSON text next to a parsed
``array<array<array<array<double>>>>`` (polygons -> rings -> positions), so
Polygon and MultiPolygon share one shape.  Validity checked: JSON parses,
type is Polygon or MultiPolygon, every ring has >= 4 positions and is
closed, every position has >= 2 numbers inside lon [-180, 180] and
lat [-90, 90], and the shape keeps the rules of ``functions.shapes`` (simple
rings, holes inside their shell, parts apart).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelkit.functions.shapes import valid_only

# Fixed value: latitude at which the square web map ends.
MERCATOR_LIMIT = 85.0511287798066

POLYGON_T = "array<array<array<double>>>"
MULTI_T = "array<array<array<array<double>>>>"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def geojson_polygons(text: str | Column, check_shapes: bool = True) -> Column:
    """Parsed polygons of a GeoJSON geometry, NULL when invalid.  ``check_shapes=False`` leaves out how rings
    and parts lie to each other: for text that a check has already passed.

    Each intermediate (the parsed variant, the raw coordinates) is bound
    once through a one-element ``transform`` / ``filter`` lambda, so the
    text appears once in the expression tree.  When Catalyst inlines this
    column into a pushed-down filter (e.g. ``geometry IS NOT NULL`` on a
    derived frame) the parse is copied once, not once per reference.
    """
    parsed = F.array(F.try_parse_json(_c(text)))
    raw = F.try_element_at(F.transform(parsed, _raw_from_variant), F.lit(1))
    whole = F.filter(F.array(raw), _valid_polys)
    return F.try_element_at(valid_only(whole) if check_shapes else whole, F.lit(1))


def _raw_from_variant(v: Column) -> Column:
    gtype = F.try_variant_get(v, "$.type", "string")
    return (F.when(gtype == "Polygon", F.array(F.try_variant_get(v, "$.coordinates", POLYGON_T)))
            .when(gtype == "MultiPolygon", F.try_variant_get(v, "$.coordinates", MULTI_T)))


def _valid_polys(polys: Column) -> Column:
    return (F.coalesce(F.size(polys) > 0, F.lit(False))
            & F.coalesce(F.forall(polys, _poly_ok), F.lit(False)))


def with_polygons(df, text: str, out: str = "polygons", type_col: str | None = None, check_shapes: bool = True):
    """Add parsed polygons (and optionally the GeoJSON type) to ``df``."""
    out_df = df.withColumn(out, geojson_polygons(text, check_shapes))
    if type_col:
        out_df = out_df.withColumn(type_col, geojson_type(text))
    return out_df


def _poly_ok(p: Column) -> Column:
    def ring_ok(r: Column) -> Column:
        pos_ok = F.forall(r, lambda pt: (F.size(pt) >= 2)
                          & pt[0].between(-180, 180) & pt[1].between(-90, 90))
        return (F.size(r) >= 4) & (r[0] == F.element_at(r, -1)) & pos_ok
    return (F.size(p) > 0) & F.forall(p, ring_ok)


def geojson_type(text: str | Column) -> Column:
    return F.try_variant_get(F.try_parse_json(_c(text)), "$.type", "string")


def outer_ring_points(polys: str | Column) -> Column:
    """All positions of the outer ring of every polygon."""
    return F.flatten(F.transform(_c(polys), lambda p: p[0]))


def bbox(polys: str | Column) -> Column:
    """struct(west, south, east, north) over the outer rings."""
    pts = outer_ring_points(polys)
    lons = F.transform(pts, lambda pt: pt[0])
    lats = F.transform(pts, lambda pt: pt[1])
    return F.struct(F.array_min(lons).alias("west"), F.array_min(lats).alias("south"),
                    F.array_max(lons).alias("east"), F.array_max(lats).alias("north"))


def part_boxes(polys: str | Column) -> Column:
    """One box, struct(west, south, east, north), per polygon of a feature (its outer ring)."""
    def box(p: Column) -> Column:
        lons, lats = F.transform(p[0], lambda pt: pt[0]), F.transform(p[0], lambda pt: pt[1])
        return F.struct(F.array_min(lons).alias("west"), F.array_min(lats).alias("south"),
                        F.array_max(lons).alias("east"), F.array_max(lats).alias("north"))
    return F.transform(_c(polys), box)


def tile_x(lon: Column, z: Column) -> Column:
    n = F.pow(F.lit(2.0), z)
    x = F.floor((lon + F.lit(180.0)) / F.lit(360.0) * n)
    # greatest/least skip NULLs, so keep a NULL coordinate NULL explicitly
    return F.when(lon.isNotNull(), F.least(F.greatest(x, F.lit(0)), n.cast("bigint") - 1)
                  .cast("bigint"))


def tile_y(lat: Column, z: Column) -> Column:
    n = F.pow(F.lit(2.0), z)
    # beyond the projection's limit the formula loses the sign of the pole: clamp first
    rad = F.radians(F.least(F.greatest(lat, F.lit(-MERCATOR_LIMIT)), F.lit(MERCATOR_LIMIT)))
    merc = F.ln(F.tan(rad) + F.lit(1.0) / F.cos(rad))
    y = F.floor((F.lit(1.0) - merc / F.lit(3.141592653589793)) / F.lit(2.0) * n)
    return F.when(lat.isNotNull(), F.least(F.greatest(y, F.lit(0)), n.cast("bigint") - 1)
                  .cast("bigint"))
