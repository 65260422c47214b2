"""Property-shaped frames derived from the driver's TPC-H-style tables.

Each frame is a pure projection of one table (no filter, no row cap), so
every query built on it scans the whole table and its work grows with
the scale factor.  The same mappings are written in SQL in
``parcelkit.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.session import spread

# The as-of date and run stamp used by registered queries
# (no current_date, so results are repeatable), and the day shift that
# moves line-item ship dates into the training window.
AS_OF = "2026-06-30"
RUN_AT = "2026-06-30 12:00:00"
SALE_DAY_SHIFT = 9131


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def fx_assess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assessments from orders: one row per order (several per key and year)."""
    o = table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    return o.select(
        _s(F.col("o_custkey")).alias("property_id"),
        _s(F.col("o_custkey")).alias("parcel_number"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        p.alias("market_value"),
        (p * 0.2).alias("taxable_land"),
        (p * 0.7).alias("taxable_building"),
        F.lit(0.0).alias("exempt_land"),
        F.when(F.col("o_orderstatus") == "P", p * 0.1).otherwise(F.lit(0.0)).alias("exempt_building"),
        F.col("o_orderkey").alias("assessment_id"))


def fx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per (property, year): the sum of that year's assessments."""
    return (fx_assess(spark, sf_dir).groupBy("property_id", "year")
            .agg(F.sum("market_value").alias("market_value")))


def fx_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model predictions from events (several per key over time)."""
    e = table(spark, sf_dir, "events")
    return e.select(_s(F.col("user_id")).alias("property_id"),
                    F.col("value").alias("predicted_value"),
                    F.col("ts").alias("predicted_at"), "event_id")


def fx_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property sales from line items."""
    li = table(spark, sf_dir, "lineitem")
    ln, pk, sk, ok = (F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                      F.col("l_orderkey"))
    desc = (F.when(ln == 1, "SINGLE FAMILY").when(ln == 2, "MULTI FAMILY")
            .when(ln == 3, "APARTMENTS > 4 UNITS").when(ln == 4, "MIXED USE")
            .otherwise("COMMERCIAL"))
    zoning = (F.when(pk % 29 == 0, F.lit(None).cast("string"))
              .when(pk % 7 == 0, "RM1").when(pk % 7 == 1, "RSA5").when(pk % 7 == 2, "RSD1")
              .when(pk % 7 == 3, "CMX2").when(pk % 7 == 4, "CA1").when(pk % 7 == 5, "ICMX")
              .otherwise("SP-PO"))
    return li.select(
        F.concat(_s(ok), F.lit("-"), _s(ln)).alias("property_id"),
        (F.col("l_quantity") * 1000).alias("sale_price"),
        F.date_add(F.to_date("l_shipdate"), SALE_DAY_SHIFT).alias("sale_date"),
        _s(ln).alias("category_code"),
        desc.alias("category_code_description"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice") / 100).alias("total_livable_area"),
        (F.col("l_extendedprice") / 50).alias("total_area"),
        ln.cast("bigint").alias("number_of_bedrooms"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double"))
        .otherwise((sk % 4 + 1).cast("double")).alias("number_of_bathrooms"),
        (ln % 3 + 1).cast("bigint").alias("number_stories"),
        F.when(pk % 11 == 0, F.lit(None).cast("bigint"))
        .otherwise((pk % 3).cast("bigint")).alias("garage_spaces"),
        F.when(pk % 17 == 0, F.lit(None).cast("bigint"))
        .otherwise((pk % 240 + 1790).cast("bigint")).alias("year_built"),
        _s(sk % 60 + 19100).alias("zip_code"),
        _s(sk % 8).alias("interior_condition"),
        F.when(pk % 13 == 0, F.lit("n/a")).otherwise(_s(pk % 7)).alias("exterior_condition"),
        F.concat(F.lit("ROW "), F.col("l_linestatus")).alias("building_code_description"),
        _s(sk % 10).alias("geographic_ward"),
        F.col("l_returnflag").alias("quality_grade"),
        F.when(ok % 19 == 0, F.lit(None).cast("string")).otherwise(_s(ok % 3)).alias("fireplaces"),
        zoning.alias("zoning"),
        F.col("l_extendedprice").alias("market_value"))


def fx_prop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small property list from parts."""
    p = table(spark, sf_dir, "part")
    return p.select(_s(F.col("p_partkey")).alias("property_id"),
                    F.col("p_name").alias("location"), F.col("p_brand").alias("zoning"),
                    _s(F.col("p_size") % 16).alias("category_code"),
                    (F.col("p_size") + 1950).cast("bigint").alias("year_built"),
                    F.col("p_size").cast("double").alias("total_livable_area"),
                    F.col("p_retailprice").alias("market_value"))


def fx_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Core properties from customers (address = customer name)."""
    c = table(spark, sf_dir, "customer")
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    return c.select(
        _s(k).alias("property_id"), F.col("c_name").alias("location"),
        F.col("c_mktsegment").alias("owner_1"), bal.alias("market_value"),
        (bal * 0.3).alias("taxable_land"), (bal * 0.6).alias("taxable_building"),
        F.lit(0.0).alias("exempt_land"), (bal * 0.1).alias("exempt_building"),
        (k % 120 + 1900).cast("bigint").alias("year_built"),
        (F.col("c_nationkey") % 5 + 1).cast("bigint").alias("number_of_bedrooms"),
        (k % 3 + 1).cast("double").alias("number_of_bathrooms"),
        (k % 2500 + 500).cast("double").alias("total_livable_area"),
        _s(F.col("c_nationkey")).alias("category_code"),
        _s(k % 40 + 19090).alias("zip_code"))


def _fmt6(micro: Column) -> Column:
    """Text of ``micro / 1e6`` with exactly six decimals (same text as
    printf '%.6f' of the degree value), from integer arithmetic only."""
    a = F.abs(micro)
    return F.concat(F.when(micro < 0, F.lit("-")).otherwise(F.lit("")),
                    (a / 1000000).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((a % 1000000).cast("string"), 6, "0"))


def _ring(lon: Column, lat: Column, corners: list[tuple]) -> Column:
    """GeoJSON ring text of corners given as micro-degrees from (lon, lat).

    One small lambda over the corner offsets keeps the expression (and
    its generated code) the same size whatever the number of corners."""
    offs = F.array(*[F.struct(F.lit(dx).cast("bigint").alias("dx"), F.lit(dy).cast("bigint").alias("dy")) for dx, dy in corners])
    pts = F.transform(offs, lambda c: F.concat(
        F.lit("["), _fmt6(lon + c["dx"]), F.lit(","), _fmt6(lat + c["dy"]), F.lit("]")))
    return F.concat(F.lit("["), F.array_join(pts, ","), F.lit("]"))


def _square(lon: Column, lat: Column, closed: bool = True) -> Column:
    """A 0.001-degree square."""
    corners = [(0, 0), (1000, 0), (1000, 1000), (0, 1000)] + ([(0, 0)] if closed else [])
    return F.concat(F.lit("["), _ring(lon, lat, corners), F.lit("]"))


def fx_parcels(spark: SparkSession, sf_dir: str, even: bool = False) -> DataFrame:
    """Parcels with GeoJSON squares from customers: none for key % 10 = 0,
    a MultiPolygon for key % 7 = 0, an open (invalid) ring for key % 13 = 0.
    ``even``: dealt over all tasks, for queries that work on the geometry."""
    c = table(spark, sf_dir, "customer")
    c = spread(c) if even else c
    k = F.col("c_custkey")
    # corners in micro-degrees: lon -75.28 + 0.003 * (key % 100),
    # lat 39.87 + 0.002 * (key div 100 % 100)
    lon = F.lit(-75280000) + (k % 100) * F.lit(3000)
    lat = F.lit(39870000) + (F.expr("c_custkey div 100") % 100) * F.lit(2000)
    poly = F.concat(F.lit('{"type":"Polygon","coordinates":'), _square(lon, lat), F.lit("}"))
    multi = F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), _square(lon, lat),
                     F.lit(","), _square(lon + F.lit(1500), lat), F.lit("]}"))
    open_ring = F.concat(F.lit('{"type":"Polygon","coordinates":'),
                         _square(lon, lat, closed=False), F.lit("}"))
    geom = (F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 7 == 0, multi)
            .when(k % 13 == 0, open_ring).otherwise(poly))
    return c.select(_s(k).alias("property_id"), _s(k).alias("brt_id"),
                    F.col("c_name").alias("address"), geom.alias("geometry"))


# Corners, in units of some micro-degrees, of the shapes below.
SHELL = [(6, 0), (3, 5), (-3, 5), (-6, 0), (-3, -5), (3, -5)]
HOLE = [(2, 0), (-1, 2), (-1, -2)]
SECOND_PART = [(8, -3), (13, -3), (13, 3), (8, 3)]


def fx_shapes(spark: SparkSession, sf_dir: str, unit: int = 100) -> DataFrame:
    """Parcels of all kinds of shapes from customers: a hexagon, for two keys in three with a triangle for a
    hole, for two in five with a square for a second part.  Every corner is moved by digits of a number
    made of key and balance, so that some rings cross themselves, some holes leave their shell, and some parts meet.
    ``unit`` is their scale in micro-degrees.  Dealt over all tasks."""
    c = spread(table(spark, sf_dir, "customer"))
    k = F.col("c_custkey")
    number = F.expr("(c_custkey * 48271 + CAST(round(abs(c_acctbal) * 100) AS BIGINT) * 69621) % 2147483647")
    far = F.when(k % 4 == 0, 3).otherwise(1)

    def digit(i: int) -> Column:
        return F.expr(f"CAST(m DIV {5 ** (i % 13)} AS BIGINT) % 5 - 2")

    def ring(template: list, first: int, scale) -> Column:
        corners = [((F.lit(x) + digit(first + i) * scale) * unit, (F.lit(y) + digit(first + i + 5) * scale) * unit)
                   for i, (x, y) in enumerate(template)]
        return _ring(F.col("lon"), F.col("lat"), [*corners, corners[0]])

    one = F.concat(F.lit("["), ring(SHELL, 0, far), F.when(k % 3 != 0, F.concat(F.lit(","), ring(HOLE, 2, F.lit(1))))
                   .otherwise(F.lit("")), F.lit("]"))
    two = F.concat(F.lit("["), ring(SECOND_PART, 7, F.lit(1)), F.lit("]"))
    shape = (F.when(k % 5 < 2, F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), one, F.lit(","), two, F.lit("]}")))
             .otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), one, F.lit("}"))))
    placed = c.select("c_custkey", "c_name", number.alias("m"), (F.lit(-75280000) + (k % 100) * F.lit(3000)).alias("lon"),
                      (F.lit(39870000) + (F.expr("c_custkey div 100") % 100) * F.lit(2000)).alias("lat"))
    return placed.select(_s(k).alias("brt_id"), F.col("c_name").alias("address"), shape.alias("geometry"))


def fx_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parcel export with all of its listed columns, from customers."""
    p = fx_parcels(spark, sf_dir).drop("property_id").withColumnRenamed("geometry", "g")
    k = F.col("brt_id").cast("bigint")
    return p.select(
        _s(k + 100).alias("objectid"), _s(k * 3).alias("parcelid"), F.lpad(F.col("brt_id"), 10, "0").alias("tencode"), "address",
        F.concat(F.lit('O, "'), F.col("address"), F.lit('"')).alias("owner1"), F.when(k % 3 == 0, F.lit("JOINT")).alias("owner2"),
        _s(k % 5).alias("bldg_code"), F.concat(F.lit("CLASS "), _s(k % 5)).alias("bldg_desc"), "brt_id", F.lit("1").alias("num_brt"),
        _s(k % 2 + 1).alias("num_accounts"), _s(k * 10).alias("gross_area"), _s(k + 1000000).alias("pin"),
        _s(k * 7).alias("parcel_id"), F.col("g").alias("geometry"))


def fx_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with a prediction beside the price."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("property_id"),
        (F.col("l_quantity") * 1000).alias("sale_price"), _s(F.col("l_suppkey") % 60 + 19100).alias("zip_code"),
        (F.col("l_quantity") * 1000 * (F.lit(1.0) + F.col("l_discount") - F.col("l_tax"))).alias("predicted_value"))
