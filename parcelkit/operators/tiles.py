"""Map tiles: exact cover, statistics, byte budget and the tile tree.

A tile is taken when an edge of the feature passes through it or its middle
lies inside.  The tiles are found from above, beginning at the
deepest one that holds the whole feature: a tile's four children are tested
only if the tile itself was taken, and only against the edges that still
matter there, so the work follows a feature's outline and no array holds the tiles of its box
(but for a feature that is small at the last zoom, whose few tiles are tested at once).
Longitudes and latitudes are projected first; edges are straight in the projection, as a map draws them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelkit.functions.geo import MERCATOR_LIMIT
from parcelkit.session import stored

# Zoom range and per-tile size cap in bytes.
MIN_ZOOM, MAX_ZOOM = 12, 18
TILE_BYTE_CAP = 2000000

TILE = ["z", "x", "y"]
STEP = 4        # zooms that one explode goes down: at most 340 tiles in an array
FEW = 64        # a feature whose box has as many tiles at the last zoom is not worth a descent
BANDS = 16      # size bands of the priority, for each doubling of a feature's box

_PI = "3.141592653589793D"
_LAST = "0.9999999999999999D"   # the projection's far borders belong to the last column and row


def _x(lon: str) -> str:
    return f"least(greatest(({lon} + 180D) / 360D, 0D), {_LAST})"


def _y(lat: str) -> str:
    rad = f"radians(least(greatest({lat}, {-MERCATOR_LIMIT!r}D), {MERCATOR_LIMIT!r}D))"
    return f"least(greatest((1D - ln(tan({rad}) + 1D / cos({rad})) / {_PI}) / 2D, 0D), {_LAST})"


def _edges(polys: str) -> str:
    """Edges of all rings in the unit square, as one array."""
    ring = (f"element_at(transform(array(transform(ring, c -> struct({_x('c[0]')} AS x, {_y('c[1]')} AS y))), pts -> "
            "transform(sequence(1, size(pts) - 1), k -> struct(pts[k - 1].x AS x1, pts[k - 1].y AS y1, pts[k].x AS x2, "
            "pts[k].y AS y2))), 1)")
    return f"flatten(flatten(transform(`{polys}`, p -> transform(p, ring -> {ring}))))"


def _node(z: str, x: str, y: str, near: str, odd: str, done: str = "false") -> str:
    return f"struct({z} AS z, {x} AS x, {y} AS y, {near} AS near, {odd} AS odd, {done} AS done)"


_NONE = "filter({0}, e -> false)"


def _frame(x: str, y: str, h: str) -> str:
    return (f"struct({x} AS x, {y} AS y, {x} * {h} AS x0, ({x} + 1) * {h} AS x1, {y} * {h} AS y0, ({y} + 1) * {h} AS y1, "
            f"({x} * {h} + ({x} + 1) * {h}) / 2 AS mx, ({y} * {h} + ({y} + 1) * {h}) / 2 AS my)")


def _quarters(node: str, h: str) -> str:
    """Frames of a tile's four children, of height ``h``."""
    at = f"transform(sequence(0, 3), c -> struct({node}.x * 2 + c % 2 AS x, {node}.y * 2 + c DIV 2 AS y, {h} AS h))"
    return f"transform({at}, q -> {_frame('q.x', 'q.y', 'q.h')})"


def _touches(t: str, near: str, odd: str) -> str:
    """Whether an edge passes through a tile, or its middle has an odd number of edges to its left."""
    mx, my = f"{t}.mx", f"{t}.my"
    turn = f"(e.x2 - e.x1) * ({my} - e.y1) - (e.y2 - e.y1) * ({mx} - e.x1)"
    # The line has corners on both sides if its distance from the middle is within the tile's half, put as turns.
    passes = (f"exists({near}, e -> least(e.x1, e.x2) < {t}.x1 AND greatest(e.x1, e.x2) >= {t}.x0 AND least(e.y1, e.y2) < {t}.y1 "
              f"AND greatest(e.y1, e.y2) >= {t}.y0 AND abs({turn}) <= (abs(e.x2 - e.x1) + abs(e.y2 - e.y1)) * ({t}.x1 - {t}.x0) / 2)")
    left = f"size(filter({near}, e -> (e.y1 > {my}) <> (e.y2 > {my}) AND ({turn} < 0) = (e.y2 > e.y1))) % 2 = 1"
    return f"({passes} OR {odd} <> ({left}))"


def _start(min_zoom: int, max_zoom: int) -> str:
    """A feature's first nodes.  If its box has ``FEW`` tiles at most at the last zoom: its tiles, each tested by
    itself.  Else the deepest tile that holds all of the edges ``near``, and the tiles above it, as done."""
    box = ", ".join(f"array_{f}(transform(near, e -> {g}(e.{c}1, e.{c}2))) AS {c}{n}"
                    for c in "xy" for n, f, g in ((0, "min", "least"), (1, "max", "greatest")))
    at = {k: f"floor(b.{k} * pow(2D, z))" for k in ("x0", "x1", "y0", "y1")}
    zoom = f"element_at(filter(sequence({max_zoom}, 0, -1), z -> {at['x0']} = {at['x1']} AND {at['y0']} = {at['y1']}), 1)"
    first = (f"transform(array({zoom}), v -> transform(sequence(least({min_zoom}, v), v), z -> "
             + _node("z", at["x0"], at["y0"], f"IF(z = v, near, {_NONE.format('near')})", "false", "z < v") + "))[0]")
    frames = (f"flatten(transform(sequence({at['x0']}, {at['x1']}), x -> transform(sequence({at['y0']}, {at['y1']}), y -> "
              f"{_frame('x', 'y', 'pow(2D, -z)')})))")
    tested = f"filter({frames}, t -> {_touches('t', 'near', 'false')})"
    each = (f"flatten(transform(sequence({min_zoom}, {max_zoom}), z -> transform({tested}, t -> "
            + _node("z", "t.x", "t.y", _NONE.format("near"), "false", "true") + ")))")
    side = "(floor(b.{0}1 * {1}D) - floor(b.{0}0 * {1}D) + 1)"
    few = f"{side.format('x', 2.0 ** max_zoom)} * {side.format('y', 2.0 ** max_zoom)} <= {FEW}"
    return f"transform(array(struct({box})), b -> IF({few}, {each}, {first}))[0]"


def _children(node: str) -> str:
    """Those of a tile's four children that the feature touches.

    ``near`` are the edges that meet a tile's rows and do not lie right of it; an edge to the left that
    spans all its rows only counts (``odd``)."""
    left = "greatest(e.x1, e.x2) < t.x0 AND least(e.y1, e.y2) < t.y0 AND greatest(e.y1, e.y2) >= t.y1"
    near = (f"filter({node}.near, e -> least(e.y1, e.y2) < t.y1 AND greatest(e.y1, e.y2) >= t.y0 AND least(e.x1, e.x2) < t.x1 "
            f"AND NOT ({left}))")
    odd = f"{node}.odd <> (size(filter({node}.near, e -> {left})) % 2 = 1)"
    frames = _quarters(node, f"pow(2D, -1 - {node}.z)")
    tiles = f"transform({frames}, t -> struct(t AS t, {near} AS near, {odd} AS odd))"
    taken = f"filter({tiles}, k -> {_touches('k.t', 'k.near', 'k.odd')})"
    return f"transform({taken}, k -> {_node(f'{node}.z + 1', 'k.t.x', 'k.t.y', 'k.near', 'k.odd')})"


def _leaves(node: str, zoom: int) -> str:
    """``_children`` at the last zoom.  None is taken further, so each is tested against the tile's own edges as
    they are: those that do not matter there neither pass through it nor change the count to its left."""
    taken = f"filter({_quarters(node, f'{2.0 ** -zoom!r}D')}, t -> {_touches('t', f'{node}.near', f'{node}.odd')})"
    return f"transform({taken}, t -> {_node(str(zoom), 't.x', 't.y', _NONE.format(f'{node}.near'), 'false', 'true')})"


def _descend(to: int, min_zoom: int, max_zoom: int) -> str:
    """``node`` taken down to zoom ``to``; its tiles on the way from ``min_zoom`` on stay, marked as done."""
    done = _node("n.z", "n.x", "n.y", _NONE.format("n.near"), "false", "true")

    def level(children: str) -> str:
        grown = f"concat(filter(array({done}), d -> d.z >= {min_zoom}), {children})"
        return f"flatten(transform(open, n -> IF(n.done, array(n), {grown})))"
    last = to - (to == max_zoom)
    zooms = f"filter(sequence(node.z, greatest(node.z, {last - 1})), z -> z < {last})"
    below = f"aggregate({zooms}, array(node), (open, z) -> {level(_children('n'))})"
    if to == max_zoom:
        below = f"transform(array({below}), open -> {level(_leaves('n', to))})[0]"
    return f"IF(node.z < {to} AND NOT node.done, {below}, array(node))"


def tile_assign(df: DataFrame, key: str = "property_id", polys: str = "polygons",
                min_zoom: int = MIN_ZOOM, max_zoom: int = MAX_ZOOM,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """Every (z, x, y) tile that a feature touches, once per feature row; rows with the same key stay apart.

    One ``explode`` for each ``STEP`` zooms, of the tiles below one tile, within the row's task; nothing is
    shuffled.  ``carry`` keeps extra columns on every tile row.  NULL polygons give no rows."""
    # No filter on the polygons: a pushed-down ``IS NOT NULL`` would repeat the parse.
    edges = df.select(key, *carry, F.expr(_edges(polys)).alias("near"))
    start = F.expr(f"IF(size(near) > 0, {_start(min_zoom, max_zoom)}, NULL)")
    nodes = edges.select(key, *carry, F.explode(start).alias("node"))
    for to in [*range(min_zoom, 0, -STEP)][::-1] + [*range(min_zoom + STEP, max_zoom, STEP), max_zoom]:
        nodes = nodes.select(key, *carry, F.explode(F.expr(_descend(to, min_zoom, max_zoom))).alias("node"))
    return nodes.where(F.col("node.z") >= min_zoom).select(key, "node.z", "node.x", "node.y", *carry)


def tile_stats(features: DataFrame, polys: str = "polygons", feature_text: str = "feature",
               key: str = "property_id", cap: int = TILE_BYTE_CAP,
               min_zoom: int = MIN_ZOOM, max_zoom: int = MAX_ZOOM) -> DataFrame:
    """Features and bytes of feature text per tile, with an over-cap flag.

    The byte size of each feature is computed before the explode and
    carried on the tile rows; one partially aggregated group-by on
    (z, x, y) follows, so a dense tile is summed map-side first."""
    sized = features.select(key, polys, F.octet_length(F.col(feature_text)).cast("bigint")
                            .alias("_bytes"))
    tiles = tile_assign(sized, key, polys, min_zoom, max_zoom, carry=("_bytes",))
    return (tiles.groupBy(*TILE)
            .agg(F.count(F.lit(1)).alias("feature_count"), F.sum("_bytes").alias("tile_bytes"))
            .withColumn("over_cap", F.col("tile_bytes") > cap))


def with_priority(features: DataFrame, polys: str = "polygons", key: str = "property_id",
                  feature_text: str = "feature") -> DataFrame:
    """Adds what decides who stays in a full tile: ``_bytes`` of text, the size ``_band`` of the feature's box
    (``BANDS`` to a doubling of its area, larger ones stay first) and the ``_rank``, a fixed shuffle of the keys."""
    # No alias for the points: the text of the rings is small, and a filter on it would repeat the parse.
    def span(c: int) -> str:
        pts = f"transform(flatten(transform(`{polys}`, p -> p[0])), c -> c[{c}])"
        return f"(array_max({pts}) - array_min({pts}))"

    band = F.expr(f"CAST(floor({BANDS} * log2({span(0)} * {span(1)})) AS INT)")
    return features.withColumns({
        "_bytes": F.octet_length(F.col(feature_text)).cast("bigint"), "_band": band,
        "_rank": F.coalesce(F.md5(F.col(key).cast("string")), F.lit(""))})


def _upto(by: list[str], order: Column) -> Column:
    return F.sum("bytes").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def tile_cuts(tiles: DataFrame, cap: int = TILE_BYTE_CAP) -> DataFrame:
    """Where each tile over the cap is cut: one row (z, x, y, cut_band, cut_part, cut_rank) per such tile.

    Features stay in order of band (larger first), then rank, as long as their bytes add up to ``cap`` at
    most; those of one key stay or go together.  The order is narrowed by sums that are combined before the
    shuffle: bands of a tile, then the ranks' first three digits in the band that goes over, then single ranks in
    the part that goes over, so a window never holds more than that (a 4,096th of one band of one tile).
    ``tiles`` has z, x, y, _bytes, _band and _rank, and is read three times: give a written table."""
    total = F.sum(F.coalesce("_bytes", F.lit(0))).alias("bytes")
    over = tiles.groupBy(*TILE).agg(total).where(F.col("bytes") > cap).select(*TILE)
    heavy = tiles.join(over, TILE, "left_semi")
    part = F.substring("_rank", 1, 3)
    goes_over = (F.col("upto") > cap) & (F.col("upto") - F.col("bytes") <= cap)
    bands = heavy.groupBy(*TILE, "_band").agg(total).withColumn("upto", _upto(TILE, F.col("_band").desc()))
    band = bands.where(goes_over).select(*TILE, "_band", (F.col("upto") - F.col("bytes")).alias("held"))
    inside = heavy.join(band, [*TILE, "_band"]).withColumn("_part", part)
    parts = (inside.groupBy(*TILE, "_band", "held", "_part").agg(total)
             .withColumn("upto", F.col("held") + _upto(TILE, F.col("_part").asc())))
    cut = parts.where(goes_over).select(*TILE, "_band", "_part", (F.col("upto") - F.col("bytes")).alias("held"))
    ranks = (inside.drop("held").join(cut, [*TILE, "_band", "_part"]).groupBy(*TILE, "held", "_rank").agg(total)
             .withColumn("upto", F.col("held") + _upto(TILE, F.col("_rank").asc())))
    last = ranks.where(F.col("upto") <= cap).groupBy(*TILE).agg(F.max("_rank").alias("cut_rank"))
    return cut.join(last, TILE, "left").select(*TILE, F.col("_band").alias("cut_band"), F.col("_part").alias("cut_part"),
                                               "cut_rank")


def _stays() -> Column:
    """Whether a tile row stays, beside the cut of its tile (NULL: the tile is within the cap)."""
    part, at_band = F.substring("_rank", 1, 3), F.col("_band") == F.col("cut_band")
    at_part = (part == F.col("cut_part")) & F.coalesce(F.col("_rank") <= F.col("cut_rank"), F.lit(False))
    return (F.col("cut_band").isNull() | (F.col("_band") > F.col("cut_band"))
            | (at_band & ((part < F.col("cut_part")) | at_part)))


def capped(tiles: DataFrame, cuts: DataFrame) -> DataFrame:
    """The tile rows that stay within the cap."""
    return tiles.join(cuts, TILE, "left").where(_stays()).drop("cut_band", "cut_part", "cut_rank")


def tile_report(tiles: DataFrame, cuts: DataFrame) -> DataFrame:
    """z, x, y, feature_count, kept_count, dropped_count, tile_bytes, kept_bytes of every tile."""
    stays = _stays()
    return (tiles.join(cuts, TILE, "left").groupBy(*TILE)
            .agg(F.count(F.lit(1)).alias("feature_count"), F.count_if(stays).alias("kept_count"),
                 F.count_if(~stays).alias("dropped_count"), F.sum("_bytes").alias("tile_bytes"),
                 F.coalesce(F.sum(F.when(stays, F.col("_bytes"))), F.lit(0)).alias("kept_bytes")))


def tile_rows(features: DataFrame, polys: str = "polygons", key: str = "property_id", feature_text: str = "feature",
              min_zoom: int = MIN_ZOOM, max_zoom: int = MAX_ZOOM) -> DataFrame:
    """The tiles of every feature with a text, with bytes and priority but without the text, written once to the shared folder."""
    ready = with_priority(features.where(F.col(feature_text).isNotNull()), polys, key, feature_text)
    return stored(tile_assign(ready, key, polys, min_zoom, max_zoom, carry=("_bytes", "_band", "_rank")), "tile-rows")


def _object_writer(path: str):
    """A batch function that writes one gzip'd object for each tile row (z, x, y, lines) and tells about it."""
    def write(batches):
        import gzip
        import re

        import pyarrow as pa
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
        made = set()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                folder = f"{root}/{r['z']}/{r['x']}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                body = gzip.compress("".join(f"{line}\n" for line in r["lines"]).encode(), mtime=0)
                with store.open_output_stream(f"{folder}/{r['y']}.jsonl.gz", compression=None) as f:
                    f.write(body)
                rows.append((r["z"], r["x"], r["y"], f"{r['z']}/{r['x']}/{r['y']}.jsonl.gz", len(body)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["z", "x", "y", "object", "object_bytes"])
    return write


def write_tiles(features: DataFrame, path: str, polys: str = "polygons", key: str = "property_id",
                feature_text: str = "feature", layer: str = "property_tile_info", cap: int = TILE_BYTE_CAP,
                min_zoom: int = MIN_ZOOM, max_zoom: int = MAX_ZOOM) -> DataFrame:
    """Write the tile tree into a fresh folder: one gzip'd object z/x/y.jsonl.gz of feature rows (not binary
    vector tiles) for each tile, none with more than ``cap`` bytes of features.  Returns what each tile kept
    and dropped, with its object's name and size.

    The features' texts ride through a second assignment, past the small table of cuts; no join multiplies
    them.  A tile's rows meet in one task, which the cap keeps small; a task that is run again writes the same
    objects.  ``path`` is a folder that the executors' pyarrow reaches (an object store, or a shared mount)."""
    rows = tile_rows(features, polys, key, feature_text, min_zoom, max_zoom)
    cuts = stored(tile_cuts(rows, cap), "tile-cuts")
    ready = with_priority(features.where(F.col(feature_text).isNotNull()), polys, key, feature_text)
    kept = capped(tile_assign(ready, key, polys, min_zoom, max_zoom, carry=(feature_text, "_band", "_rank")), cuts)
    name = F.to_json(F.array(F.lit(layer)))
    value = F.concat(F.lit('{"layer":'), name.substr(F.lit(2), F.length(name) - 2), F.lit(',"y":'), F.col("y").cast("string"),
                     F.lit(',"feature":'), F.col(feature_text), F.lit("}"))
    whole = kept.select(*TILE, value.alias("value")).groupBy(*TILE).agg(F.sort_array(F.collect_list("value")).alias("lines"))
    objects = stored(whole.mapInArrow(_object_writer(path), "z int, x long, y long, object string, object_bytes long"),
                     "tile-objects")
    return tile_report(rows, cuts).join(objects, TILE, "left")


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows of a tile tree: z, x, y from the object's name, and value."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    at = F.regexp_extract_all(F.col("_metadata.file_path"), F.lit("/(\\d+)/(\\d+)/(\\d+)[.]jsonl"), F.lit(0))
    part = F.split(F.regexp_extract(F.element_at(at, -1), "/(.*)[.]jsonl", 1), "/")
    return lines.select(*[part[i].cast(t).alias(c) for i, (c, t) in enumerate((("z", "int"), ("x", "long"), ("y", "long")))],
                        "value")
