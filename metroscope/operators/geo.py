"""Point-in-zone assignment (D-6) without a geometry type.

A zone is one or more closed rings of vertices (holes and parts by the even-odd rule). Zones are
covered by cells of a quadtree: starting from the up to 25 cells between a quarter of the zone's
own size and that size, a cell is split into 16 while more than ``LEAF_EDGES`` of the zone's edges run through it. A cell
without edges lies inside the zone (or is dropped); any other keeps just the edges that touch it
and whether its lower right corner lies inside. So a country and a city block are covered by
cells of their own sizes, and no cell repeats a whole polygon.

Where zones overlap, a cell keeps only those that can be first by id: none after a zone that
holds the whole cell. A cell that still has more than ``CELL_EDGES`` edges of its zones in all
is split once more, so that more of its parts lie inside some zone: however many zones lie over
each other, few are left in a cell. Equal zones are one, the first of them.

Points look up their cell on each level that occurs - a broadcast hash join when the cover is
within a checked size, a shuffle join otherwise. Inside cells are a hit at once; in the others
the number of edges on the way from the point to the cell's right side and down to its corner
decides. One output row per point; of several zones the smallest id counts; points outside
every zone, without coordinates or with a coordinate that is no number get null.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroscope.session import scratch_path

# Broadcast the cover only while it holds this many edges and cells in all (32 bytes each): 64 MB.
MAX_BROADCAST_EDGES = 2_000_000
LEAF_EDGES = 16     # edges of a cell that is not split further
CELL_EDGES = 64     # edges of all zones of a cell that is not split for them
MAX_SPLITS = 12     # splits of a cell, for corners where many edges meet
STEP = 2            # quadtree levels of one split
# The grid: cell size at level 0, and an origin off all round numbers, so that vertices and
# points do not fall on cell borders.
SIZE, ORIGIN_X, ORIGIN_Y = 1024.0, -512.013719331, -512.029311778


def edges_of(rings: Column) -> Column:
    """All edges (vertex i to vertex i - 1 of its ring) as structs x1, y1, x2, y2."""
    def edge(ring: Column, i: Column) -> Column:
        n = F.size(ring["xs"])
        j = (i + n - 1) % n
        return F.struct(F.get(ring["xs"], i).alias("x1"), F.get(ring["ys"], i).alias("y1"),
                        F.get(ring["xs"], j).alias("x2"), F.get(ring["ys"], j).alias("y2"))

    some = F.filter(rings, lambda r: F.size(r["xs"]) > 0)
    return F.flatten(F.transform(some, lambda r: F.transform(F.sequence(F.lit(0), F.size(r["xs"]) - 1), lambda i: edge(r, i))))


def _parity(edges: Column, start: Column, crosses) -> Column:
    return F.aggregate(edges, start, lambda inside, e: inside != F.coalesce(crosses(e), F.lit(False)))


def _crosses_right(e: Column, x: Column, y: Column, until: Column | None = None) -> Column:
    """The edge crosses the ray to the right of (x, y), not beyond ``until``."""
    at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    hit = x < at if until is None else (x < at) & (at <= until)
    return F.when((e["y1"] > y) != (e["y2"] > y), hit).otherwise(F.lit(False))


def contains(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd ray casting over all edges of a zone."""
    return _parity(edges, F.lit(False), lambda e: _crosses_right(e, x, y))


def cell_contains(x: Column, y: Column, edges: Column, corner: Column, right: Column, bottom: Column) -> Column:
    """The same inside a cell, from the edges that touch it and whether its corner (right,
    bottom) lies inside: edges between the point and the right side, and between there and the corner."""
    def crosses(e: Column) -> Column:
        at = (e["y2"] - e["y1"]) * (right - e["x1"]) / (e["x2"] - e["x1"]) + e["y1"]
        down = F.when((e["x1"] > right) != (e["x2"] > right), (bottom < at) & (at <= y)).otherwise(F.lit(False))
        return _crosses_right(e, x, y, right) != down

    return _parity(edges, corner, crosses)


def _touches(e: Column, left: Column, right: Column, bottom: Column, top: Column) -> Column:
    apart = ((F.greatest(e["x1"], e["x2"]) < left) | (F.least(e["x1"], e["x2"]) > right)
             | (F.greatest(e["y1"], e["y2"]) < bottom) | (F.least(e["y1"], e["y2"]) > top))
    sides = [(e["x2"] - e["x1"]) * (cy - e["y1"]) - (e["y2"] - e["y1"]) * (cx - e["x1"]) for cx in (left, right) for cy in (bottom, top)]
    return ~apart & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def _size(level: Column) -> Column:
    return F.lit(SIZE) / F.pow(F.lit(2.0), level)


def _box(level: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column, Column]:
    """left, right, bottom, top of a cell."""
    s = _size(level)
    return ORIGIN_X + cx * s, ORIGIN_X + (cx + 1) * s, ORIGIN_Y + cy * s, ORIGIN_Y + (cy + 1) * s


def _cell(v: Column, origin: float, level: Column) -> Column:
    return F.floor((v - F.lit(origin)) / _size(level)).cast("long")


def _span(lo: Column, hi: Column) -> Column:
    return F.explode(F.sequence(lo, hi))


def _cut(cells: DataFrame, corner, *kept: str) -> DataFrame:
    """``zone_id``, ``level``, ``cx``, ``cy`` and the ``whole`` edges around it -> its own ``edges``
    and ``corner``; cells that lie outside the zone go."""
    left, right, bottom, top = _box(F.col("level"), F.col("cx"), F.col("cy"))
    boxed = cells.withColumns({"left": left, "right": right, "bottom": bottom, "top": top})
    own = F.filter("whole", lambda e: _touches(e, F.col("left"), F.col("right"), F.col("bottom"), F.col("top")))
    cut = boxed.select("zone_id", "level", "cx", "cy", own.alias("edges"), corner().alias("corner"), *kept)
    return cut.filter((F.size("edges") > 0) | F.col("corner"))


def _sized(cells: DataFrame) -> tuple[int, list[int]]:
    """Edges and cells in all, levels that occur (a few dozen at most)."""
    total, levels = cells.agg(F.sum(F.size("edges") + F.lit(1)), F.collect_set("level")).first()
    return total or 0, sorted(levels)


def _first_zones(cells: DataFrame) -> DataFrame:
    """Without the zones that come after one that holds the whole cell; ``crowd``: edges left in a cell."""
    cell = Window.partitionBy("level", "cx", "cy")
    held = cells.withColumn("held", F.min(F.when(F.size("edges") == 0, F.col("zone_id"))).over(cell))
    return held.filter(F.col("held").isNull() | (F.col("zone_id") <= F.col("held"))).drop("held").withColumn(
        "crowd", F.sum(F.size("edges")).over(cell))


def zone_cover(zones: DataFrame) -> DataFrame:
    """The cells that cover each zone (``sized_cover`` without the sizes)."""
    return sized_cover(zones)[0]


def sized_cover(zones: DataFrame) -> tuple[DataFrame, int, list[int]]:
    """``zone_id``, ``level``, ``cx``, ``cy``, ``edges``, ``corner``: the cells that cover each zone,
    as far as it can be the first of a cell; their number with their edges, and their levels.

    Zones have a ``rings`` column (array of structs ``xs``, ``ys``), or ``xs`` and ``ys`` of one
    ring. Every round of splits is written below the shared folder and read by the next."""
    spark = zones.sparkSession
    rings = F.col("rings") if "rings" in zones.columns else F.array(F.struct("xs", "ys"))
    whole = zones.filter(F.col("zone_id").isNotNull()).select("zone_id", edges_of(rings).alias("whole")).filter(F.size("whole") > 0)
    whole = whole.groupBy("whole").agg(F.min("zone_id").alias("zone_id"))  # deals the zones out, too
    low = lambda c: F.array_min(F.transform("whole", lambda e: e[c]))
    high = lambda c: F.array_max(F.transform("whole", lambda e: e[c]))
    bounds = whole.select("*", low("x1").alias("x0"), high("x1").alias("xn"), low("y1").alias("y0"), high("y1").alias("yn"))
    extent = F.greatest(F.col("xn") - F.col("x0"), F.col("yn") - F.col("y0"), F.lit(1e-9))
    level = (F.floor(F.log2(F.lit(SIZE) / extent) / STEP) * STEP + STEP).cast("int")
    first = bounds.withColumn("level", level)
    lv = F.col("level")
    first = first.select("*", _span(_cell(F.col("x0"), ORIGIN_X, lv), _cell(F.col("xn"), ORIGIN_X, lv)).alias("cx")).select(
        "*", _span(_cell(F.col("y0"), ORIGIN_Y, lv), _cell(F.col("yn"), ORIGIN_Y, lv)).alias("cy"))
    frontier = _cut(first, lambda: contains(F.col("right"), F.col("bottom"), F.col("whole"))).withColumn("tight", F.lit(False))
    names = ["zone_id", "level", "cx", "cy", "edges", "corner"]
    pieces, used = [], scratch_path(spark, "zone-cover")
    for split in range(MAX_SPLITS + 1):
        path = f"{used}/{split}"
        frontier = _first_zones(frontier)
        frontier.write.parquet(path)
        now = spark.read.schema(frontier.schema).parquet(path)
        crowded = (F.col("crowd") > CELL_EDGES) & ~F.col("tight")
        fine = F.lit(True) if split == MAX_SPLITS else (F.size("edges") <= LEAF_EDGES) & ~crowded
        pieces.append(now.filter(fine).select(names))
        rest = now.filter(~fine)
        if split == MAX_SPLITS or rest.isEmpty():
            break
        _, p_right, p_bottom, _ = _box(F.col("level"), F.col("cx"), F.col("cy"))
        parts = rest.withColumns({"p_right": p_right, "p_bottom": p_bottom, "tight": F.col("tight") | crowded}).withColumnsRenamed(
            {"edges": "whole", "corner": "p_corner"})
        n = F.lit((1 << STEP) - 1)
        parts = parts.select("*", _span(F.lit(0), n).alias("i")).select("*", _span(F.lit(0), n).alias("j")).withColumns(
            {"level": F.col("level") + STEP, "cx": F.shiftleft("cx", STEP) + F.col("i"), "cy": F.shiftleft("cy", STEP) + F.col("j")})
        frontier = _cut(parts, lambda: cell_contains(F.col("right"), F.col("bottom"), F.col("whole"), F.col("p_corner"), F.col("p_right"), F.col("p_bottom")), "tight")
    cover = reduce(DataFrame.unionByName, pieces)
    return cover, *_sized(cover)


def assign_zones(points: DataFrame, zones: DataFrame, x: str = "lon", y: str = "lat",
                 max_broadcast_edges: int = MAX_BROADCAST_EDGES) -> DataFrame:
    """Adds ``zone_id`` (first containing zone by id, else null) to every point.

    The cover's size is counted (a small job over it) before it is broadcast; beyond the bound
    both sides shuffle on the cell, once per level of the cover (levels follow the zones' sizes,
    two powers of two apart, so a country beside city blocks makes a handful)."""
    cover, total, levels = sized_cover(zones)
    out, hits = points, []
    for i, level in enumerate(levels):
        names = {c: f"_{c}{i}" for c in ("cx", "cy", "zones")}
        cells = cover.filter(F.col("level") == level).groupBy("cx", "cy").agg(
            F.sort_array(F.collect_list(F.struct("zone_id", "corner", "edges"))).alias("zones")).withColumnsRenamed(names)
        if total <= max_broadcast_edges:
            cells = F.broadcast(cells)
        px, py = F.col(x), F.col(y)
        where = {names["cx"]: _cell(F.nullif(px, F.lit(float("nan"))), ORIGIN_X, F.lit(level)),
                 names["cy"]: _cell(F.nullif(py, F.lit(float("nan"))), ORIGIN_Y, F.lit(level))}
        out = out.withColumns(where).join(cells, [names["cx"], names["cy"]], "left")
        _, right, bottom, _ = _box(F.lit(level), F.col(names["cx"]), F.col(names["cy"]))
        inside = lambda z: F.when(F.size(z["edges"]) == 0, z["corner"]).otherwise(
            cell_contains(px, py, z["edges"], z["corner"], right, bottom))
        # by id: once a zone holds the point, no later one is looked at
        hits.append((f"_hit{i}", F.aggregate(F.col(names["zones"]), F.lit(None).cast(cover.schema["zone_id"].dataType),
                                             lambda first, z: F.when(first.isNotNull(), first).when(inside(z), z["zone_id"]))))
        out = out.withColumn(*hits[-1]).drop(*names.values())
    first = F.array_min(F.array(*[F.col(n) for n, _ in hits])) if hits else F.lit(None).cast("string")
    return out.select(*[F.col(f"`{c}`") for c in points.columns if c != "zone_id"], first.alias("zone_id"))
