"""Zones against plain ray casting over all their edges."""
import math
import random

from pyspark.sql import functions as F

from metroscope.operators import geo

SCHEMA = "zone_id string, rings array<struct<xs array<double>, ys array<double>>>"


def ring(rng, n, cx, cy, r, wobble=0.6):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    far = [r * (1 - wobble * rng.random()) for _ in turns]
    return [cx + f * math.cos(t) for t, f in zip(turns, far)], [cy + f * math.sin(t) for t, f in zip(turns, far)]


def plain(zones, x, y):
    if x is None or y is None or math.isnan(x) or math.isnan(y):
        return None
    hit = []
    for name, rings in zones:
        inside = False
        for xs, ys in rings or []:
            for i in range(len(xs)):
                xi, yi, xj, yj = xs[i], ys[i], xs[i - 1], ys[i - 1]
                if (yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi:
                    inside = not inside
        if inside:
            hit.append(name)
    return min(hit, default=None)


def test_cover_gives_what_ray_casting_gives(spark):
    rng = random.Random(4)
    zones = [("country", [ring(rng, 3000, 10, 45, 8, 0.2), ring(rng, 200, 11, 44, 2)]), ("far", [ring(rng, 5, 500_000, 4_000_000, 90_000)]),
             ("parts", [ring(rng, 40, 3, 50, 1), ring(rng, 40, 6, 50, 1)]), ("none", []), ("null", None), ("empty", [([], [])]),
             ("line", [([1.0, 2.0], [1.0, 2.0])]), ("point", [([4.0], [4.0])]), ("star", [ring(rng, 400, 10.001, 45.001, 0.01, 1.0)])]
    zones += [(f"block{i:03d}", [ring(rng, rng.randint(3, 30), rng.uniform(3, 17), rng.uniform(38, 52), 10 ** rng.uniform(-4, 0))]) for i in range(120)]
    points = [(rng.uniform(1, 19), rng.uniform(36, 54)) for _ in range(1500)]
    points += [(xs[0] + rng.uniform(-1, 1) * 1e-3, ys[0] + rng.uniform(-1, 1) * 1e-3) for _, rings in zones[9:] for xs, ys in rings]
    points += [(10 + rng.uniform(-.02, .02), 45 + rng.uniform(-.02, .02)) for _ in range(300)]
    points += [(500_000 + rng.uniform(-1e5, 1e5), 4_000_000 + rng.uniform(-1e5, 1e5)) for _ in range(50)]
    points += [(None, 45.0), (10.0, None), (float("nan"), 45.0), (float("inf"), 45.0), (-1e300, 1e300)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, lon double, lat double").withColumn("zone_id", F.lit("old"))
    table = spark.createDataFrame([(n, None if r is None else [(xs, ys) for xs, ys in r]) for n, r in zones], SCHEMA)
    want = {i: plain(zones, x, y) for i, (x, y) in enumerate(points) if x is None or y is None or abs(x) < 1e299 and abs(y) < 1e299}
    for most in (10**9, -1):
        out = geo.assign_zones(df, table, max_broadcast_edges=most)
        assert out.columns == df.columns
        got = {r.id: r.zone_id for r in out.collect()}
        assert len(got) == len(points) and all(got[i] == w for i, w in want.items())
    assert len(set(want.values())) > 40


def test_no_cell_repeats_a_polygon(spark):
    rng = random.Random(1)
    table = spark.createDataFrame([("big", [ring(rng, 5000, 0, 0, 10, 0.1)])], SCHEMA)
    cover = geo.zone_cover(table).collect()
    assert max(len(r.edges) for r in cover) <= geo.LEAF_EDGES
    assert sum(len(r.edges) for r in cover) < 8 * 5000 < len(cover) * 50  # a spike stands in the few cells it touches
    assert any(not r.edges and r.corner for r in cover)          # inside cells need no edges
    assert len({r.level for r in cover}) > 2


def test_without_zones(spark):
    points = spark.createDataFrame([(1, 0.5, 0.5)], "id int, lon double, lat double")
    assert geo.assign_zones(points, spark.createDataFrame([], SCHEMA)).first().zone_id is None
    assert geo.assign_zones(points.limit(0), spark.createDataFrame([("a", [([0.0, 1.0, 1.0], [0.0, 0.0, 1.0])])], SCHEMA)).count() == 0


def test_zones_after_the_first_hit_are_not_searched(spark):
    square = lambda d: [([-d, d, d, -d], [-d, -d, d, d])]
    table = spark.createDataFrame([(f"z{i:02d}", square(1 + i * 0.01)) for i in range(30)] + [(None, square(9.0)), ("a", square(0.1))], SCHEMA)
    points = spark.createDataFrame([(1, 0.05, 0.05), (2, 0.9, 0.9), (3, 1.105, 0.0), (4, 8.0, 0.0), (5, 20.0, 0.0)], "id int, lon double, lat double")
    out = geo.assign_zones(points, table)
    assert {r.id: r.zone_id for r in out.collect()} == {1: "a", 2: "z00", 3: "z11", 4: None, 5: None}
    assert "array_min(transform(filter(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_zones_over_each_other_leave_few_in_a_cell(spark):
    """Equal zones are one; of others only those that can be first in a cell stay."""
    rng = random.Random(8)
    zones = [(f"z{i:03d}", [ring(rng, rng.randint(5, 12), rng.uniform(-.5, .5), rng.uniform(-.5, .5), 4, 0.1)]) for i in range(150)]
    copy = [ring(rng, 30, 20, 0, 2, 0.3)]
    zones += [(f"c{i:03d}", copy) for i in range(100)] + [("a", [ring(rng, 30, 20, 0, 1, 0.3)]), (None, [ring(rng, 9, 20, 0, 9)])]
    rng.shuffle(zones)
    points = [(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(600)] + [(rng.uniform(17, 23), rng.uniform(-3, 3)) for _ in range(300)]
    table = spark.createDataFrame(zones, SCHEMA)
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    named = [z for z in zones if z[0] is not None]
    for most in (10**9, -1):
        got = {r.id: r.zone_id for r in geo.assign_zones(df, table, max_broadcast_edges=most).collect()}
        assert got == {i: plain(named, x, y) for i, (x, y) in enumerate(points)}
    cover = geo.zone_cover(table).groupBy("level", "cx", "cy").agg(F.count(F.lit(1)).alias("zones"), F.collect_set("zone_id").alias("ids")).collect()
    assert not any(i > "c000" and i < "d" for r in cover for i in r.ids)
    inner = sorted(r.zones for r in cover if any(i.startswith("z") for i in r.ids))
    assert inner[len(inner) // 2] <= 10
