import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewright.functions.geo import EARTH_M, Quads, haversine_m, wrap_course, wrap_lon
from tidewright.operators.correlate import best_match, best_scores, interval_correlate, link_clusters, proximity_pairs
from tidewright.operators.enrich import lookup, nearest_any, nearest_reference, zone_containment, zone_containment_wide
from tidewright.functions import skew
from tidewright.functions.skew import COLUMN, ROW, HotKeys, spread_crowds
from tidewright.schemas import ZONES


def metres(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    s = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1.0, math.sqrt(s)))


def scattered(seed, n):
    """Points in clumps near both poles, on the ±180° line and the equator."""
    rng = random.Random(seed)
    centres = [(89.9, 10), (-89.95, -170), (0, 179.99), (0, -179.99), (60, 179.9), (45, 5), (-0.01, 0), (90, 0), (-90, 33)]
    out = []
    for i in range(n):
        lat, lon = rng.choice(centres)
        lat = max(-90.0, min(90.0, lat + rng.gauss(0, 0.6)))
        out.append((i, lat, (lon + rng.gauss(0, 1.5) + 180) % 360 - 180, datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(7200))))
    return out


@pytest.mark.parametrize("radius, crowd", [(20_000.0, None), (150_000.0, 4), (2_500_000.0, 100_000), (2_500_000.0, 4)])
def test_proximity_and_nearest_against_brute_force(spark, radius, crowd):
    a, b = scattered(1, 150), scattered(2, 150)
    schema = "obs_id long, lat double, lon double, ts timestamp"
    da, db = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    want = sorted((x[0], y[0]) for x in a for y in b
                  if abs((x[3] - y[3]).total_seconds()) <= 900 and metres(x[1:3], y[1:3]) <= radius)
    got = proximity_pairs(da, db, 900, radius, crowd=crowd)
    assert sorted(tuple(r) for r in got.select("left_id", "right_id").collect()) == want and want
    near = sorted((x[0], r, y[0]) for x in a for r, y in enumerate(sorted(
        (y for y in b if metres(x[1:3], y[1:3]) <= radius), key=lambda y: (metres(x[1:3], y[1:3]), y[0]))[:3], 1))
    found = nearest_reference(da, db.select(F.col("obs_id").alias("ref_id"), "lat", "lon"), 3, radius)
    assert sorted((r.obs_id, r.rank, r.ref_id) for r in found.collect()) == near


def test_pairs_of_a_table_with_itself_come_once(spark):
    df = spark.createDataFrame(scattered(3, 80), "obs_id long, lat double, lon double, ts timestamp")
    got = proximity_pairs(df, df, 7200, 500_000.0, ordered=True)
    assert got.count() == got.distinct().count() and got.filter("left_id >= right_id").count() == 0
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_distance_and_angles(spark):
    r = spark.range(1).select(
        haversine_m(F.lit(0.0), F.lit(179.5), F.lit(0.0), F.lit(-179.5)).alias("d"),
        wrap_lon(F.lit(180.0)).alias("a"), wrap_lon(F.lit(-181.0)).alias("b"), wrap_lon(F.lit(540.0)).alias("c"),
        wrap_course(F.lit(-1.0)).alias("e"), wrap_course(F.lit(360.0)).alias("f")).first()
    assert abs(r.d - math.radians(1) * EARTH_M) < 1e-3
    assert (r.a, r.b, r.c, r.e, r.f) == (-180.0, 179.0, -180.0, 359.0, 0.0)


def zone(name, ring):
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    return (name, name, ring, min(xs), max(xs), min(ys), max(ys))


def test_points_in_concave_rings(spark):
    u_shape = [(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (4.0, 6.0), (4.0, 2.0), (2.0, 2.0), (2.0, 6.0), (0.0, 6.0)]
    zones = spark.createDataFrame([zone("u", u_shape), zone("box", [(3.0, 1.0), (9.0, 1.0), (9.0, 3.0), (3.0, 3.0)])], ZONES)
    pts = [(1, 1.0, 5.0), (2, 3.0, 5.0), (3, 5.0, 5.0), (4, 3.0, 1.5), (5, 8.0, 2.0), (6, -1.0, 1.0), (7, 3.0, 0.5), (8, 5.0, 2.0)]
    df = spark.createDataFrame(pts, "obs_id long, lon double, lat double")
    want = [(1, "u"), (3, "u"), (4, "box"), (4, "u"), (5, "box"), (7, "u"), (8, "box"), (8, "u")]
    for cell in (50_000.0, 400_000.0):
        assert rows(zone_containment(df, zones, cell)) == sorted(want, key=lambda r: (str(r[0]), r[1]))


@pytest.mark.parametrize("crowd", [None, 2, 100_000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_interval_join_against_brute_force(spark, how, crowd):
    rng = random.Random(9)
    t = lambda: datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(-3000, 3000, 10))
    a = [(i, rng.choice([1, 1, 1, 2, None]), t()) for i in range(80)]
    b = [(i, rng.choice([1, 1, 1, 2, None]), t()) for i in range(80)]
    hit = {x[0]: [y[0] for y in b if x[1] is not None and x[1] == y[1] and -60 <= (y[2] - x[2]).total_seconds() <= 90] for x in a}
    want = {"inner": [(x, y) for x, ys in hit.items() for y in ys],
            "left": [(x, y) for x, ys in hit.items() for y in (ys or [None])],
            "left_semi": [(x,) for x, ys in hit.items() if ys], "left_anti": [(x,) for x, ys in hit.items() if not ys]}[how]
    schema = "id long, k long, ts timestamp"
    got = interval_correlate(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), "k", "ts", 60, 90, how, crowd=crowd)
    cols = ["id"] if how.startswith("left_") else ["id", "right_id"]
    assert rows(got, *cols) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_crowds_are_cut_into_parts_of_about_the_limit(spark):
    """A third of the rows of both sides stand at one key: every pair meets once, and no part
    holds much more than the limit; equal rows count too."""
    a = spark.range(6000).select((F.col("id") % 3 * (1 + F.col("id") % 1000)).alias("k"), F.col("id").alias("x"),
                                 F.create_map(F.lit("m"), "id").alias("m"))
    b = spark.range(3000).select((F.col("id") % 3 * (1 + F.col("id") % 1000)).alias("k2"), F.col("id").alias("y"))
    left, right = spread_crowds(a, b, ["k"], ["k2"], 200)
    on = [left["k"] == right["k2"], left[ROW] == right[ROW], left[COLUMN] == right[COLUMN]]
    want = a.join(b, F.col("k") == F.col("k2")).agg(F.count(F.lit(1)), F.count_distinct("x", "y")).first()
    assert left.join(right, on).agg(F.count(F.lit(1)), F.count_distinct("x", "y")).first() == want and want[0] == want[1]
    for side, key in ((left, "k"), (right, "k2")):
        sizes = side.groupBy(key, ROW, COLUMN).count()
        assert sizes.agg(F.max("count")).first()[0] < 300 and sizes.filter(F.col(key) == 0).count() == 50
    one, other = spread_crowds(a, b, ["k"], ["k2"], 200, both=False)
    assert one.count() == 6000 and other.count() == 3000 + 9 * 1000


def test_copies_of_crowds_stay_in_proportion(spark):
    """Parts of one row would copy each row a thousand times."""
    a = spark.range(4000).select((F.col("id") % 4).alias("k"), F.col("id").alias("x"))
    left, right = spread_crowds(a, a.withColumnsRenamed({"k": "k2", "x": "y"}), ["k"], ["k2"], 1)
    assert left.count() + right.count() <= 10 * 8000
    on = [left["k"] == right["k2"], left[ROW] == right[ROW], left[COLUMN] == right[COLUMN]]
    assert left.join(right, on).agg(F.count(F.lit(1)), F.count_distinct("x", "y")).first() == (4_000_000, 4_000_000)


def test_more_crowds_than_a_broadcast_takes(spark, monkeypatch):
    """Only the largest are cut then, as many as the bound allows; no pair is lost."""
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    a = spark.range(400).select(F.floor(F.sqrt("id")).alias("k"), F.col("id").alias("x"))
    left, right = spread_crowds(a, a.withColumnsRenamed({"k": "k2", "x": "y"}), ["k"], ["k2"], 2)
    cut = left.filter(F.col(ROW) > 0).select("k").distinct().count()
    assert cut <= 3
    on = [left["k"] == right["k2"], left[ROW] == right[ROW], left[COLUMN] == right[COLUMN]]
    assert left.join(right, on).count() == sum((2 * k + 1) ** 2 for k in range(20))


def test_best_match_is_mutual_and_breaks_ties_by_id(spark):
    pairs = spark.createDataFrame([(1, 10, .9), (1, 11, .9), (2, 10, .95), (3, 11, .5), (4, 12, .1), (5, 12, .1)],
                                  "left_id long, right_id long, score double")
    assert rows(best_match(pairs), "left_id", "right_id") == [(2, 10), (4, 12)]


@pytest.mark.parametrize("hot", [HotKeys(), HotKeys(min_rows=5, max_keys=20)])
def test_clusters(spark, hot):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 540)]
    links = chain + star + [(7, 7), (9, 8), (8, 9), (None, 3)]
    random.Random(1).shuffle(links)
    got = dict((r.id, r.cluster_id) for r in link_clusters(spark.createDataFrame(links, "left_id long, right_id long"), hot=hot).collect())
    want = {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 540)}, 7: 7, 8: 8, 9: 8}
    assert got == want


def test_lookup_refuses_or_reduces_repeated_reference_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    ref = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (3, "c", 1)], "k long, v string, o int")
    with pytest.raises(ValueError, match="not unique"):
        lookup(df, ref, ["k"], ["v"])
    assert rows(lookup(df, ref, ["k"], ["v"], "first", ["o"])) == [(None, None), (1, "a"), (2, None)]


def plain_holds(ring, x, y):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            inside = not inside
    return inside


ZONE = "zone_id string, ring array<struct<x: double, y: double>>, min_x double, max_x double, min_y double, max_y double"


def random_zones(rng):
    found = []
    for z in range(24):
        size = rng.choice([0.001, 0.1, 5, 40, 150])
        cx, cy = rng.uniform(-180, 180), rng.uniform(-88, 88)
        n = rng.randint(3, 12)
        ring = []
        for k in range(n):  # a star shape, seldom convex
            r, a = size * rng.uniform(0.2, 1), 2 * math.pi * k / n
            ring.append((cx + r * math.cos(a), max(-90.0, min(90.0, cy + r * math.sin(a)))))
        low = min(x for x, _ in ring)
        ring = [(x + 360, y) if low < -180 else (x, y) for x, y in ring]  # on the turn where its box begins
        if z % 5 == 0:
            ring.append(ring[0])  # closed in so many words
        found.append((f"z{z}", ring, min(x for x, _ in ring), max(x for x, _ in ring), min(y for _, y in ring), max(y for _, y in ring)))
    return found


def test_zones_of_all_sizes_beside_plain_rays(spark):
    rng = random.Random(6)
    zones = random_zones(rng)
    points = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(1500)]
    for z in zones:  # points in and around each zone, however small
        for _ in range(12):
            x, y = rng.uniform(z[2], z[3]), rng.uniform(z[4], z[5])
            points.append((len(points), y, (x + 180) % 360 - 180))
    points += [(9001, 90.0, 0.0), (9002, -90.0, 179.9), (9003, None, 1.0), (9004, 1.0, None), (9005, 10.0, 540.0), (9006, 89.99, -180.0)]
    want = {(i, z[0]) for i, y, x in points if y is not None and x is not None for z in zones
            if any(plain_holds(z[1], (x + 180) % 360 - 180 + t, y) for t in (0.0, 360.0))}
    df = spark.createDataFrame(points, "obs_id int, lat double, lon double")
    shapes = spark.createDataFrame([(*z[:1], [(float(a), float(b)) for a, b in z[1]], *z[2:]) for z in zones], ZONE)
    for depth in (0, 3, 6):
        assert {tuple(r) for r in zone_containment_wide(df, shapes, depth).collect()} == want
    assert len(want) > 200


def test_a_cover_goes_by_the_outline_not_by_the_size(spark):
    def box(name, x, y, w, h):
        ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        edges = [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1])]
        return name, edges, x, x + w, y, y + h
    zones = spark.createDataFrame([box("harbour", 10.0, 50.0, 0.01, 0.01), box("ocean", -170.0, -60.0, 300.0, 120.0),
                                   box("line", 170.0, -5.0, 20.0, 10.0)],
                                  "zone_id string, edges array<struct<ax: double, ay: double, bx: double, by: double>>, "
                                  "min_x double, max_x double, min_y double, max_y double")
    cells = Quads.cover(zones, 6).groupBy("zone_id").agg(F.count("*").alias("n"), F.max(F.size("edges")).alias("e")).collect()
    assert {r.zone_id for r in cells} == {"harbour", "ocean", "line"}
    assert all(0 < r.n < 1500 and r.e <= 4 for r in cells)


def test_nearest_however_far(spark):
    rng = random.Random(9)
    refs = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(30)] + [(100, 90.0, 0.0), (101, -90.0, 50.0), (102, 0.0, 180.0), (103, 0.0, -180.0)]
    points = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(60)] + [
        (900, 90.0, 10.0), (901, -90.0, 0.0), (902, 0.0, 179.999), (903, 0.0, -179.999), (904, None, 1.0)]
    df = spark.createDataFrame(points, "obs_id int, lat double, lon double")
    ref = spark.createDataFrame(refs, "ref_id int, lat double, lon double")
    want = set()
    for i, la, lo in points:
        if la is not None:
            order = sorted((round(metres((la, lo), (b, c)), 3), r) for r, b, c in refs)
            want |= {(i, d) for d, _ in order[:3]}
    found = nearest_any(df, ref, 3, start_m=50_000.0).collect()
    assert {(r.obs_id, round(r.dist_m, 3)) for r in found} == want and len(found) == 3 * 64
    few = nearest_any(df, ref.limit(2), 3).collect()
    assert len(few) == 2 * 64 and nearest_any(df, ref.limit(0), 3).count() == 0 and nearest_any(df.limit(0), ref, 3).count() == 0


def test_candidates_of_a_nearest_search_stay_few(spark, monkeypatch):
    """Many reference points on one side of the globe, rows among them and far away."""
    from tidewright.operators import enrich
    rng = random.Random(5)
    refs = [(k, rng.uniform(-90, -30), rng.uniform(-180, 180)) for k in range(4000)] + [(5000 + k, -50.0, 7.0) for k in range(500)]
    points = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(300)] + [(900 + k, -50.0, 7.0) for k in range(50)]
    df = spark.createDataFrame(points, "obs_id int, lat double, lon double")
    ref = spark.createDataFrame(refs, "ref_id int, lat double, lon double")
    tried, plain = [], enrich._tried
    monkeypatch.setattr(enrich, "_tried", lambda points, spots, pairs, *rest: (
        tried.append(pairs.groupBy("q").agg(F.first("q_n").alias("n"), F.first("left").alias("m")).agg(F.sum(F.col("n") * F.col("m"))).first()[0]),
        plain(points, spots, pairs, *rest))[1])
    found = {(r.obs_id, r.rank): (r.ref_id, r.dist_m) for r in nearest_any(df, ref, 3).collect()}
    for i, la, lo in points[::7]:
        order = sorted((round(metres((la, lo), (b, c)), 3), r) for r, b, c in refs)
        assert [round(found[i, n][1], 3) for n in (1, 2, 3)] == [d for d, _ in order[:3]]
    assert [found[900, n][0] for n in (1, 2, 3)] == [5000, 5001, 5002]
    assert sum(tried) <= 300 * len(points)  # of 4,500 each


def test_best_match_by_best_scores_sorts_no_pairs(spark):
    rng = random.Random(9)
    pairs = [(rng.randint(1, 30), rng.randint(100, 130), rng.choice([None, -1.0, 0.5, 0.5, 2.0])) for _ in range(400)]
    df = spark.createDataFrame(pairs, "left_id long, right_id long, score double")
    tops = best_scores(df)
    scored = (df.join(tops.select(F.col("id").alias("left_id"), "left_best"), "left_id")
                .join(tops.select(F.col("id").alias("right_id"), "right_best"), "right_id"))
    got = best_match(scored, best=("left_best", "right_best"))
    assert rows(got) == rows(best_match(df)) and got.columns == ["left_id", "right_id", "score"]
    few = df.filter("score IS NULL")  # ids that have no score at all are ranked by id
    tops = best_scores(few)
    scored = (few.join(tops.select(F.col("id").alias("left_id"), "left_best"), "left_id")
                 .join(tops.select(F.col("id").alias("right_id"), "right_best"), "right_id"))
    assert rows(best_match(scored, best=("left_best", "right_best"))) == rows(best_match(few))


def test_pairs_carry_columns_of_their_sides(spark):
    df = spark.createDataFrame([(1, 0, 10.0, 20.0, "a"), (2, 5, 10.1, 20.0, "b"), (3, 5, 14.0, 20.0, "c")], "obs_id int, s int, lat double, lon double, x string")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    got = proximity_pairs(df.withColumnRenamed("x", "l"), df.withColumnRenamed("x", "r"), 60, 50_000.0, ordered=True,
                          left_cols=["l"], right_cols=["r"])
    assert rows(got, "left_id", "right_id", "l", "r") == [(1, 2, "a", "b")]


def test_pairs_of_a_table_with_itself_are_those_of_two(spark, monkeypatch):
    """The way of one table beside that of two tables, plain, in many tasks and crowded; rows
    at one time and place, ids that come twice and none, and values of both sides."""
    points = scattered(5, 120)
    points += [(1000 + i, *points[i // 2][1:]) for i in range(12)] + [(3, *points[7][1:]), (None, *points[1][1:]), (2000, 1.0, None, points[0][3])]
    df = spark.createDataFrame(points, "obs_id long, lat double, lon double, ts timestamp").withColumn("x", F.col("lat") * 2)
    df = df.withColumn("y", -F.col("lon"))
    sides = dict(ordered=True, left_cols=["x"], right_cols=["y"])
    want = rows(proximity_pairs(df, df.select("*"), 900, 150_000.0, **sides))
    assert want and any(r[2] < 0 for r in want) and any(r[2] == 0 for r in want)
    assert rows(proximity_pairs(df, df, 900, 150_000.0, **sides)) == want
    assert rows(proximity_pairs(df, df, 900, 150_000.0, crowd=1, **sides)) == want
    monkeypatch.setattr("tidewright.operators.correlate.TASK_ROWS", 100)
    many = proximity_pairs(df, df, 900, 150_000.0, **sides)
    assert rows(many) == want
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan  # Spark's own number of tasks made them spill


def test_crowded_pairs_are_copied_twice(spark):
    a = spark.range(4000).select((F.col("id") % 4).alias("k"), F.col("id").alias("x"))
    left, right = spread_crowds(a, a.withColumnsRenamed({"k": "k2", "x": "y"}), ["k"], ["k2"], 1, copies=2)
    assert left.count() + right.count() <= 2 * 8000
    on = [left["k"] == right["k2"], left[ROW] == right[ROW], left[COLUMN] == right[COLUMN]]
    assert left.join(right, on).agg(F.count(F.lit(1)), F.count_distinct("x", "y")).first() == (4_000_000, 4_000_000)
