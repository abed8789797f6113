from pyspark.sql import Window, functions as F

from ...operators.enrich import lookup, lookup_valid_time, nearest_any, nearest_reference, zone_containment, zone_containment_wide
from ...session import scratch
from ...streaming.run import run_available
from .base import OBS, event_stream, events, feed, haversine_sql, obs, plain_times, query, table


def places(spark, sf):
    """Customer with nation and region, keyed like the observations."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    r = table(spark, sf, "region")
    return lookup(lookup(c, n, ["n_nationkey"], ["n_name", "r_regionkey"]), r, ["r_regionkey"], ["r_name"])


PLACED = """
    SELECT e.event_id, e.user_id, c.c_name, n.n_name, r.r_name FROM events e
    LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""


@query("lookup", PLACED)
def placed(spark, sf):
    return lookup(events(spark, sf).select("event_id", "user_id"), places(spark, sf), ["user_id"],
                  ["c_name", "n_name", "r_name"])


@query("lookup_first", """
    SELECT o_orderkey, o_custkey, c.o_totalprice AS first_price FROM orders
    LEFT JOIN (SELECT o_custkey, o_totalprice FROM orders
               QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1) c
    USING (o_custkey)""")
def first_order(spark, sf):
    orders = table(spark, sf, "orders")
    ref = orders.select("o_custkey", F.col("o_totalprice").alias("first_price"), "o_orderdate", "o_orderkey")
    return lookup(orders.select("o_orderkey", "o_custkey"), ref, ["o_custkey"], ["first_price"], "first",
                  ["o_orderdate", "o_orderkey"])


@query("lookup_stream", PLACED)
def placed_stream(spark, sf):
    out = scratch(spark, "out")
    rows = event_stream(spark, feed(spark, sf)).select("event_id", "user_id")
    run_available(lookup(rows, places(spark, sf), ["user_id"], ["c_name", "n_name", "r_name"]), out, scratch(spark, "ck"))
    return plain_times(spark.read.parquet(out))


@query("lookup_valid_time", """
    WITH periods AS (
      SELECT o_custkey, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to, o_orderpriority
      FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1))
    SELECT o.o_orderkey, p.o_orderpriority AS then_priority
    FROM (SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 100 DAY AS at FROM orders) o
    LEFT JOIN periods p ON p.o_custkey = o.o_custkey AND o.at >= p.valid_from AND (p.valid_to IS NULL OR o.at < p.valid_to)""")
def valid_time(spark, sf):
    """What priority each customer's standing order had 100 days after an order."""
    orders = table(spark, sf, "orders")
    once = orders.groupBy("o_custkey", F.col("o_orderdate").alias("valid_from")).agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("priority"))
    w = Window.partitionBy("o_custkey").orderBy("valid_from")
    periods = once.withColumn("valid_to", F.lead("valid_from").over(w))
    asked = orders.select("o_orderkey", "o_custkey", (F.col("o_orderdate") + F.expr("interval 100 days")).alias("at"))
    found = lookup_valid_time(asked, periods, "o_custkey", "at", ["priority"], prefix="then_")
    return found.select("o_orderkey", "then_priority")


def nation_zones(spark, sf):
    """One rectangle per nation, derived from its key: 20 by 15 degrees; the last goes
    over the ±180° line."""
    x, y = F.col("n_nationkey") * 14.0 - 175.0, F.col("n_nationkey") * 6.0 - 89.0
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("zone_id"), F.array(corner(0.0, 0.0), corner(20.0, 0.0), corner(20.0, 15.0), corner(0.0, 15.0)).alias("ring"),
        x.alias("min_x"), (x + 20.0).alias("max_x"), y.alias("min_y"), (y + 15.0).alias("max_y"))


@query("zone_containment", f"""
    SELECT o.obs_id, z.n_name AS zone_id FROM {OBS} o JOIN
      (SELECT n_name, n_nationkey * 14.0 - 175.0 AS x, n_nationkey * 6.0 - 89.0 AS y FROM nation) z
      ON ((o.lon >= z.x AND o.lon < z.x + 20.0) OR (o.lon + 360 >= z.x AND o.lon + 360 < z.x + 20.0))
         AND o.lat >= z.y AND o.lat < z.y + 15.0""")
def zones(spark, sf):
    return zone_containment(obs(spark, sf), nation_zones(spark, sf), 100_000)


PORTS = """(SELECT s_suppkey AS ref_id, abs(s_acctbal) % 60 - 90 AS lat, CAST((s_suppkey * 67) % 360 - 180 AS DOUBLE) AS lon FROM supplier)"""


def ports(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("ref_id"), (F.abs("s_acctbal") % 60 - 90).alias("lat"),
        ((F.col("s_suppkey") * 67) % 360 - 180).cast("double").alias("lon"))


@query("nearest_reference", f"""
    SELECT obs_id, ref_id, round(dist_m, 3) AS dist_m, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY dist_m, ref_id) AS rank
      FROM (SELECT a.obs_id, b.ref_id, {haversine_sql('a', 'b')} AS dist_m FROM {OBS} a CROSS JOIN {PORTS} b)
      WHERE dist_m <= 500000) WHERE rank <= 3""")
def nearest(spark, sf):
    found = nearest_reference(obs(spark, sf), ports(spark, sf), 3, 500_000)
    return found.withColumn("dist_m", F.round("dist_m", 3))


@query("zone_containment_wide", f"""
    SELECT o.obs_id, z.n_name AS zone_id FROM {OBS} o JOIN
      (SELECT n_name, n_nationkey * 14.0 - 175.0 AS x, n_nationkey * 6.0 - 89.0 AS y FROM nation) z
      ON ((o.lon >= z.x AND o.lon < z.x + 20.0) OR (o.lon + 360 >= z.x AND o.lon + 360 < z.x + 20.0))
         AND o.lat >= z.y AND o.lat < z.y + 15.0
    UNION ALL SELECT obs_id, 'NORTH' FROM {OBS} WHERE lat >= -60.0
    UNION ALL SELECT obs_id, 'LEFT OF THE LINE' FROM {OBS} WHERE lat >= -90 AND lat < 90 AND lon < lat
    UNION ALL SELECT obs_id, 'POINT' FROM {OBS} WHERE lat >= -89.5 AND lat < -89.499 AND lon >= 10.0 AND lon < 10.001""")
def zones_wide(spark, sf):
    """The nations' rectangles with half the globe, all that lies left of a slanting line, and
    a hundred metres: a hundred million of the last fit into the first."""
    corner = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))

    def zone(name, *ring):
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        return spark.range(1).select(F.lit(name).alias("zone_id"), F.array(*[corner(*p) for p in ring]).alias("ring"),
                                     *[F.lit(float(v)).alias(c) for c, v in (("min_x", min(xs)), ("max_x", max(xs)), ("min_y", min(ys)), ("max_y", max(ys)))])

    wide = (nation_zones(spark, sf).unionByName(zone("NORTH", (-180, -60), (180, -60), (180, 90.001), (-180, 90.001)))
            .unionByName(zone("LEFT OF THE LINE", (-180, -90), (-90, -90), (90, 90), (-180, 90)))
            .unionByName(zone("POINT", (10, -89.5), (10.001, -89.5), (10.001, -89.499), (10, -89.499))))
    return zone_containment_wide(obs(spark, sf), wide)


@query("nearest_any", f"""
    SELECT obs_id, ref_id, round(dist_m, 3) AS dist_m, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY dist_m, ref_id) AS rank
      FROM (SELECT a.obs_id, b.ref_id, {haversine_sql('a', 'b')} AS dist_m FROM {OBS} a CROSS JOIN {PORTS} b)) WHERE rank <= 2""")
def nearest_anywhere(spark, sf):
    found = nearest_any(obs(spark, sf), ports(spark, sf), 2)
    return found.withColumn("dist_m", F.round("dist_m", 3))
