from pyspark.sql import functions as F

from ...operators.fuse import conflicts, fuse_attributes, fuse_measurements, latest_state, resample
from ...session import scratch
from ...streaming.run import latest_table, read_latest
from ...streaming.state import presence_table, read_presence
from .base import OBS, as_obs, event_stream, feed, obs, plain_times, query, table
from .validate import FORCED

PRIORITY = ("purchase", "signup", "click", "view")

FUSED = """(SELECT entity_key, {a} AS v, source AS s FROM {obs} WHERE {a} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY
      coalesce(list_position(['purchase', 'signup', 'click', 'view'], source), 5), ts DESC, obs_id DESC) = 1)"""
GAPPY = f"(SELECT obs_id, source, entity_key, ts, CASE WHEN speed >= 20 THEN speed END AS speed, CASE WHEN lat < -80 THEN lat END AS lat FROM {OBS})"


@query("fuse_attributes", f"""
    SELECT e.entity_key, a.v AS speed, a.s AS speed_source, b.v AS lat, b.s AS lat_source
    FROM (SELECT DISTINCT entity_key FROM {OBS}) e
    LEFT JOIN {FUSED.format(a='speed', obs=GAPPY)} a ON a.entity_key = e.entity_key
    LEFT JOIN {FUSED.format(a='lat', obs=GAPPY)} b ON b.entity_key = e.entity_key""")
def attributes(spark, sf):
    gappy = obs(spark, sf).withColumns({"speed": F.when(F.col("speed") >= 20, F.col("speed")),
                                        "lat": F.when(F.col("lat") < -80, F.col("lat"))})
    return fuse_attributes(gappy, "entity_key", ["speed", "lat"], PRIORITY)


@query("fuse_measurements", f"""
    SELECT entity_key, bucket_start, n_rows, CAST(s AS DOUBLE) / CAST(w AS DOUBLE) * 0.01 AS speed,
           CASE WHEN y <> 0 OR x <> 0 THEN round(((degrees(atan2(CAST(y AS DOUBLE), CAST(x AS DOUBLE))) % 360) + 360) % 360, 6) END AS lon
    FROM (SELECT entity_key, time_bucket(INTERVAL 1 DAY, ts) AS bucket_start, count(*) AS n_rows,
                 CAST(sum(w * CAST(round(speed / 0.01) AS BIGINT)) AS BIGINT) AS s, CAST(sum(w) AS BIGINT) AS w,
                 CAST(sum(w * CAST(round(sin(radians(lon)) * 1e9) AS BIGINT)) AS BIGINT) AS y,
                 CAST(sum(w * CAST(round(cos(radians(lon)) * 1e9) AS BIGINT)) AS BIGINT) AS x
          FROM (SELECT *, obs_id % 5 + 1 AS w FROM {OBS}) GROUP BY 1, 2)""")
def measurements(spark, sf):
    rows = obs(spark, sf).withColumn("w", F.col("obs_id") % 5 + 1)
    out = fuse_measurements(rows, "entity_key", "ts", "1 day", {"speed": 0.01}, ["lon"], "w")
    return out.withColumn("lon", F.round("lon", 6))


GRID = f"""WITH o AS (SELECT entity_key, epoch_us(ts) AS t0, speed,
        lead(epoch_us(ts)) OVER w AS t1, lead(speed) OVER w AS s1 FROM {OBS} WINDOW w AS (PARTITION BY entity_key ORDER BY ts, obs_id)),
    g AS (SELECT entity_key, unnest(generate_series((a + 3599999999) // 3600000000, z // 3600000000)) * 3600000000 AS t
          FROM (SELECT entity_key, min(t0) AS a, max(t0) AS z FROM o GROUP BY 1))
    SELECT g.entity_key, make_timestamp(g.t) AS grid_ts, {{value}} AS speed
    FROM g ASOF JOIN o ON g.entity_key = o.entity_key AND g.t >= o.t0"""
LINEAR = "CASE WHEN t = t0 THEN speed ELSE speed + CAST(t - t0 AS DOUBLE) / CAST(t1 - t0 AS DOUBLE) * (s1 - speed) END"


@query("resample_last", GRID.format(value="o.speed"))
def grid_last(spark, sf):
    return resample(obs(spark, sf), "entity_key", "ts", 3600, ["speed"], tie=["obs_id"])


@query("resample_linear", GRID.format(value=LINEAR))
def grid_linear(spark, sf):
    return resample(obs(spark, sf), "entity_key", "ts", 3600, ["speed"], "linear", tie=["obs_id"])


@query("resample_linear_hot", GRID.format(value=LINEAR))
def grid_linear_hot(spark, sf):
    return resample(obs(spark, sf), "entity_key", "ts", 3600, ["speed"], "linear", tie=["obs_id"], hot=FORCED)


@query("resample_gap", GRID.format(value="o.speed") + " WHERE g.t - o.t0 <= 10800000000")
def grid_gap(spark, sf):
    return resample(obs(spark, sf), "entity_key", "ts", 3600, ["speed"], max_gap=10800, tie=["obs_id"])


@query("conflicts", """
    SELECT o_custkey, attr, count(DISTINCT v) AS n_values, count(*) AS n_rows, min(v) AS lowest, max(v) AS highest,
           min(s) AS first_source, max(s) AS last_source
    FROM (SELECT o_custkey, 'o_orderpriority' AS attr, o_orderpriority AS v, o_orderstatus AS s FROM orders
          UNION ALL SELECT o_custkey, 'o_totalprice', CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR), o_orderstatus FROM orders)
    GROUP BY 1, 2 HAVING count(DISTINCT v) > 1""")
def disagreements(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_totalprice", F.round("o_totalprice").cast("bigint"))
    return conflicts(orders, "o_custkey", ["o_orderpriority", "o_totalprice"], "o_orderstatus")


LATEST = f"SELECT entity_key, obs_id, source, ts, lat, lon, speed FROM {OBS} QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY ts DESC, obs_id DESC) = 1"


@query("latest_state", LATEST)
def newest(spark, sf):
    return latest_state(obs(spark, sf), "entity_key", "ts", ["obs_id"])


@query("latest_state_stream", LATEST)
def newest_stream(spark, sf):
    out = scratch(spark, "out")
    rows = as_obs(event_stream(spark, feed(spark, sf), 2))
    latest_table(rows, "entity_key", "ts", ["obs_id"], out, scratch(spark, "ck"))
    return plain_times(read_latest(spark, out, "entity_key", "ts", ["obs_id"]))


@query("latest_state_expiring", f"""
    WITH o AS (SELECT *, lead(epoch_us(ts)) OVER (PARTITION BY entity_key ORDER BY ts, obs_id) AS next FROM {OBS}),
    w AS (SELECT (epoch_us(max(ts)) // 1000 - 3600000) * 1000 AS passed FROM events),
    s AS (SELECT *, CASE WHEN next - epoch_us(ts) > 172800000000 OR (next IS NULL AND epoch_us(ts) + 172800000000 <= passed) THEN 'lost'
                         WHEN next IS NULL THEN 'live' END AS status FROM o, w)
    SELECT entity_key, status, obs_id, source, ts, lat, lon, speed FROM s WHERE status IS NOT NULL""")
def expiring(spark, sf):
    """Entities silent for two days leave the state; taken in over two runs of one checkpoint."""
    out, path, checkpoint = scratch(spark, "out"), feed(spark, sf), scratch(spark, "ck")
    for _ in range(2):
        rows = as_obs(event_stream(spark, path, 2))
        presence_table(rows, "entity_key", "ts", 172_800, "1 hour", ["obs_id"], out, checkpoint)
    live, lost = read_presence(spark, out, "entity_key", "ts", ["obs_id"])
    both = live.withColumn("status", F.lit("live")).unionByName(lost.withColumn("status", F.lit("lost")))
    return plain_times(both).select("entity_key", "status", "obs_id", "source", "ts", "lat", "lon", "speed")
