from pyspark.sql import functions as F

from ...operators.correlate import (asof_attach, asof_within, best_match, best_scores, interval_correlate,
                                    link_clusters, proximity_pairs, session_spans, sessions)
from ...session import scratch
from ...streaming.run import run_available
from .base import OBS, as_obs, event_stream, feed, haversine_sql, obs, plain_times, query
from .validate import FORCED

MATCH = """b.entity_key = a.entity_key AND epoch_us(b.ts) - epoch_us(a.ts) BETWEEN 0 AND 1800000000"""


def _clicks(rows):
    return rows.filter("source = 'click'").select("entity_key", "ts", "obs_id")


def _buys(rows):
    return rows.filter("source = 'purchase'").select("entity_key", "ts", "obs_id", "speed")


PAIRS = f"""
    SELECT a.entity_key, a.ts, a.obs_id, b.entity_key AS right_entity_key, b.ts AS right_ts,
           b.obs_id AS right_obs_id, b.speed AS right_speed
    FROM {OBS} a JOIN {OBS} b ON b.source = 'purchase' AND {MATCH} WHERE a.source = 'click'"""


@query("interval_correlate", PAIRS)
def interval(spark, sf):
    rows = obs(spark, sf)
    return interval_correlate(_clicks(rows), _buys(rows), "entity_key", "ts", 0, 1800)


@query("interval_correlate_left", PAIRS.replace(f"{OBS} a JOIN", f"{OBS} a LEFT JOIN"))
def interval_left(spark, sf):
    rows = obs(spark, sf)
    return interval_correlate(_clicks(rows), _buys(rows), "entity_key", "ts", 0, 1800, "left")


@query("interval_correlate_semi", f"""
    SELECT entity_key, ts, obs_id FROM {OBS} a WHERE source = 'click' AND EXISTS
      (SELECT 1 FROM {OBS} b WHERE b.source = 'purchase' AND {MATCH})""")
def interval_semi(spark, sf):
    rows = obs(spark, sf)
    return interval_correlate(_clicks(rows), _buys(rows), "entity_key", "ts", 0, 1800, "left_semi")


@query("interval_correlate_anti", f"""
    SELECT entity_key, ts, obs_id FROM {OBS} a WHERE source = 'click' AND NOT EXISTS
      (SELECT 1 FROM {OBS} b WHERE b.source = 'purchase' AND {MATCH})""")
def interval_anti(spark, sf):
    rows = obs(spark, sf)
    return interval_correlate(_clicks(rows), _buys(rows), "entity_key", "ts", 0, 1800, "left_anti")


@query("interval_correlate_crowded", PAIRS)
def interval_crowded(spark, sf):
    """The same, every bucket with two rows counted as crowded."""
    rows = obs(spark, sf)
    return interval_correlate(_clicks(rows), _buys(rows), "entity_key", "ts", 0, 1800, crowd=1)


@query("interval_correlate_stream", PAIRS)
def interval_stream(spark, sf):
    path, out = feed(spark, sf), scratch(spark, "out")
    pairs = interval_correlate(_clicks(as_obs(event_stream(spark, path, 2))), _buys(as_obs(event_stream(spark, path, 2))),
                               "entity_key", "ts", 0, 1800, watermark="1 hour")
    run_available(pairs, out, scratch(spark, "ck"))
    return plain_times(spark.read.parquet(out))


ASOF = f"""
    SELECT a.obs_id, a.entity_key, a.ts, b.ts AS view_ts, b.obs_id AS view_obs_id, b.speed AS view_speed
    FROM (SELECT * FROM {OBS} WHERE source = 'click') a
    ASOF LEFT JOIN (SELECT * FROM {OBS} WHERE source = 'view') b ON a.entity_key = b.entity_key AND a.ts >= b.ts"""


def _asof(spark, sf, **kw):
    rows = obs(spark, sf)
    return asof_attach(rows.filter("source = 'click'").select("obs_id", "entity_key", "ts"),
                       rows.filter("source = 'view'"), ["entity_key"], "ts", ["ts", "obs_id", "speed"],
                       prefix="view_", **kw)


@query("asof_attach", ASOF)
def asof(spark, sf):
    return _asof(spark, sf)


@query("asof_attach_hot", ASOF)
def asof_hot(spark, sf):
    return _asof(spark, sf, hot=FORCED)


@query("asof_within", ASOF)
def asof_same_table(spark, sf):
    rows = obs(spark, sf)
    found = asof_within(rows, F.col("source") == "click", F.col("source") == "view", ["entity_key"], "ts",
                        ["ts", "obs_id", "speed"], prefix="view_")
    return found.select("obs_id", "entity_key", "ts", "view_ts", "view_obs_id", "view_speed")


@query("asof_attach_tolerance", f"""
    SELECT obs_id, entity_key, ts, CASE WHEN ok THEN view_ts END AS view_ts,
           CASE WHEN ok THEN view_obs_id END AS view_obs_id, CASE WHEN ok THEN view_speed END AS view_speed
    FROM (SELECT *, epoch_us(ts) - epoch_us(view_ts) <= 7200000000 AS ok FROM ({ASOF}))""")
def asof_tolerance(spark, sf):
    return _asof(spark, sf, tolerance=7200)


NEAR = f"""
    SELECT a.obs_id AS left_id, b.obs_id AS right_id,
           (epoch_us(b.ts) - epoch_us(a.ts)) / 1000000.0 AS dt_seconds, {haversine_sql('a', 'b')} AS dist_m
    FROM {OBS} a JOIN {OBS} b ON a.obs_id < b.obs_id
     AND epoch_us(b.ts) BETWEEN epoch_us(a.ts) - 3600000000 AND epoch_us(a.ts) + 3600000000
    WHERE {haversine_sql('a', 'b')} <= 300000"""


def near(spark, sf, **kw):
    return _near(obs(spark, sf), **kw)


def _near(rows, max_m=300_000, **kw):
    return proximity_pairs(rows, rows, 3600, max_m, ordered=True, **kw)


@query("proximity_pairs", f"SELECT left_id, right_id, dt_seconds, round(dist_m, 3) AS dist_m FROM ({NEAR})")
def proximity(spark, sf):
    return near(spark, sf).select("left_id", "right_id", "dt_seconds", F.round("dist_m", 3).alias("dist_m"))


@query("proximity_pairs_crowded", f"SELECT left_id, right_id, dt_seconds, round(dist_m, 3) AS dist_m FROM ({NEAR})")
def proximity_crowded(spark, sf):
    return near(spark, sf, crowd=1).select("left_id", "right_id", "dt_seconds", F.round("dist_m", 3).alias("dist_m"))


SEGMENTS = f"""
    SELECT obs_id, entity_key, max(opens) OVER (PARTITION BY entity_key ORDER BY ts, obs_id) AS session_start
    FROM (SELECT *, CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > 1800000000 THEN ts END AS opens
          FROM (SELECT *, lag(ts) OVER (PARTITION BY entity_key ORDER BY ts, obs_id) AS p FROM {OBS}))"""


@query("sessions", SEGMENTS)
def segments(spark, sf):
    return sessions(obs(spark, sf).select("obs_id", "entity_key", "ts"), "entity_key", "ts", 1800, ["obs_id"]).drop("ts")


@query("sessions_hot", SEGMENTS)
def segments_hot(spark, sf):
    return sessions(obs(spark, sf).select("obs_id", "entity_key", "ts"), "entity_key", "ts", 1800, ["obs_id"],
                    hot=FORCED).drop("ts")


@query("session_spans", f"""
    SELECT s.entity_key, session_start, max(ts) AS last_ts, count(*) AS n_rows
    FROM ({SEGMENTS}) s JOIN {OBS} o USING (obs_id) GROUP BY 1, 2""")
def spans(spark, sf):
    return session_spans(obs(spark, sf).select("obs_id", "entity_key", "ts"), "entity_key", "ts", 1800, ["obs_id"])


@query("session_spans_stream", f"""
    SELECT s.entity_key, session_start, max(ts) AS last_ts, count(*) AS n_rows
    FROM ({SEGMENTS}) s JOIN {OBS} o USING (obs_id) GROUP BY 1, 2
    HAVING max(ts) + INTERVAL 30 MINUTE < (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def spans_stream(spark, sf):
    """Segments the watermark has closed by the end of the feed."""
    out = scratch(spark, "out")
    rows = as_obs(event_stream(spark, feed(spark, sf), 2))
    run_available(session_spans(rows, "entity_key", "ts", 1800, watermark="1 hour"), out, scratch(spark, "ck"))
    return plain_times(spark.read.parquet(out))


@query("best_match", f"""
    WITH pairs AS ({NEAR}),
    ranked AS (SELECT left_id, right_id, round(dist_m, 3) AS d,
        row_number() OVER (PARTITION BY left_id ORDER BY round(dist_m, 3), right_id) AS a,
        row_number() OVER (PARTITION BY right_id ORDER BY round(dist_m, 3), left_id) AS b FROM pairs)
    SELECT left_id, right_id, -d AS score FROM ranked WHERE a = 1 AND b = 1""")
def best(spark, sf):
    def scored(rows, *cols):
        pairs = _near(rows, left_cols=cols[:1], right_cols=cols[1:])
        return pairs.select("left_id", "right_id", (-F.round("dist_m", 3)).alias("score"), *cols)

    rows = obs(spark, sf)
    tops = best_scores(scored(rows)).withColumnRenamed("id", "obs_id")
    return best_match(scored(rows.join(tops, "obs_id"), "left_best", "right_best"), best=("left_best", "right_best"))


@query("link_clusters", f"""
    WITH RECURSIVE pairs AS (SELECT left_id, right_id FROM ({NEAR}) WHERE dist_m <= 50000),
    both_ways AS (SELECT left_id AS a, right_id AS b FROM pairs UNION SELECT right_id, left_id FROM pairs),
    reach AS (SELECT a AS id, a AS other FROM both_ways
              UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.other = e.a)
    SELECT id, min(other) AS cluster_id FROM reach GROUP BY id""")
def clusters(spark, sf):
    # pairs within 300 km of which those within 50 km are taken are those within 50 km
    return link_clusters(near(spark, sf, max_m=50_000))
