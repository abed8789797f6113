from pyspark.sql import functions as F

from ...operators.decode import route_rejects, split_fields
from ...operators.validate import (Rule, apply_rules, check_motion, check_reference, check_unique,
                                   quality_report, reconcile, split_quarantine)
from .base import FORCED, OBS, events, haversine_sql, obs, query, table
from .decode import LINE, broken_lines

RULES = (
    Rule("speed_low", "speed >= 1.0", "warning"),
    Rule("speed_high", "speed < 100.0", "error"),
    Rule("lat_range", "lat BETWEEN -89.0 AND 90.0", "error"),
    Rule("known_source", "nullif(source, 'error') IN ('click', 'view', 'purchase', 'signup')", "warning"),
)

BROKEN = """concat_ws(',', CASE WHEN NOT speed >= 1.0 THEN 'speed_low' END,
        CASE WHEN NOT speed < 100.0 THEN 'speed_high' END,
        CASE WHEN NOT (lat BETWEEN -89.0 AND 90.0) THEN 'lat_range' END,
        CASE WHEN source = 'error' THEN 'known_source' END)"""


@query("apply_rules", f"SELECT obs_id, {BROKEN} AS violations FROM {OBS}")
def rules(spark, sf):
    return apply_rules(obs(spark, sf), RULES).select("obs_id", F.array_join("violations", ",").alias("violations"))


@query("split_quarantine", f"""
    SELECT obs_id, CASE WHEN speed < 100.0 AND lat BETWEEN -89.0 AND 90.0 THEN 'valid' ELSE 'quarantine' END AS side
    FROM {OBS}""")
def quarantine(spark, sf):
    valid, held = split_quarantine(apply_rules(obs(spark, sf), RULES), RULES)
    return (valid.select("obs_id", F.lit("valid").alias("side"))
            .unionByName(held.select("obs_id", F.lit("quarantine").alias("side"))))


@query("check_unique", """
    SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_repeated
    FROM lineitem""")
def unique(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return check_unique(lines, ["l_orderkey", "l_linenumber"])


@query("check_reference", """
    SELECT c_custkey, c_nationkey FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey <> 2)""")
def reference(spark, sf):
    known = table(spark, sf, "nation").filter("n_regionkey <> 2").withColumnRenamed("n_nationkey", "c_nationkey")
    return check_reference(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), known, ["c_nationkey"])


MOTION = f"""
    SELECT obs_id, round(dist, 3) AS prev_dist_m, secs AS prev_seconds, round(dist / nullif(secs, 0), 4) AS speed_mps,
           coalesce(dist / nullif(secs, 0) > 30.0 OR (secs = 0 AND dist > 0), false) AS too_fast
    FROM (SELECT b.obs_id, {haversine_sql('a', 'b')} AS dist, (epoch_us(b.ts) - epoch_us(a.ts)) / 1000000.0 AS secs
          FROM (SELECT *, lag(obs_id) OVER (PARTITION BY entity_key ORDER BY ts, obs_id) AS p FROM {OBS}) b
          LEFT JOIN {OBS} a ON a.obs_id = b.p)"""


def _motion(spark, sf, **kw):
    found = check_motion(obs(spark, sf), "entity_key", "ts", 30.0, tie=["obs_id"], **kw)
    return found.select("obs_id", F.round("prev_dist_m", 3).alias("prev_dist_m"), "prev_seconds",
                        F.round("speed_mps", 4).alias("speed_mps"), "too_fast")


@query("check_motion", MOTION)
def motion(spark, sf):
    return _motion(spark, sf)


@query("check_motion_hot", MOTION)
def motion_hot(spark, sf):
    """The same over chunks: every entity counts as hot, so the SQL check covers that path."""
    return _motion(spark, sf, hot=FORCED)


# Every 5th report has lost its latitude, every 7th its longitude
GAPS = OBS.replace("value % 180 - 90 AS lat", "CASE WHEN event_id % 5 <> 0 THEN value % 180 - 90 END AS lat").replace(
    "CAST((event_id * 37) % 360 - 180 AS DOUBLE) AS lon", "CASE WHEN event_id % 7 <> 0 THEN CAST((event_id * 37) % 360 - 180 AS DOUBLE) END AS lon")


@query("check_motion_gaps", f"""
    WITH o AS {GAPS}, fixes AS (
      SELECT *, lag(obs_id) OVER (PARTITION BY entity_key ORDER BY ts, obs_id) AS p FROM o WHERE lat IS NOT NULL AND lon IS NOT NULL)
    SELECT obs_id, round(dist, 3) AS prev_dist_m, secs AS prev_seconds, round(dist / nullif(secs, 0), 4) AS speed_mps,
           coalesce(dist / nullif(secs, 0) > 30.0 OR (secs = 0 AND dist > 0), false) AS too_fast
    FROM (SELECT o.obs_id, {haversine_sql('a', 'o')} AS dist, (epoch_us(o.ts) - epoch_us(a.ts)) / 1000000.0 AS secs
          FROM o LEFT JOIN fixes f ON f.obs_id = o.obs_id LEFT JOIN o a ON a.obs_id = f.p)""")
def motion_gaps(spark, sf):
    rows = obs(spark, sf).withColumns({"lat": F.when(F.col("obs_id") % 5 != 0, F.col("lat")),
                                       "lon": F.when(F.col("obs_id") % 7 != 0, F.col("lon"))})
    found = check_motion(rows, "entity_key", "ts", 30.0, tie=["obs_id"])
    return found.select("obs_id", F.round("prev_dist_m", 3).alias("prev_dist_m"), "prev_seconds",
                        F.round("speed_mps", 4).alias("speed_mps"), "too_fast")


@query("quality_report", f"""
    SELECT source, rule, count(*) AS n_rows, CAST(grouping(source, rule) AS BIGINT) AS level
    FROM (SELECT source, unnest(CASE WHEN b = '' THEN [NULL] ELSE string_split(b, ',') END) AS rule
          FROM (SELECT source, {BROKEN} AS b FROM {OBS})) GROUP BY CUBE (source, rule)""")
def quality(spark, sf):
    return quality_report(apply_rules(obs(spark, sf), RULES), ["source"])


@query("reconcile", f"""
    SELECT 'decode' AS stage, count(*) AS n_in, count(*) AS n_out, true AS balanced FROM events
    UNION ALL SELECT 'validate', count(*), count(*), true FROM events""")
def balance(spark, sf):
    lines = broken_lines(spark, sf)
    good, bad = route_rejects(split_fields(lines, "raw", ";", LINE))
    checked = apply_rules(obs(spark, sf), RULES)
    valid, held = split_quarantine(checked, RULES)
    return reconcile({"decode": (lines, {"good": good, "rejects": bad}),
                      "validate": (events(spark, sf), {"valid": valid, "quarantine": held})})
