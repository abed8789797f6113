from pyspark.sql import functions as F

from ...operators.final import (changes, changes_blocks, merge_into, merge_sketches, period_sketch, period_summary,
                                read_sketches, row_changes, sketch_panes, top_n, upsert_final)
from ...session import scratch
from ...sources.sinks import write_final
from ...streaming.run import dropped_rows, run_available
from .base import OBS, as_obs, event_stream, feed, obs, plain_times, query, table


@query("write_final", f"SELECT obs_id, source, entity_key, ts, lat, lon, speed FROM {OBS}")
def stored(spark, sf):
    """Written twice, read back once."""
    path, rows = scratch(spark, "final"), obs(spark, sf)
    for _ in range(2):
        write_final(rows.withColumn("day", F.to_date("ts")), path, ["day"])
    return spark.read.parquet(path).select(*rows.columns)


UPSERT = """
    SELECT o_orderkey, o_orderpriority, o_totalprice, version FROM (
      SELECT o_orderkey, o_orderpriority, o_totalprice, 1 AS version FROM orders
      UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice * 2, 2 FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT o_orderkey + 100000000, o_orderpriority, o_totalprice, 2 FROM orders WHERE o_orderpriority = '2-HIGH')
    QUALIFY row_number() OVER (PARTITION BY o_orderkey, o_orderpriority ORDER BY version DESC) = 1"""


def order_versions(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.lit(1).alias("version"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'").withColumns({"o_totalprice": F.col("o_totalprice") * 2, "version": F.lit(2)})
    added = orders.filter("o_orderpriority = '2-HIGH'").withColumns({"o_orderkey": F.col("o_orderkey") + 100_000_000, "version": F.lit(2)})
    return orders, urgent.unionByName(added)


@query("upsert_final", UPSERT)
def upsert(spark, sf):
    current, newer = order_versions(spark, sf)
    return upsert_final(current, newer, ["o_orderkey", "o_orderpriority"], "version")


@query("merge_into", UPSERT)
def merge(spark, sf):
    path = scratch(spark, "final")
    current, newer = order_versions(spark, sf)
    write_final(current, path, ["o_orderpriority"])
    merge_into(spark, path, newer, ["o_orderkey", "o_orderpriority"], "version", ["o_orderpriority"], scratch(spark, "staging"))
    return spark.read.parquet(path).select(*current.columns)


# Partition values that are no numbers, whatever they look like, and one that is null
ODD_PARTS = "CASE o_orderpriority WHEN '1-URGENT' THEN '007' WHEN '2-HIGH' THEN '7' WHEN '3-MEDIUM' THEN NULL ELSE o_orderpriority END"


@query("merge_into_odd_partitions", f"""
    SELECT o_orderkey, part, o_totalprice, version FROM (
      SELECT o_orderkey, {ODD_PARTS} AS part, o_totalprice, 1 AS version FROM orders
      UNION ALL SELECT o_orderkey, {ODD_PARTS}, o_totalprice * 2, 2 FROM orders
      WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND o_orderkey % 2 = 0)
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1""")
def merge_odd(spark, sf):
    path = scratch(spark, "final")
    current = table(spark, sf, "orders").select("o_orderkey", F.expr(ODD_PARTS).alias("part"), "o_totalprice", F.lit(1).alias("version"))
    newer = current.filter("(part = '007' OR part IS NULL) AND o_orderkey % 2 = 0").withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "version": F.lit(2)})
    write_final(current, path, ["part"])
    merge_into(spark, path, newer, ["o_orderkey", "part"], "version", ["part"], scratch(spark, "staging"))
    return spark.read.schema(current.schema).parquet(path)


CENTS = f"(SELECT *, CAST(round(speed * 100) AS BIGINT) AS cents FROM {OBS})"
MEASURES = "count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS total, min(cents) AS lowest, max(cents) AS highest"


def cents(rows):
    return rows.withColumn("cents", F.round(F.col("speed") * 100).cast("bigint"))


@query("period_tumbling", f"SELECT source, time_bucket(INTERVAL 1 HOUR, ts) AS period_start, {MEASURES} FROM {CENTS} GROUP BY 1, 2")
def tumbling(spark, sf):
    return period_summary(cents(obs(spark, sf)), "ts", 3600, dims=["source"], value="cents")


@query("period_sliding", f"""
    SELECT source, period_start, {MEASURES} FROM (
      SELECT source, cents, unnest([time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * k FOR k IN range(4)]) AS period_start FROM {CENTS})
    GROUP BY 1, 2""")
def sliding(spark, sf):
    return period_summary(cents(obs(spark, sf)), "ts", 7200, 1800, ["source"], "cents")


@query("period_stream", f"""
    SELECT source, time_bucket(INTERVAL 1 HOUR, ts) AS period_start, {MEASURES} FROM {CENTS} GROUP BY 1, 2
    HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def tumbling_stream(spark, sf):
    """Periods the watermark has closed by the end of the feed."""
    out = scratch(spark, "out")
    rows = cents(as_obs(event_stream(spark, feed(spark, sf), 2)))
    done = run_available(period_summary(rows, "ts", 3600, dims=["source"], value="cents", watermark="1 hour"),
                         out, scratch(spark, "ck"))
    if dropped_rows(done):
        raise RuntimeError("the feed was out of order")
    return plain_times(spark.read.parquet(out))


@query("period_sketch")
def sketch(spark, sf):
    return period_sketch(obs(spark, sf), "ts", 86400, ["source"], "entity_key", "speed")


@query("period_sketch_merged", f"""
    SELECT source, period_start, count(*) AS n_rows, true AS entities_near, true AS median_near, true AS high_near FROM (
      SELECT source, unnest([time_bucket(INTERVAL 1 DAY, ts) - INTERVAL 1 DAY * k FOR k IN range(7)]) AS period_start FROM {OBS})
    GROUP BY 1, 2""")
def sketch_merged(spark, sf):
    """Panes of six hours, stored, then merged to weeks that slide by a day: whether the number
    of entities is within 3 % of the exact one, and whether the rank of the median and of the
    95th percentile are within 3 % of all rows."""
    path, rows = scratch(spark, "panes"), obs(spark, sf)
    sketch_panes(rows, "ts", 21_600, ["source"], "entity_key", "speed").write.parquet(path)
    told = read_sketches(merge_sketches(spark.read.parquet(path), 21_600, 7 * 86_400, 86_400, ["source"]))
    days = rows.select("source", "entity_key", "speed", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k"),
                       F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("day"))
    weeks = days.withColumn("period_start", (F.col("day") - F.make_dt_interval(F.col("k"))).cast("timestamp_ntz"))
    told = told.withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))
    exact = weeks.join(told, ["source", "period_start"]).groupBy("source", "period_start").agg(
        F.first("n_rows").alias("n_rows"), F.first("n_entities").alias("told"), F.countDistinct("entity_key").alias("n_entities"),
        *[F.count_if(F.col("speed") < F.col("quantiles")[i]).alias(f"below{i}") for i in (0, 1)],
        *[F.count_if(F.col("speed") <= F.col("quantiles")[i]).alias(f"upto{i}") for i in (0, 1)])
    # the fraction lies between the shares of values below the estimate and up to it, or 3 % off
    near = lambda i, f: ((F.col(f"below{i}") <= (f + 0.03) * F.col("n_rows")) & (F.col(f"upto{i}") >= (f - 0.03) * F.col("n_rows")))
    return exact.select("source", "period_start", "n_rows", (F.abs(F.col("told") - F.col("n_entities")) <= 0.03 * F.col("n_entities")).alias("entities_near"),
                        near(0, 0.5).alias("median_near"), near(1, 0.95).alias("high_near"))


@query("top_n", """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank
      FROM lineitem) WHERE rank <= 3""")
def best(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return top_n(lines, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"], 3)


CHANGES = """
    SELECT o_orderkey, change FROM (
      SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'altered' WHEN o_orderpriority = '5-LOW' THEN 'removed' END AS change FROM orders
      UNION ALL SELECT o_orderkey + 100000000, 'added' FROM orders WHERE o_orderpriority = '2-HIGH') WHERE change IS NOT NULL"""


def order_tables(spark, sf):
    old = table(spark, sf, "orders")
    new = old.filter("o_orderpriority <> '5-LOW'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_orderstatus")))
    added = old.filter("o_orderpriority = '2-HIGH'").withColumn("o_orderkey", F.col("o_orderkey") + 100_000_000)
    return old, new.unionByName(added)


@query("changes", CHANGES)
def differences(spark, sf):
    return changes(*order_tables(spark, sf), ["o_orderkey"])


@query("changes_blocks", CHANGES)
def block_differences(spark, sf):
    return changes_blocks(*order_tables(spark, sf), ["o_orderkey"])


@query("row_changes", """
    SELECT l_partkey, l_suppkey, l_quantity, CAST(count(*) AS BIGINT) AS n_added FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3""")
def row_differences(spark, sf):
    lines = table(spark, sf, "lineitem")
    kept = lines.filter("l_returnflag <> 'R'").select("l_partkey", "l_suppkey", "l_quantity")
    return row_changes(kept, lines.select("l_partkey", "l_suppkey", "l_quantity"))
