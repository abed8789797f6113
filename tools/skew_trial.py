"""Times order-dependent operators with a third of the rows on one entity, with and
without cutting the hot key, and compares the results.

    python tools/skew_trial.py [copies]      rows = copies * 100,000
"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from pyspark.sql import functions as F  # noqa: E402

from check import local_session  # noqa: E402
from tidewright.functions.skew import HotKeys  # noqa: E402
from tidewright.operators.correlate import asof_within, interval_correlate, sessions  # noqa: E402
from tidewright.operators.ingest import checksum, dedup  # noqa: E402
from tidewright.operators.validate import check_motion, check_unique  # noqa: E402
from tidewright.plans.catalog.base import obs  # noqa: E402
from tidewright.session import cut_lineage  # noqa: E402


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    spark = local_session()
    base = obs(spark, "/root/testdata/sf0.1")
    many = base.crossJoin(spark.range(copies).withColumnRenamed("id", "copy"))
    hot = F.when(F.col("obs_id") % 3 == 0, F.lit(0)).otherwise(F.col("entity_key"))
    many = many.select((F.col("obs_id") * copies + F.col("copy")).alias("obs_id"), "source", hot.alias("entity_key"),
                       (F.col("ts") + F.make_dt_interval(secs=F.col("copy") * F.lit(7.3))).alias("ts"), "lat", "lon", "speed")
    rows = cut_lineage(many.repartition(32))
    policy = HotKeys(min_rows=rows.count() // 40, max_keys=10_000)
    trials = {
        "sessions": lambda h: sessions(rows, "entity_key", "ts", 60, ["obs_id"], h),
        "check_motion": lambda h: check_motion(rows, "entity_key", "ts", 30.0, tie=["obs_id"], hot=h)
        .withColumn("speed_mps", F.round("speed_mps", 3)),
        "asof_within": lambda h: asof_within(rows, F.col("source") == "click", F.col("source") == "view", ["entity_key"],
                                             "ts", ["ts", "obs_id"], tie=["obs_id"], hot=h),
    }
    for name, fn in trials.items():
        for label, h in (("plain", None), ("cut", policy)):
            start = time.time()
            got = fn(h)
            r = got.agg(F.count(F.lit(1)), checksum(got.columns)).first()
            print(f"{name:14s} {label:6s} {time.time() - start:6.1f}s rows {r[0]} checksum {r[1]}", flush=True)
    for name, df in {
        "dedup": dedup(rows, ["entity_key"], ["ts", "obs_id"]),
        "check_unique": check_unique(rows, ["entity_key"]),
        "interval": interval_correlate(rows.filter("source = 'click'"), rows.filter("source = 'purchase'"), "entity_key", "ts", 0, 30),
    }.items():
        start = time.time()
        n = df.count()
        print(f"{name:14s} {time.time() - start:6.1f}s rows {n}", flush=True)


if __name__ == "__main__":
    main()
