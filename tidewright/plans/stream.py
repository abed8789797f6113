"""The same stages on a stream of raw reports.

Each micro-batch is decoded and checked by the batch functions and stored under
its batch id: valid, quarantine and rejects. Linking and fusing need an entity's
whole history, so they are taken from the stored valid rows whenever asked for;
the result is that of a batch run over the same input, in whatever order it came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.deliver import deliver, read_deliveries
from ..operators.validate import apply_rules, split_quarantine
from ..sources.sinks import write_split
from ..streaming.run import run_available
from .batch import Plan, fuse_valid, reports


def run_stream(stream: DataFrame, plan: Plan, out: str, checkpoint: str):
    """Takes in what has arrived: folders valid, quarantine and rejects below `out`.
    `_checked` there holds the micro-batch at hand, so that it is parsed once."""
    def take(batch: DataFrame, batch_id: int) -> None:
        checked = apply_rules(reports(batch), plan.rules)
        good, rejects = write_split(checked, f"{out}/_checked", F.col("error").isNull())
        valid, quarantine = split_quarantine(good.drop("error"), plan.rules)
        deliver(valid, f"{out}/valid", batch_id)
        deliver(quarantine, f"{out}/quarantine", batch_id)
        deliver(rejects.drop("violations"), f"{out}/rejects", batch_id)

    return run_available(stream, take, checkpoint)


def stored_picture(spark: SparkSession, out: str, places: DataFrame, plan: Plan) -> dict[str, DataFrame]:
    """linked and fused over everything taken in so far."""
    return fuse_valid(read_deliveries(spark, f"{out}/valid").drop("batch_id"), places, plan)
