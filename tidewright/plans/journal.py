"""Batch runs that go on where they stopped.

Each stage is stored below a journal under its name and a mark: a digest of the stage's own
settings and of the marks of what it reads. A stage whose mark is entered is read back, not
computed; the entry is written after the stage's table, so a run that dies leaves either a
whole stage or none. Altered input or settings give new marks from the first stage that sees
them, and leave the stages before it as they are.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.ingest import checksum, row_number
from ..operators.validate import apply_rules, is_held
from ..session import exists, names_in, remove
from .batch import REPORTS, Plan, correlate_valid, enrich_entities, fuse_linked, reports

ENTRY = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("mark", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("done_ts", T.TimestampType()),
])


def mark_of(*what: object) -> str:
    """A digest of texts, marks and settings, each led by its length."""
    texts = [str(w) for w in what]
    return hashlib.sha256("".join(f"{len(t)}:{t}" for t in texts).encode()).hexdigest()[:32]


def file_mark(df: DataFrame) -> str:
    """Tells whether a table read from files has changed: the sum over its files of a digest of
    path, size and time of change. Files are counted in the tasks that list them and no
    column is read; files without rows do not count."""
    seen = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return content_mark(seen)


def content_mark(df: DataFrame) -> str:
    """The same for any table, by its rows, whatever their order: one pass, one row per task
    travels."""
    told = df.agg(F.count(F.lit(1)), checksum(F.coalesce(F.sum(row_number(df)), F.lit(0)))).first()
    return mark_of(df.schema.json(), *told)


class Journal:
    """The stages done below `path`, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        """(stage, mark, schema, n_rows, done_ts) of every stage done, of this and earlier inputs."""
        if not names_in(self.spark, f"{self.path}/entries"):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/entries/*")

    def is_done(self, stage: str, mark: str) -> bool:
        return exists(self.spark, f"{self.path}/entries/{stage}-{mark}/_SUCCESS")

    def table(self, stage: str, mark: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table of a stage; `build` is called only if there is none."""
        place, entry = f"{self.path}/tables/{stage}-{mark}", f"{self.path}/entries/{stage}-{mark}"
        if self.is_done(stage, mark):
            schema = T.StructType.fromJson(json.loads(self.spark.read.schema(ENTRY).parquet(entry).first()["schema"]))
            return self.spark.read.schema(schema).parquet(place)
        rows = build()
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(place)
        stored = self.spark.read.schema(rows.schema).parquet(place)
        told = stored.agg(F.lit(stage).alias("stage"), F.lit(mark).alias("mark"), F.lit(rows.schema.json()).alias("schema"),
                          F.count(F.lit(1)).alias("n_rows"), F.current_timestamp().alias("done_ts"))
        told.coalesce(1).write.mode("overwrite").parquet(entry)
        return stored

    def sides(self, stage: str, mark: str, build: Callable[[], DataFrame], condition: Column) -> tuple[DataFrame, DataFrame]:
        """A stage with two outputs, stored once: (rows where the condition holds, the rest)."""
        stored = self.table(stage, mark, lambda: build().withColumn("__holds", F.coalesce(condition, F.lit(False))))
        return stored.filter("__holds").drop("__holds"), stored.filter("NOT __holds").drop("__holds")

    def sweep(self, keep: Mapping[str, str]) -> list[str]:
        """Removes the stages of other marks than those of a run (stage to mark), entry first,
        tables that never got an entry too. Returns their names."""
        kept = {f"{stage}-{mark}" for stage, mark in keep.items()}
        gone = sorted({*names_in(self.spark, f"{self.path}/entries"), *names_in(self.spark, f"{self.path}/tables")} - kept)
        for name in gone:
            remove(self.spark, f"{self.path}/entries/{name}")
            remove(self.spark, f"{self.path}/tables/{name}")
        return gone


STAGES = ("decode", "validate", "correlate", "fuse", "enrich")


def marks(raw_mark: str, places_mark: str, plan: Plan, code: str = "1") -> dict[str, str]:
    """The mark of each stage. `code` is to be changed with the code of the stages."""
    decode = mark_of(code, "decode", raw_mark, REPORTS.json())
    validate = mark_of(decode, *[(r.name, r.predicate, r.severity) for r in plan.rules])
    correlate = mark_of(validate, "correlate", plan.lead_source, plan.then_source)
    fuse = mark_of(correlate, "fuse", tuple(plan.priority), plan.within_seconds)
    return dict(zip(STAGES, (decode, validate, correlate, fuse, mark_of(fuse, "enrich", places_mark))))


def run_batch_resumed(spark: SparkSession, raw: DataFrame, places: DataFrame, plan: Plan, path: str,
                      raw_mark: str | None = None, places_mark: str | None = None, code: str = "1",
                      until: str = STAGES[-1]) -> dict[str, DataFrame]:
    """`run_batch`, stage by stage through the journal at `path`, up to the stage `until`; run
    it again after whatever ended it. Without marks of the inputs, `raw` must be read from
    files and is told by them, and `places` by its rows. Returns the same tables, stored,
    `valid` too; those of stages not reached are left out."""
    journal, last, done = Journal(spark, path), STAGES.index(until), {}
    mark = marks(raw_mark or file_mark(raw), places_mark or content_mark(places), plan, code)
    good, done["rejects"] = journal.sides("decode", mark["decode"], lambda: reports(raw), F.col("error").isNull())
    if last >= 1:
        done["quarantine"], done["valid"] = journal.sides(
            "validate", mark["validate"], lambda: apply_rules(good.drop("error"), plan.rules), is_held(plan.rules))
    if last >= 2:
        done["linked"] = journal.table("correlate", mark["correlate"], lambda: correlate_valid(done["valid"], plan))
    if last >= 3:
        fused = journal.table("fuse", mark["fuse"], lambda: fuse_linked(done["valid"], done["linked"], plan))
    if last >= 4:
        done["fused"] = journal.table("enrich", mark["enrich"], lambda: enrich_entities(fused, places, plan))
    return done
