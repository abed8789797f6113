"""The stages put together: raw reports to one record per entity, then out.

`run_batch` returns lazy tables, though hot keys and lookups are counted by small
jobs while it builds them; `store` and `publish` are the actions. The stage order is
fixed: rules see no linked records, and XML is made from the stored final table
alone, so publishing can be repeated without the earlier stages.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.skew import DEFAULT_HOT, HotKeys
from ..functions.timecols import micros
from ..operators.correlate import asof_within
from ..operators.decode import parse_document, route_rejects
from ..operators.deliver import deliver, manifest
from ..operators.enrich import lookup
from ..operators.fuse import fuse_attributes
from ..operators.ledger import Ledger
from ..operators.normalize import conform
from ..operators.validate import Rule, apply_rules, split_quarantine
from ..operators.xml import check_xml, to_xml_column
from ..sources.readers import content_id, envelope
from ..sources.sinks import XML_TIMES, write_final, write_split, xml_ready

CONTRACTS = os.path.join(os.path.dirname(__file__), "contracts")

REPORTS = T.StructType([
    T.StructField("obs_id", T.LongType()),
    T.StructField("raw_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("entity_key", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("k", T.LongType()),
    T.StructField("error", T.StringType()),
])

ENTITY = T.StructType([
    T.StructField("entity_key", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("nation", T.StringType()),
    T.StructField("last_ts", T.TimestampNTZType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("speed_source", T.StringType()),
    T.StructField("n_reports", T.LongType()),
])


@dataclass(frozen=True)
class Plan:
    """What a run needs to know; everything else comes from the data."""

    rules: Sequence[Rule] = ()
    priority: Sequence[str] = ()
    lead_source: str = "view"
    then_source: str = "click"
    within_seconds: float = 7200
    hot: HotKeys = field(default=DEFAULT_HOT)


def reports(raw: DataFrame) -> DataFrame:
    """Ingestion, decoding, normalisation: raw event rows to reports plus `error`."""
    lines = raw.withColumn("__line", F.concat_ws("|", "event_id", "user_id", "event_type", "props"))
    tagged = envelope(lines, F.col("event_type"), "__line", "ts", keep=["event_id", "user_id", "ts", "value", "props"])
    props = T.StructType([T.StructField("k", T.LongType())])
    decoded = parse_document(tagged, "props", props, "json").withColumn("k", F.col("doc.k"))
    return conform(decoded, REPORTS, {"obs_id": "event_id", "entity_key": "user_id", "speed": "value"})


def run_batch(raw: DataFrame, places: DataFrame, plan: Plan) -> dict[str, DataFrame]:
    """All stages up to fusion as lazy tables: rejects, quarantine, linked, fused.

    `places` has one row per entity_key with name and nation.
    """
    good, rejects = route_rejects(reports(raw))
    valid, quarantine = split_quarantine(apply_rules(good, plan.rules), plan.rules)
    return {"rejects": rejects, "quarantine": quarantine, **fuse_valid(valid, places, plan)}


def fuse_valid(valid: DataFrame, places: DataFrame, plan: Plan) -> dict[str, DataFrame]:
    """Correlation, enrichment and fusion of validated reports: linked, fused."""
    linked = correlate_valid(valid, plan)
    return {"linked": linked, "fused": enrich_entities(fuse_linked(valid, linked, plan), places, plan)}


def correlate_valid(valid: DataFrame, plan: Plan) -> DataFrame:
    """Reports of `then_source` with the last one of `lead_source` before them."""
    return asof_within(valid, F.col("source") == plan.then_source, F.col("source") == plan.lead_source,
                       ["entity_key"], "ts", ["ts", "obs_id", "speed"], prefix="lead_", hot=plan.hot)


def fuse_linked(valid: DataFrame, linked: DataFrame, plan: Plan) -> DataFrame:
    """One record per entity, with the number of its links within the time allowed."""
    fused = fuse_attributes(valid, "entity_key", ["speed"], plan.priority,
                            also=[F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_reports")])
    within = micros("ts") - micros("lead_ts") <= int(plan.within_seconds * 1e6)
    followed = linked.groupBy("entity_key").agg(F.count_if(within).alias("n_followed"))
    return (fused.join(followed, "entity_key", "left")
                 .withColumn("n_followed", F.coalesce("n_followed", F.lit(0).cast("bigint"))))


def enrich_entities(entity: DataFrame, places: DataFrame, plan: Plan) -> DataFrame:
    return lookup(entity, places, ["entity_key"], ["name", "nation"], hot=plan.hot)


def store(fused: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    write_final(fused, path, partition_cols)


def publish(spark: SparkSession, final_path: str, out: str, batch_id: str,
            contract: str = os.path.join(CONTRACTS, "entity.xsd"), row_tag: str = "entity",
            root_tag: str = "entities") -> None:
    """Delivers the stored records that the ledger does not know, or knows with other
    content: XML files below `documents`, the same elements one a row below `xml`,
    elements that break the contract below `refused`, keys that have left the table below
    `withdrawn`, and a manifest; the ledger last. Of the ledger only ranges of keys in which
    something differs are read (see `Ledger`).

    A run that dies before the ledger entry repeats the same batch; the same batch
    id replaces its folders. The elements are made and checked once, into
    `_checked`, and read back for the rest, so all outputs tell of the same rows.
    """
    ledger = Ledger(spark, f"{out}/ledger")
    if ledger.is_folded(batch_id):  # long done, and later batches build on it
        return
    stored = spark.read.parquet(final_path)
    told = stored.withColumns({"digest": content_id(ENTITY.names), "record_key": F.col("entity_key").cast("string")})
    changed = ledger.changes(told.select("record_key", "digest"), batch_id)
    todo = told.join(changed.filter("new IS NOT NULL").select("record_key"), "record_key", "left_semi")
    elements = to_xml_column(todo, ENTITY.names, row_tag).select("entity_key", "digest", "xml")
    checked = check_xml(elements, "xml", ENTITY, contract, row_tag).select("entity_key", "digest", "xml", "doc", "error")
    valid, invalid = write_split(checked, f"{out}/_checked", F.col("error").isNull())
    deliver(valid.select("entity_key", "digest", "xml"), f"{out}/xml", batch_id)
    deliver(xml_ready(valid.select("doc.*")), f"{out}/documents", batch_id, "xml", rootTag=root_tag, rowTag=row_tag, **XML_TIMES)
    deliver(invalid.drop("doc", "digest"), f"{out}/refused", batch_id)
    gone = changed.filter("new IS NULL")
    deliver(gone.select("record_key", F.col("old").alias("digest")), f"{out}/withdrawn", batch_id)
    sent = spark.read.parquet(f"{out}/xml/batch_id={batch_id}")
    deliver(manifest(sent, [], batch_id).drop("batch_id"), f"{out}/manifest", batch_id)
    done = sent.select(F.col("entity_key").cast("string").alias("record_key"))
    ledger.record(changed.join(done, "record_key", "left_semi").unionByName(gone), batch_id)
