"""Raw sentences to observations and one record per entity.

A line is `!AIVDM,parts,part,sequence,channel,payload,fill*checksum`. Lines that cannot
be used come back as rejects with the stage that refused them; none is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.sixbit import Field
from ..functions.skew import DEFAULT_HOT, Hot
from ..operators.correlate import asof_attach
from ..operators.decode import (ERROR, SENTENCE, check_integrity, decode_bits, reassemble_parts, route_rejects, sane_parts,
                                split_fields)
from ..operators.enrich import lookup, zone_containment
from ..operators.fuse import fuse_attributes
from ..operators.ingest import first_rows, source_inventory
from ..operators.normalize import conform, normalize_text, union_sources, wrap_angles
from ..operators.validate import Rule, apply_rules, check_motion, moved, split_quarantine
from ..schemas import OBS, STATIC
from ..session import cut_lineage
from ..sources.readers import content_id, envelope
from ..streaming.run import python_tasks, run_available
from ..streaming.state import assemble_stream, previous_row_stream
from .layouts import POSITION_REPORT, STATIC_REPORT

FIELDS = (("talker", "string"), ("n_parts", "int"), ("part_no", "int"), ("seq", "string"), ("channel", "string"),
          ("payload", "string"), ("fill", "int"))
TEXTS = ["name", "call_sign", "destination"]
# What the last static report of an entity adds to its record
TOLD = ["name", "kind", "length", "width", "call_sign", "destination"]
MESSAGE_TYPE = (Field("msg_type", 0, 6),)


def decode_sentences(lines: DataFrame, gap_seconds: float = 60, hot: Hot = DEFAULT_HOT) -> dict[str, DataFrame]:
    """Lines (source, received_ts, raw) to tables: obs, static, other (messages of
    types without a layout) and rejects (source, stage, text, error). What a stage has checked
    or decoded is stored, good and bad, so that none works through the lines again."""
    refused = []

    def passed(df: DataFrame, stage: str, text: str) -> DataFrame:
        good, bad = route_rejects(cut_lineage(df))
        refused.append(bad.select("source", F.lit(stage).alias("stage"), F.col(text).alias("text"), "error"))
        return good

    tagged = envelope(lines, F.col("source"), "raw", "received_ts")
    sound = passed(check_integrity(tagged, "raw"), "integrity", "raw")
    body = sound.withColumn("body", F.regexp_extract("raw", SENTENCE, 1))
    parts = passed(split_fields(body, "body", ",", FIELDS), "fields", "raw")
    whole = reassemble_parts(parts, ["source", "channel", "seq"], "received_ts", "part_no", "n_parts", "payload", gap_seconds, hot)
    given = F.array_join(F.transform("parts", lambda p: p["payload"]), "")
    messages = passed(whole.withColumn("given", given), "reassembly", "given")
    typed = passed(decode_bits(messages, "payload", MESSAGE_TYPE), "type", "payload")
    typed = typed.select("source", "started", "payload", "msg_type", content_id(["source", "started", "payload"]).alias("obs_id"))

    kind = F.col("msg_type")
    positions = passed(decode_bits(typed.filter(kind.between(1, 3)), "payload", POSITION_REPORT), "position", "payload")
    statics = passed(decode_bits(typed.filter(kind == 5), "payload", STATIC_REPORT), "static", "payload")
    statics = normalize_text(statics, TEXTS).withColumns({
        "length": F.col("to_bow") + F.col("to_stern"), "width": F.col("to_port") + F.col("to_starboard")})
    return {"obs": conform(wrap_angles(positions, "lon", "course"), OBS, {"ts": "started"}),
            "static": conform(statics, STATIC, {"valid_from": "started"}),
            "other": typed.filter(~kind.between(1, 3) & (kind != 5)),
            "rejects": union_sources(*refused)}


def sentence_picture(lines: DataFrame, rules: Sequence[Rule] = (), priority: Sequence[str] = (), max_speed: float = 100,
                     gap_seconds: float = 60, hot: Hot = DEFAULT_HOT, zones: DataFrame | None = None,
                     zone_cell_m: float = 50_000) -> dict[str, DataFrame]:
    """All stages: the tables of `decode_sentences`, the quarantine of the rules, `inventory`
    of the observations by source, and what `linked_sentences` makes of the valid ones."""
    tables = decode_sentences(lines, gap_seconds, hot)
    valid, quarantine = split_quarantine(apply_rules(tables["obs"], rules), rules)
    motion = check_motion(valid, "entity_key", "ts", max_speed, tie=["obs_id"], hot=hot)
    return {**tables, "quarantine": quarantine, "inventory": source_inventory(tables["obs"], ["source"], "ts", "entity_key"),
            **linked_sentences(motion, tables["static"], priority, hot, zones, zone_cell_m)}


def linked_sentences(motion: DataFrame, static: DataFrame, priority: Sequence[str], hot: Hot = DEFAULT_HOT,
                     zones: DataFrame | None = None, zone_cell_m: float = 50_000) -> dict[str, DataFrame]:
    """Correlation, enrichment and fusion of checked observations: `linked`, each with the
    static report of its entity that was the last at its time (ties: the greatest name);
    with zones also `visits` (obs_id, entity_key, zone_id); and `fused`, one record per
    entity with every attribute of its observations, how many there were, how many moved
    faster than max_speed, what its last static report tells, and with zones `n_zones`,
    how many it was seen in."""
    told = static.select("entity_key", F.col("valid_from").alias("ts"), *TOLD)
    found = {"linked": asof_attach(motion, told, ["entity_key"], "ts", ["ts", *TOLD], prefix="static_", tie=["name"], hot=hot)}
    fused = fuse_sentences(motion, static, priority, hot)
    if zones is not None:
        seen = motion.withColumn("__id", F.struct("obs_id", "entity_key")).select("__id", "lat", "lon")
        found["visits"] = zone_containment(seen, zones, zone_cell_m, id_col="__id").select("__id.*", "zone_id")
        count = (found["visits"].groupBy("entity_key", "zone_id").agg(F.lit(1).alias("__one"))
                 .groupBy("entity_key").agg(F.count(F.lit(1)).alias("n_zones")))
        fused = fused.join(count, "entity_key", "left").withColumn("n_zones", F.coalesce("n_zones", F.lit(0).cast("bigint")))
    return {**found, "fused": fused}


def fuse_sentences(motion: DataFrame, static: DataFrame, priority: Sequence[str], hot: Hot = DEFAULT_HOT) -> DataFrame:
    """One record per entity of checked observations and static reports."""
    fused = fuse_attributes(motion, "entity_key", ["lat", "lon", "speed", "course", "status"], priority, also=[
        F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_reports"), F.count_if("too_fast").alias("n_too_fast")])
    names = first_rows(static, ["entity_key"], [F.desc("valid_from"), F.asc("name")])
    return lookup(fused, names, ["entity_key"], TOLD, hot=hot)


# Columns that each side of the stream keeps, under the names of the batch tables
SIDES = {
    "obs": [*OBS.names, "prev_dist_m", "prev_seconds", "speed_mps", "too_fast"],
    "quarantine": [*OBS.names, "violations"],
    "static": ["entity_key", "ts AS valid_from", *TOLD],
    "other": ["source", "ts AS started", "text AS payload", "msg_type", "obs_id"],
    "rejects": ["source", "stage", "text", "error"],
}


def _stream_messages(lines: DataFrame, gap_seconds: float, watermark: str) -> DataFrame:
    """(source, ts, known, payload, stage, text, error): whole messages, and what was refused
    on the way to them."""
    tagged = envelope(lines.withWatermark("received_ts", watermark), F.col("source"), "raw", "received_ts")
    sound = check_integrity(tagged, "raw").withColumnRenamed(ERROR, "spoiled")
    body = F.when(F.col("spoiled").isNull(), F.regexp_extract("raw", SENTENCE, 1))
    checked = split_fields(sound.withColumn("body", body), "body", ",", FIELDS)
    # explode keeps the checks from being copied into the filters below, which would do them again
    used = ["source", "received_ts", "raw", "spoiled", "n_parts", "part_no", "seq", "channel", "payload", ERROR]
    checked = checked.select("received_ts", F.explode(F.array(F.struct(*[c for c in used if c != "received_ts"]))).alias("__c"))
    checked = checked.select("received_ts", "__c.*")
    broken = F.coalesce("spoiled", ERROR)
    whole = F.coalesce((F.col("part_no") == 1) & (F.col("n_parts") == 1), F.lit(False))
    several = F.coalesce((F.col("n_parts") > 1) & F.col("part_no").between(1, F.col("n_parts")), F.lit(False))
    stage = (F.when(F.col("spoiled").isNotNull(), "integrity").when(F.col(ERROR).isNotNull(), "fields")
             .when(~whole, "reassembly"))
    direct = checked.filter(broken.isNotNull() | ~several).select(
        "source", F.col("received_ts").alias("ts"), F.col("received_ts").alias("known"),
        F.when(stage.isNull(), F.col("payload")).alias("payload"), stage.alias("stage"),
        F.when(broken.isNotNull(), F.col("raw")).otherwise(F.col("payload")).alias("text"),
        F.when(stage.isNotNull(), F.coalesce(broken, F.lit("bad part number"))).alias(ERROR))
    keys = ["source", "channel", "seq"]
    parts = sane_parts(checked.filter(broken.isNull() & several), keys, "received_ts", "part_no", "n_parts", "payload")
    joined = assemble_stream(parts, keys, "received_ts", gap_seconds)
    given = F.array_join(F.transform("parts", lambda p: p["payload"]), "")
    joined = joined.select("source", F.col("started").alias("ts"), "known", "payload",
                           F.when(F.col(ERROR).isNotNull(), "reassembly").alias("stage"), given.alias("text"), ERROR)
    return joined.unionByName(direct)


def _told_apart(messages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Messages decoded in place, each with its `side`; a message has the columns of its side."""
    typed = decode_bits(messages.withColumnRenamed(ERROR, "spoiled"), "payload", MESSAGE_TYPE)
    kind = F.col("msg_type")
    of = lambda which: F.when(F.col("spoiled").isNull() & F.col("untyped").isNull() & which, F.col("payload"))
    typed = typed.withColumnRenamed(ERROR, "untyped").withColumns({
        "__p": of(kind.between(1, 3)), "__s": of(kind == 5),
        "obs_id": content_id(["source", F.col("ts").alias("started"), "payload"])})
    base = [F.col(c) for c in ("source", "ts", "known", "payload", "stage", "text", "spoiled", "untyped", "msg_type", "obs_id", "__p", "__s")]
    positions = decode_bits(typed.select(*base), "__p", [f for f in POSITION_REPORT if f.name != "msg_type"])
    positions = wrap_angles(positions, "lon", "course")
    report = F.when(F.col("__p").isNotNull(), F.struct(*[F.col(f.name) for f in POSITION_REPORT if f.name != "msg_type"], F.col(ERROR)))
    statics = decode_bits(positions.select(*base, F.explode(F.array(report)).alias("position")), "__s",
                          [f for f in STATIC_REPORT if f.name != "msg_type"])
    statics = normalize_text(statics, TEXTS)
    is_position, is_static = F.col("__p").isNotNull(), F.col("__s").isNotNull()
    flat = statics.select(
        "source", "ts", "known", "payload", "msg_type", "obs_id", is_position.alias("is_position"), is_static.alias("is_static"),
        F.coalesce("stage", F.when(F.col("untyped").isNotNull(), "type").when(F.col("position.error").isNotNull(), "position")
                   .when(is_static & F.col(ERROR).isNotNull(), "static")).alias("stage"),
        F.coalesce("spoiled", "untyped", "position.error", F.when(is_static, F.col(ERROR))).alias("error"),
        F.when(F.col("spoiled").isNotNull(), F.col("text")).otherwise(F.col("payload")).alias("text"),
        F.coalesce(F.col("position.entity_key"), F.when(is_static, F.col("entity_key"))).cast("bigint").alias("entity_key"),
        *[F.col(f"position.{c}").cast("double").alias(c) for c in ("lat", "lon", "speed", "course")],
        F.col("position.status").cast("int").alias("status"), "name", F.col("kind").cast("int").alias("kind"),
        (F.col("to_bow") + F.col("to_stern")).cast("double").alias("length"),
        (F.col("to_port") + F.col("to_starboard")).cast("double").alias("width"), "call_sign", "destination")
    ruled = apply_rules(flat, rules)
    held = [r.name for r in rules if r.severity == "error"]
    breaks = F.arrays_overlap("violations", F.array(*[F.lit(n) for n in held])) if held else F.lit(False)
    side = (F.when(F.col("error").isNotNull(), "rejects").when(F.col("is_static"), "static").when(~F.col("is_position"), "other")
            .when(breaks, "quarantine").otherwise("obs"))
    return ruled.withColumn("side", side).drop("is_position", "is_static", "payload")


def run_sentence_stream(lines: DataFrame, out: str, checkpoint: str, rules: Sequence[Rule] = (), max_speed: float = 100,
                        gap_seconds: float = 60, watermark: str = "1 minute", forget_seconds: float | None = None):
    """The stages of `sentence_picture` up to checked observations as one streaming query:
    what has arrived is taken in and stored below `out`, each micro-batch under its id, the
    sides in folders of their own (observations, quarantine, static, other, rejects).

    Two stages keep state under the one watermark: parts wait for the rest of their message
    (`Assembling`), then a position waits until no earlier one of its entity can come
    (`Previous`; two gaps behind the watermark, since a message may take so long). All sides
    go through both, so the source is read once for messages of several parts and once for
    the rest. A stopped or killed run goes on from `checkpoint`; a repeated micro-batch
    replaces its folder. `forget_seconds` drops entities silent for so long from the state;
    their next position then has none before it.
    """
    told = _told_apart(_stream_messages(lines, gap_seconds, watermark), rules)
    chained = F.coalesce((F.col("side") == "obs") & F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.lit(False))
    # rows that have nothing to wait for are spread over many keys
    key = F.when(chained, F.col("entity_key")).otherwise(-1 - F.pmod(F.xxhash64("source", "ts", "text"), F.lit(1024)))
    rows = told.withColumns({"__chained": chained, "__key": key})
    rows = previous_row_stream(rows, "__key", "ts", ["ts", "lat", "lon"], "__chained", "known", ["obs_id"],
                               2 * gap_seconds, forget_seconds, "__prev_")
    rows = moved(rows, F.col("__prev_ts"), F.col("__prev_lat"), F.col("__prev_lon"), "ts", "lat", "lon", max_speed)

    def put(batch: DataFrame, batch_id: int) -> None:
        (batch.drop("known", "__chained", "__key", "__prev_ts", "__prev_lat", "__prev_lon")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("side")
         .parquet(f"{out}/batch_id={batch_id}"))

    return run_available(rows, put, checkpoint, state_tasks=python_tasks(lines.sparkSession))


def stored_sentences(spark: SparkSession, out: str, priority: Sequence[str] = (), hot: Hot = DEFAULT_HOT,
                     zones: DataFrame | None = None, zone_cell_m: float = 50_000) -> dict[str, DataFrame]:
    """The tables of `sentence_picture` over everything taken in so far; `obs` are the
    observations that keep the rules, with their motion."""
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*").drop("batch_id")
    tables = {side: rows.filter(F.col("side") == side).selectExpr(*cols) for side, cols in SIDES.items()}
    return {**tables, **linked_sentences(tables["obs"], tables["static"], priority, hot, zones, zone_cell_m)}
