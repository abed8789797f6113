"""Parsing and decoding. Bad input never raises: it gives nulls and a reason in
`error`, and `route_rejects` parts the two."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import sixbit
from ..functions.ordered import OrderedCut, neighbour_row, row_numbers, running_last
from ..functions.skew import DEFAULT_HOT, Hot
from ..session import cut_lineage
from .correlate import sessions

ERROR = "error"
TASK_ROWS = 250_000


def _reasons(*conditions):
    return F.nullif(F.concat_ws("; ", *[F.when(c, F.lit(text)) for c, text in conditions]), F.lit(""))


def split_fields(df: DataFrame, col: str, sep: str, layout: Sequence[tuple[str, str]]) -> DataFrame:
    """One delimited line to typed columns; a field that does not fit is null."""
    parts = F.split(F.col(col), re.escape(sep), -1)
    texts = {name: F.get(parts, F.lit(i)) for i, (name, _) in enumerate(layout)}
    typed = {name: texts[name].try_cast(kind) for name, kind in layout}
    bad = [(F.col(col).isNull(), "no text"), (F.size(parts) != len(layout), "wrong number of fields")]
    bad += [(typed[n].isNull() & (F.length(texts[n]) > 0), f"bad {n}") for n, _ in layout]
    return df.withColumns({**typed, ERROR: _reasons(*bad)})


def parse_document(df: DataFrame, col: str, schema: T.StructType, fmt: str, out: str = "doc",
                   **opts) -> DataFrame:
    """A JSON, CSV or XML text column to a struct; unreadable text goes to `error`."""
    parse = {"json": F.from_json, "csv": F.from_csv, "xml": F.from_xml}[fmt]
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    given = full
    if fmt == "csv":
        given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", **opts}
    # explode keeps the parser from being copied into every filter that uses its result
    parsed = df.withColumn("__doc", F.explode(F.array(parse(F.col(col), given, options))))
    return parsed.withColumns({
        out: F.struct(*[F.col(f"__doc.{f.name}") for f in schema.fields]),
        ERROR: F.when(F.col(col).isNull(), "no text")
                .when(F.col("__doc._corrupt").isNotNull(), F.concat(F.lit("unreadable: "), "__doc._corrupt")),
    }).drop("__doc")


# Fixed pattern: start mark, body, star, two hex digits.
SENTENCE = r"^[!$]([^*]*)\*([0-9A-Fa-f]{2})\s*$"


def check_integrity(df: DataFrame, col: str) -> DataFrame:
    """Checks a sentence's XOR checksum against its hex suffix; reason in `error`."""
    body, suffix = F.regexp_extract(col, SENTENCE, 1), F.regexp_extract(col, SENTENCE, 2)
    stated = F.conv(F.nullif(suffix, F.lit("")), 16, 10).cast("int")
    return df.withColumn(ERROR, F.when(F.col(col).isNull() | ~F.col(col).rlike(SENTENCE), "malformed sentence")
                         .when(sixbit.xor_of(body) != stated, "wrong checksum"))


def sane_parts(df: DataFrame, group_keys: Sequence[str], ts: str, part_no: str, n_parts: str, payload: str) -> DataFrame:
    """The columns that reassembly works on, `sane` where the part number can be one."""
    sane = F.coalesce(F.col(part_no).between(1, F.col(n_parts)), F.lit(False))
    return df.select(*group_keys, ts, F.col(part_no).cast("int").alias("part_no"),
                     F.col(n_parts).cast("int").alias("n_parts"), F.col(payload).alias("payload"), sane.alias("sane"))


def lone_parts(parts: DataFrame, keys: Sequence[str], ts: str, extra: Sequence[Column] = ()) -> DataFrame:
    """Messages of one part, and parts with impossible numbers, as rows of their own."""
    alone = F.col("sane") & (F.col("n_parts") == 1)
    return parts.filter(~F.col("sane") | (F.col("n_parts") == 1)).select(
        *keys, "n_parts", F.col(ts).alias("started"), F.col(ts).alias("ended"), F.lit(1).alias("n_present"),
        F.when(alone, F.col("payload")).alias("payload"), F.array(F.struct("part_no", "payload")).alias("parts"),
        F.when(~alone, F.lit("bad part number")).alias(ERROR), *extra)


def _without_copies(rows: DataFrame, keys: list[str], ts: str, cut: OrderedCut, inner: Hot) -> DataFrame:
    """Drops a part that was sent again as it was before its message's last part."""
    place = F.struct(ts, "part_no", "payload")
    rows = neighbour_row(rows, [*keys, "part_no"], [ts, "payload"], [ts, "part_no", "payload", "session_start"], "__same", hot=inner)
    rows = rows.withColumn("__final", F.when(F.col("part_no") == F.col("n_parts"), place))
    rows = running_last(rows, keys, [ts, "part_no", "payload"], "__final", "__done", [ts, "part_no", "payload"], hot=cut)
    before = F.struct(f"__same.{ts}", "__same.part_no", "__same.payload")
    open_still = (F.col("part_no") == F.col("n_parts")) | F.col("__done").isNull() | (F.col("__done") <= before)
    copy = (F.col("__same").isNotNull() & (F.col("__same.session_start") == F.col("session_start"))
            & F.col("payload").eqNullSafe(F.col("__same.payload")) & open_still)
    return rows.filter(~copy).drop("__same", "__final", "__done")


def reassemble_parts(df: DataFrame, group_keys: Sequence[str], ts: str, part_no: str, n_parts: str,
                     payload: str, gap_seconds: float, hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Multi-part messages to one row each: payload joined in part order.

    Parts of one key belong together while they are no further apart than the gap.
    Sequence numbers are used again soon: a part number that is not above the one
    before begins the next message, so a lost part spoils its own message only. A part
    sent again as it was, before its message's last part came, counts once. Pieces
    that lack parts and lie side by side (parts out of order) are put together where
    their numbers fit. Messages still incomplete keep all their parts and say so in
    `error`; part numbers outside 1..n_parts come back as rows of their own, also with
    `error`. No payload is lost. A message is collected into one row, as long as its
    parts are; all else goes by neighbours in time, and hot keys are cut along it.
    """
    keys = [*group_keys, "n_parts"]
    parts = sane_parts(df, group_keys, ts, part_no, n_parts, payload)
    many = parts.filter(F.col("sane") & (F.col("n_parts") > 1)).drop("sane")
    # the steps below sort a task's rows several times over, so tasks get about TASK_ROWS each
    some = many.count()
    if some > TASK_ROWS:
        many = many.repartition(-(-some // TASK_ROWS), *keys)
    cut = OrderedCut.of(many, keys, ts, hot)
    inner = cut.hot if cut.cuts is not None else None  # no part of a key is hot unless the key is
    cut = cut if cut.cuts is not None else None
    order = [ts, "part_no", "payload"]

    # with hot keys each step reads the one before it twice: store it in between
    settled = cut_lineage if cut is not None else lambda rows: rows

    rows = settled(sessions(many, keys, ts, gap_seconds, tie=["part_no", "payload"], hot=cut))
    rows = settled(_without_copies(rows, keys, ts, cut, inner))
    rows = neighbour_row(rows, keys, order, ["part_no", "session_start"], "__before", hot=cut)
    opens = (F.col("__before").isNull() | (F.col("__before.session_start") != F.col("session_start"))
             | (F.col("part_no") <= F.col("__before.part_no")))
    rows = settled(rows.withColumn("__opens", F.when(opens, F.struct(*order))))
    rows = running_last(rows, keys, order, "__opens", "__piece", order, hot=cut)
    found = F.array_sort(F.collect_list(F.struct("part_no", "payload", F.col(ts).alias("at"))))
    pieces = rows.groupBy(*keys, "session_start", "__piece").agg(found.alias("found")).withColumns({
        "__t": F.col(f"__piece.{ts}"), "__p": F.col("__piece.part_no"), "__q": F.col("__piece.payload"),
        "numbers": F.col("found.part_no"), "whole": F.size("found") == F.col("n_parts")})
    order = ["__t", "__p", "__q"]

    pieces = settled(pieces)
    pieces = neighbour_row(pieces, keys, order, ["session_start", "numbers", "whole"], "__before", hot=cut)
    beside = (F.col("__before").isNotNull() & (F.col("__before.session_start") == F.col("session_start"))
              & ~F.col("__before.whole") & ~F.arrays_overlap("__before.numbers", "numbers"))
    pieces = settled(pieces.withColumn("__opens", F.when(~F.col("whole") & ~beside, F.col("__piece"))))
    pieces = settled(running_last(pieces, keys, order, "__opens", "__group", order, hot=cut))

    loose = pieces.filter(~F.col("whole")).select(*keys, "session_start", "__group", F.explode("found").alias("r"))
    loose = loose.select(*keys, "session_start", "__group", "r.*")
    loose = row_numbers(loose, [*keys, "session_start", "__group", "part_no"], ["at", "payload"], "__k", hot=inner)
    fitted = loose.groupBy(*keys, "session_start", "__group", "__k").agg(
        F.array_sort(F.collect_list(F.struct("part_no", "payload", "at"))).alias("found"))
    messages = pieces.filter("whole").select(*keys, "found").unionByName(fitted.select(*keys, "found"))
    full = F.size("found") == F.col("n_parts")
    joined = messages.select(
        *keys, F.array_min("found.at").alias("started"), F.array_max("found.at").alias("ended"), F.size("found").alias("n_present"),
        F.when(full, F.array_join("found.payload", "")).alias("payload"),
        F.transform("found", lambda p: F.struct(p["part_no"].alias("part_no"), p["payload"].alias("payload"))).alias("parts"),
        F.when(~full, F.lit("incomplete")).alias(ERROR))
    return joined.unionByName(lone_parts(parts, group_keys, ts))


def decode_bits(df: DataFrame, col: str, layout: Sequence[sixbit.Field]) -> DataFrame:
    """Six-bit payload to one column per layout field; reason in `error`."""
    text, hexed = F.col(col), F.col("__hex")
    need = -(-max(f.start + f.width for f in layout) // 6)
    fields = {f.name: sixbit.field(text, hexed, f) for f in layout}
    error = (F.when(text.isNull() | (text == ""), "no payload").when(hexed.isNull(), "illegal character")
             .when(F.length(text) < need, "cut short"))
    # explode makes the digits a column of their own, so that every field reads the same ones
    return (df.withColumn("__hex", F.explode(F.array(sixbit.digits(text))))
              .withColumns({**fields, ERROR: error}).drop("__hex"))


def route_rejects(df: DataFrame, error_col: str = ERROR) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): every row is in exactly one, rejects keep their reason.

    Both sides read the same plan; when both are written, write `df` partitioned
    by `error_col IS NULL` once, or persist it, rather than computing it twice.
    """
    good = df.filter(F.col(error_col).isNull()).drop(error_col)
    return good, df.filter(F.col(error_col).isNotNull())
