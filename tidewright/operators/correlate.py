"""Correlation: what belongs together in time, in place, and across sources."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import BAND, CELL, EARTH_M, Cells, haversine_m
from ..functions.ordered import CHUNK, OrderedCut, running_last
from ..functions.skew import COLUMN, COPIES, CROWD, DEFAULT_HOT, ROW, Hot, fits_broadcast, spread_crowds, unique_lookup
from ..functions.timecols import bucket, micros, seconds_between
from ..session import cut_lineage
from .ingest import first_rows

TASK_ROWS = 250_000


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns})


def interval_correlate(a: DataFrame, b: DataFrame, on: str, ts: str, before: float, after: float,
                       how: str = "inner", prefix: str = "right_", watermark: str | None = None,
                       crowd: int | None = CROWD) -> DataFrame:
    """Rows of `b` for the same entity within [ts - before, ts + after] seconds of
    a row of `a`; how = inner, left, left_semi or left_anti. Columns of `b` get the
    prefix.

    In batch the join key is (entity, time bucket): a row of `a` is in one bucket,
    a row of `b` is copied to the one or two buckets it can match. So an entity
    holding very many rows is spread over its buckets, and no pair is tried that is
    more than two bucket widths apart. Buckets with more than `crowd` rows of one side
    are cut into parts (`spread_crowds`; the other kinds than inner cut rows of `a`
    only, and a bucket crowded with rows of `b` is left to adaptive execution). None
    saves the counts where no bucket can be crowded. Streams join on the entity with
    both sides' watermarks, which bound the state.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"rows of b stand in several buckets, so a {how} join cannot tell its unmatched rows")
    right = prefixed(b, prefix)
    rts = prefix + ts
    same = F.col(on) == F.col(prefix + on)
    if a.isStreaming or b.isStreaming:
        left = a.withWatermark(ts, watermark)
        right = right.withWatermark(rts, watermark)
        near = F.expr(f"{rts} >= {ts} - interval {round(before * 1e6)} microseconds "
                      f"AND {rts} <= {ts} + interval {round(after * 1e6)} microseconds")
        return left.join(right, same & near, how)
    width = max(float(before + after), 1.0)
    left = a.withColumn("__b", bucket(ts, width))
    spread = F.sequence(bucket(rts, width, -after), bucket(rts, width, before))
    right = right.withColumn("__rb", F.explode(spread))
    left, right = spread_crowds(left, right, [on, "__b"], [prefix + on, "__rb"], crowd, both=how == "inner")
    right = right.withColumnsRenamed({ROW: "__r_row", COLUMN: "__r_column"})
    same = same & (F.col("__b") == F.col("__rb")) & (F.col(ROW) == F.col("__r_row")) & (F.col(COLUMN) == F.col("__r_column"))
    gap = micros(rts) - micros(ts)
    near = gap.between(round(-before * 1e6), round(after * 1e6))
    return left.join(right, same & near, how).drop("__b", "__rb", ROW, COLUMN, "__r_row", "__r_column")


def asof_attach(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, cols: Sequence[str],
                tolerance: float | None = None, prefix: str = "right_", tie: Sequence[str] = (),
                hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Each left row with the last right row of the same keys at or before its
    time (`tie` orders right rows of one instant); null if none, or if older than
    `tolerance` seconds. One shuffle of both sides together; keys with very many
    rows are cut along time. Null keys match nothing."""
    value = [on, *tie, *[c for c in cols if c != on and c not in tie]]
    packed = right.select(*by, on, F.struct(*value).alias("__r"))
    rows = (left.withColumn("__left", F.lit(True))
                .unionByName(packed.withColumn("__left", F.lit(False)), allowMissingColumns=True))
    return _last_right(rows, left.columns, by, on, cols, tolerance, prefix, tie, hot)


def asof_within(df: DataFrame, is_left: Column, is_right: Column, by: Sequence[str], on: str,
                cols: Sequence[str], tolerance: float | None = None, prefix: str = "right_",
                tie: Sequence[str] = (), hot: Hot = DEFAULT_HOT) -> DataFrame:
    """`asof_attach` between two kinds of rows of one table, read once. A row of
    both kinds counts as left."""
    value = [on, *tie, *[c for c in cols if c != on and c not in tie]]
    rows = df.withColumn("__left", F.coalesce(is_left, F.lit(False)))
    rows = rows.filter(F.col("__left") | is_right).withColumn("__r", F.when(~F.col("__left"), F.struct(*value)))
    return _last_right(rows, df.columns, by, on, cols, tolerance, prefix, tie, hot)


def _last_right(rows, keep, by, on, cols, tolerance, prefix, tie, hot) -> DataFrame:
    by = list(by)
    keyed = F.col(on).isNotNull()
    for k in by:
        keyed = keyed & F.col(k).isNotNull()
    rows = rows.filter(keyed | F.col("__left")).withColumns(
        {"__r": F.when(keyed, F.col("__r")), **{f"__o{i}": F.col(f"__r.{c}") for i, c in enumerate(tie)}})
    ties = [f"__o{i}" for i in range(len(tie))]
    found = running_last(rows, by, [on, "__left", *ties], "__r", "__m", [on, *ties], hot=hot)
    ok = keyed
    if tolerance is not None:
        ok = ok & (micros(F.col(on)) - micros(F.col(f"__m.{on}")) <= round(tolerance * 1e6))
    return found.filter("__left").select(
        *keep, *[F.when(ok, F.col(f"__m.{c}")).alias(prefix + c) for c in cols])


def proximity_pairs(a: DataFrame, b: DataFrame, window: float, max_m: float, id_col: str = "obs_id",
                    ts: str = "ts", lat: str = "lat", lon: str = "lon", ordered: bool = False,
                    crowd: int | None = CROWD, left_cols: Sequence[str] = (), right_cols: Sequence[str] = ()) -> DataFrame:
    """Pairs no more than `window` seconds and `max_m` metres apart, as
    left_id, right_id, dt_seconds, dist_m, score (1 = same place and time).
    `ordered` keeps left_id < right_id, for pairing a table with itself. Pairs carry
    `left_cols` of `a` and `right_cols` of `b` too.

    Space is cut into cells of twice max_m and time into twice the window, so a
    row of `b` (pass the smaller side) is copied about eight times to the cells it
    can reach, and a row of `a` has one cell. Only pairs in a shared cell are
    tried, each once; the shuffle carries ids and positions only. A cell with more
    than `crowd` rows of one side at one time is cut into parts (`spread_crowds`).
    Where one table is paired with itself (the same `a` and `b`, `ordered`), its later
    rows are copied back in time to its earlier ones alone, about five times. Many rows
    go to tasks of about TASK_ROWS, so that these sort them in memory.
    """
    cells, width = Cells(max(2 * max_m, 1.0)), max(2 * window, 1.0)
    itself = ordered and a is b

    def points(df: DataFrame, tail: str, cols: Sequence[str]) -> DataFrame:
        return (df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
                  .select(F.col(id_col).alias("__id" + tail), F.col(ts).alias("__ts" + tail), F.col(lat).alias("__lat" + tail),
                          F.col(lon).alias("__lon" + tail), *[F.col(c).alias(f"__c_{c}{tail}") for c in dict.fromkeys(cols)]))

    # of a table with itself either row may turn out to be the left one
    here = points(a, "1", [*left_cols, *right_cols] if itself else left_cols)
    there = points(b, "2", [*left_cols, *right_cols] if itself else right_cols)
    cell, tasks = [BAND, CELL, "__t"], 1
    if crowd is not None:
        rows = there.count()
        tasks = -(-(rows * COPIES + (rows if itself else here.count())) // TASK_ROWS)
    here = cells.place(here, "__lat1", "__lon1").withColumn("__t", bucket("__ts1", width))
    times = F.sequence(bucket("__ts2", width, -window), bucket("__ts2", width, 0 if itself else window))
    there = cells.reach(there.withColumn("__t", F.explode(times)), "__lat2", "__lon2", max_m)
    here, there = spread_crowds(here, there, cell, cell, crowd, copies=2)
    cell = [*cell, ROW, COLUMN]
    if tasks > int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        here, there = here.repartition(tasks, *cell), there.repartition(tasks, *cell)
    pairs = here.join(there, cell)
    turned = F.col("__id2") < F.col("__id1")
    either = lambda plain, other: F.when(turned, other).otherwise(plain) if itself else plain
    side = lambda c, one, two: either(F.col(c + one), F.col(c + two) if itself else None)
    if itself:
        pairs = pairs.filter((F.col("__id1") != F.col("__id2")) & ((F.col("__ts1") < F.col("__ts2"))
                             | ((F.col("__ts1") == F.col("__ts2")) & (F.col("__id1") < F.col("__id2")))))
    elif ordered:
        pairs = pairs.filter(F.col("__id1") < F.col("__id2"))
    # latitudes that a circle cannot bridge spare most distances; beyond the poles they say nothing
    beyond = (F.abs("__lat1") > 90) | (F.abs("__lat2") > 90)
    pairs = pairs.filter((F.abs(F.col("__lat1") - F.col("__lat2")) <= math.degrees(max_m / EARTH_M) + 1e-9) | beyond)
    pairs = pairs.filter(F.abs(seconds_between("__ts1", "__ts2")) <= window)
    dist = haversine_m(F.col("__lat1"), F.col("__lon1"), F.col("__lat2"), F.col("__lon2"))
    dt = either(seconds_between("__ts1", "__ts2"), seconds_between("__ts2", "__ts1"))
    pairs = pairs.select(side("__id", "1", "2").alias("left_id"), side("__id", "2", "1").alias("right_id"), dt.alias("dt_seconds"),
                         dist.alias("dist_m"), *[side(f"__c_{c}", "1", "2").alias(c) for c in left_cols],
                         *[side(f"__c_{c}", "2", "1").alias(c) for c in right_cols]).filter(F.col("dist_m") <= max_m)
    # a bound of zero lets only zeros through
    apart = (F.col("dist_m") / max_m if max_m else F.lit(0.0)) + (F.abs("dt_seconds") / window if window else F.lit(0.0))
    return pairs.withColumn("score", 1 - apart / 2).select("left_id", "right_id", "dt_seconds", "dist_m", "score",
                                                           *left_cols, *right_cols)


def sessions(df: DataFrame, key: str | Sequence[str], ts: str, gap: float, tie: Sequence[str] = (),
             hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds `session_start`: the first time of the row's track segment. A segment
    ends where the next row of the key is more than `gap` seconds later."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [ts, *tie]
    cut = OrderedCut.of(df, keys, ts, hot)
    w = Window.partitionBy(*cut.by).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    apart = lambda before, now: micros(now) - micros(before) > round(gap * 1e6)
    start = lambda: F.last("__opens", True).over(so_far)
    if cut.cuts is None:
        rows = df.withColumn("__prev", F.lag(ts).over(w))
        rows = rows.withColumn("__opens", F.when(F.col("__prev").isNull() | apart("__prev", ts), F.col(ts)))
        return rows.withColumn("session_start", start()).drop("__prev", "__opens")

    # inside a chunk of a hot key, its first row is open to what the chunks before say
    rows = cut.assign(df, ts).withColumn("__prev", F.lag(ts).over(w))
    alone = F.col("__prev").isNull() & (F.col(CHUNK) < 0)
    rows = rows.withColumn("__opens", F.when(alone | apart("__prev", ts), F.col(ts))).drop("__prev")
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    edges = (rows.filter(F.col(CHUNK) >= 0).groupBy(*cut.by)
             .agg(F.min(ts).alias("__a"), F.max(ts).alias("__b"), F.max("__opens").alias("__in"))
             .withColumn("__before", F.lag("__b").over(chunks))
             .withColumn("__new", F.when(F.col("__before").isNull() | apart("__before", "__a"), F.col("__a")))
             .withColumn("__end", F.coalesce("__in", "__new"))
             .withColumn("__from", F.coalesce("__new", F.last("__end", True).over(
                 chunks.rowsBetween(Window.unboundedPreceding, -1)))))
    done = cut.join_carry(rows.withColumn("session_start", start()), edges, "__from")
    return (done.withColumn("session_start", F.coalesce("session_start", "__from"))
                .drop("__opens", "__from", CHUNK))


def session_spans(df: DataFrame, key: str, ts: str, gap: float, tie: Sequence[str] = (),
                  watermark: str | None = None, hot: Hot = DEFAULT_HOT) -> DataFrame:
    """One row per track segment: key, session_start, last_ts, n_rows. Batch
    segments are combined map-side; streams use Spark's session windows, whose
    state is dropped by the watermark."""
    if df.isStreaming:
        # a row exactly `gap` later still belongs to the segment: windows are half open
        width = f"{round(gap * 1e6) + 1} microseconds"
        return (df.withWatermark(ts, watermark)
                  .groupBy(F.session_window(ts, width).alias("__w"), key)
                  .agg(F.min(ts).alias("session_start"), F.max(ts).alias("last_ts"),
                       F.count(F.lit(1)).alias("n_rows")).drop("__w"))
    return (sessions(df, key, ts, gap, tie, hot).groupBy(key, "session_start")
            .agg(F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_rows")))


def best_scores(pairs: DataFrame, score: str = "score", left: str = "left_id", right: str = "right_id") -> DataFrame:
    """(id, left_best, right_best): the highest score of each id as a left and as a right
    side. Stored; maxima are combined in the tasks that find the pairs, without sorting or
    moving these."""
    ends = F.array(F.struct(F.col(left).alias("id"), F.lit(True).alias("l")), F.struct(F.col(right).alias("id"), F.lit(False).alias("l")))
    top = pairs.select(F.explode(ends).alias("__e"), F.col(score).alias("__s")).groupBy("__e.id", "__e.l").agg(F.max("__s").alias("__s"))
    return cut_lineage(top.groupBy("id").agg(F.max(F.when(F.col("l"), F.col("__s"))).alias("left_best"),
                                             F.max(F.when(~F.col("l"), F.col("__s"))).alias("right_best")))


def best_match(pairs: DataFrame, score: str = "score", left: str = "left_id", right: str = "right_id",
               best: tuple[str, str] | None = None) -> DataFrame:
    """Pairs in which each side is the other's best (highest score, then lowest
    id). Both rankings keep one row per id before their shuffle, so an id with
    very many candidates costs little.

    To rank within a task its pairs are sorted, on disk where they are many. Where pairs
    are far more than ids, find them twice: with `best_scores` of the first time as columns
    of their sides, named in `best` (left's, right's), only pairs that reach them are left
    to compare, and those by lowest ids. The pairs then have no other columns."""
    if best is not None:
        of_left, of_right = (F.col(score).eqNullSafe(F.col(c)) for c in best)
        end = lambda here, other, first: F.struct(F.col(here).alias("id"), F.col(other).alias("other"), F.lit(first).alias("l"))
        ends = F.array(F.when(of_left, end(left, right, True)), F.when(of_right, end(right, left, False)))
        lowest = cut_lineage(pairs.filter(of_left | of_right).select(F.explode(ends).alias("__e"), F.col(score).alias("__s"))
                             .filter(F.col("__e").isNotNull()).groupBy("__e.id", "__e.l")
                             .agg(F.min("__e.other").alias("other"), F.max("__s").alias("__s")))
        one = lowest.filter("l").select(F.col("id").alias(left), F.col("other").alias(right), F.col("__s").alias(score))
        two = lowest.filter("NOT l").select(F.col("other").alias(left), F.col("id").alias(right))
        return one.join(two, [left, right])
    best_left = first_rows(pairs, [left], [F.desc(score), F.asc(right)])
    best_right = first_rows(pairs.select(left, right, score), [right], [F.desc(score), F.asc(left)])
    return best_left.join(best_right.select(left, right), [left, right], "left_semi")


def link_clusters(links: DataFrame, left: str = "left_id", right: str = "right_id",
                  hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Connected ids to one cluster: rows (id, cluster_id), cluster_id being the
    lowest id of the cluster.

    Alternates large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond", 2014), so the number of rounds grows with
    the logarithm of the size, not with the length of a chain; it ends when a round
    changes nothing. Links are computed once, each round is stored; a hub's
    neighbours are never gathered, only its minimum is, and hubs are looked up by
    broadcast.
    """
    linked = cut_lineage(links.filter(F.col(left).isNotNull() & F.col(right).isNotNull()).select(left, right).distinct())
    ids = (linked.select(F.explode(F.array(left, right)).alias("id")).distinct())
    edges = cut_lineage(linked.filter(F.col(left) != F.col(right))
                        .select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")).distinct())

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    # the steps never add edges: small once is small for good
    small = fits_broadcast(edges)

    def look_up(rows: DataFrame, minima: DataFrame, on: str) -> DataFrame:
        return (rows.join(F.broadcast(minima), on) if small
                else unique_lookup(rows, minima, [on], "inner", hot, small=False))

    state = mark(edges)
    while True:
        lowest = (edges.select(F.explode(F.array("lo", "hi")).alias("u"), F.col("lo").alias("low"))
                       .groupBy("u").agg(F.min("low").alias("m")))
        starred = (look_up(edges, lowest.withColumnRenamed("u", "lo"), "lo")
                   .select("hi", F.col("m").alias("lo")).distinct())
        if not small:
            starred = cut_lineage(starred)
        centre = starred.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = (look_up(starred, centre, "hi")
                 .filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        edges = cut_lineage(moved.unionByName(centre.select("hi", F.col("m").alias("lo"))).distinct())
        now = mark(edges)
        if now == state:
            break
        state = now
    return (ids.join(edges.withColumnRenamed("hi", "id"), "id", "left")
               .select("id", F.coalesce("lo", "id").alias("cluster_id")))
