"""Reference enrichment: by key, by key and time, by place."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import BAND, CELL, EARTH_M, Cells, Octs, Quads, haversine_m, in_edges, in_ring
from ..functions.ordered import neighbour_row
from ..functions.skew import (BROADCAST_BYTES, BROADCAST_ROWS, DEFAULT_HOT, Hot, fits_broadcast,
                              unique_lookup)
from ..session import cut_lineage
from .correlate import asof_attach
from .ingest import first_rows


def lookup(df: DataFrame, ref: DataFrame, on: Sequence[str], cols: Sequence[str],
           duplicates: str = "error", order: Sequence[str | Column] = (),
           hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds the reference columns; never changes the number of rows.

    A key that occurs twice in the reference is an error, or with
    duplicates="first" reduced to its first row by `order`. Works on a stream with
    a static reference.
    """
    on = list(on)
    ref = ref.select(*on, *cols, *[c for c in ref.columns if duplicates == "first" and c not in (*on, *cols)])
    if duplicates == "first":
        return unique_lookup(df, first_rows(ref, on, order).select(*on, *cols), on, hot=hot,
                             small=fits_broadcast(ref))
    # one job tells both whether the key is unique and whether the table is small
    shape = (ref.groupBy(*on).agg(F.count(F.lit(1)).alias("n"),
                                  F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b"))
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max_by(F.struct(*on), "n").alias("key"),
                     F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
                .first())
    if shape["most"] > 1:
        raise ValueError(f"reference key is not unique, for example {shape['key'].asDict()}")
    small = shape["n"] <= BROADCAST_ROWS and shape["b"] <= BROADCAST_BYTES
    return unique_lookup(df, ref, on, hot=hot, small=small)


def lookup_valid_time(df: DataFrame, ref: DataFrame, key: str, ts: str, cols: Sequence[str],
                      valid_from: str = "valid_from", valid_to: str = "valid_to", prefix: str = "",
                      hot: Hot = DEFAULT_HOT) -> DataFrame:
    """Adds the reference row whose period [valid_from, valid_to) holds the row's
    time; an open period has no valid_to. Periods of a key must not overlap, which
    is checked. Done as an as-of attach, so long periods cost nothing extra."""
    after = neighbour_row(ref.select(key, valid_from, valid_to).filter(F.col(key).isNotNull()),
                          [key], [valid_from, valid_to], [valid_from], "__next", forward=False, hot=hot)
    nxt = F.col(f"__next.{valid_from}")
    overlap = after.filter(F.col("__next").isNotNull()
                           & (F.col(valid_to).isNull() | (nxt < F.col(valid_to)))).head(1)
    if overlap:
        raise ValueError(f"reference periods overlap, for example {overlap[0].asDict(True)}")
    right = ref.select(key, F.col(valid_from).alias(ts), F.col(valid_to).alias("__to"), *cols)
    found = asof_attach(df, right, [key], ts, ["__to", *cols], prefix="__v_", hot=hot)
    live = F.col("__v___to").isNull() | (F.col(ts) < F.col("__v___to"))
    return found.select(*df.columns, *[F.when(live, F.col(f"__v_{c}")).alias(prefix + c) for c in cols])


def zone_containment(df: DataFrame, zones: DataFrame, cell_m: float, id_col: str = "obs_id",
                     lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(id, zone_id) for every zone polygon that holds the point.

    Zones are listed under the grid cells their box meets; points meet only the
    zones of their own cell and are then tested against the ring. Longitudes of
    points may be any number of turns; a zone across the ±180° line is given either
    with longitudes beyond 180, or with min_x > max_x.
    """
    cells = Cells(cell_m)
    # a box that ends before it begins goes on beyond 180
    over = F.col("min_x") > F.col("max_x")
    west = F.col("min_x")
    zones = (zones.withColumn("ring", F.when(over, F.transform("ring", lambda p: F.struct(
                 F.when(p["x"] < west, p["x"] + 360.0).otherwise(p["x"]).alias("x"), p["y"].alias("y")))).otherwise(F.col("ring")))
             .withColumn("max_x", F.when(over, F.col("max_x") + 360.0).otherwise(F.col("max_x"))))
    listed = cells.cover(zones.select("zone_id", "min_x", "max_x", "min_y", "max_y"),
                         "min_y", "max_y", "min_x", "max_x").select("zone_id", BAND, CELL)
    listed = F.broadcast(listed) if fits_broadcast(listed) else listed
    points = (df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
                .select(F.col(id_col), F.col(lat).alias("__y"), F.col(lon).alias("__x")))
    met = cells.place(points, "__y", "__x").join(listed, [BAND, CELL]).drop(BAND, CELL)
    shapes = zones.select("zone_id", "ring", "min_x", "max_x", "min_y", "max_y")
    shapes = F.broadcast(shapes) if fits_broadcast(shapes) else shapes
    # the point's longitude in the turn that begins where the box does
    x, y = F.pmod(F.col("__x") - F.col("min_x"), F.lit(360.0)) + F.col("min_x"), F.col("__y")
    near = met.join(shapes, "zone_id").withColumn("__x", F.when(
        F.col("__x").between(F.col("min_x"), F.col("max_x")), F.col("__x")).otherwise(x))
    box = F.col("__x").between(F.col("min_x"), F.col("max_x")) & y.between(F.col("min_y"), F.col("max_y"))
    return near.filter(box).filter(in_ring(F.col("__x"), y, F.col("ring"))).select(id_col, "zone_id")


def zone_containment_wide(df: DataFrame, zones: DataFrame, depth: int = 6, id_col: str = "obs_id", lat: str = "lat",
                          lon: str = "lon") -> DataFrame:
    """The rows of `zone_containment`, for zones of any and very different sizes: (id, zone_id).

    Zones are covered by a quadtree of cells, large ones inside and small ones along the
    outline, so a zone costs some hundred rows whether it is a harbour or an ocean. Points
    meet the cells that are their ancestors on the levels in use. Inside cells need no test;
    the others bring the few edges that matter in them, so rings are joined to nothing.
    Points without a position are in no zone. Building the cover stores `depth` small tables.
    """
    over = F.col("min_x") > F.col("max_x")
    west = F.col("min_x")
    # longitudes of a zone from one that lies in [-180, 180) on; beyond 180 if it goes over the line
    base = F.pmod(west + 180.0, F.lit(360.0)) - 180.0 - west
    x_of = lambda p: F.when(over & (p["x"] < west), p["x"] + 360.0).otherwise(p["x"]) + base
    ring = F.transform("ring", lambda p: F.struct(x_of(p).alias("x"), p["y"].alias("y")))
    shapes = zones.filter(F.size("ring") > 0).select(
        "zone_id", ring.alias("ring"), (west + base).alias("min_x"),
        (F.when(over, F.col("max_x") + 360.0).otherwise(F.col("max_x")) + base).alias("max_x"), "min_y", "max_y")
    ahead = F.concat(F.slice("ring", 2, F.size("ring")), F.slice("ring", 1, 1))
    edges = F.transform(F.arrays_zip(F.col("ring").alias("a"), ahead.alias("b")), lambda e: F.struct(
        e["a"]["x"].alias("ax"), e["a"]["y"].alias("ay"), e["b"]["x"].alias("bx"), e["b"]["y"].alias("by")))
    cells = cut_lineage(Quads.cover(shapes.withColumn("edges", edges).drop("ring"), depth))
    levels = sorted(r[0] for r in cells.select("level").distinct().collect())  # at most Quads.LEVELS numbers
    near = F.when(F.col(lon).between(-180.0, 179.999999999), F.col(lon)).otherwise(F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0)
    points = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(id_col), F.col(lat).alias("__y"), near.alias("__x"))
    ancestors = F.array(*[Quads.of_point(F.lit(level), F.col("__y"), F.col("__x")) for level in levels]).cast("array<bigint>")
    points = points.withColumn("cell", F.explode(ancestors))
    cells = F.broadcast(cells) if fits_broadcast(cells) else cells
    held = F.col("edges").isNull() | in_edges(F.col("__x") + F.col("turn"), F.col("__y"), F.col("edges"))
    return points.join(cells, "cell").filter(held).select(id_col, "zone_id")


GLOBE = 21_000_000.0  # more than half the way around


def nearest_any(df: DataFrame, ref: DataFrame, k: int, id_col: str = "obs_id", ref_id: str = "ref_id", lat: str = "lat",
                lon: str = "lon", start_m: float | None = None) -> DataFrame:
    """The k nearest reference points of each row, however far: (id, ref_id, dist_m, rank),
    ties by ref_id; ids are unique, and fewer come back only where the reference has fewer.
    `nearest_reference` without a bound: what it looks at goes by how many reference points
    there are beside a row, so `start_m`, where a search by rings would begin, plays no part.
    """
    return nearest_reference(df, ref, k, GLOBE, id_col, ref_id, lat, lon)


FIRST = 3  # level of space at which the search begins: some hundred cells
FEW = 16   # candidates beside k that are tried one by one
SLACK = 1e-9  # of chords on the unit sphere, for rounding: six millimetres


def nearest_reference(df: DataFrame, ref: DataFrame, k: int, max_m: float, id_col: str = "obs_id",
                      ref_id: str = "ref_id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The k nearest reference points within max_m of each row: (id, ref_id,
    dist_m, rank), ties by ref_id.

    Cells of rows meet cells of reference points, from large ones to small ones: of a cell's
    partners only those stay that may hold one of the k nearest of some row in it, told by
    the boxes around their points. A cell with few candidates left is done, the others are
    cut into smaller ones. So a row tries some dozen points wherever it lies and
    however many there are. Each level is stored; of reference points at one place only
    the first k are kept.
    """
    cap = 4.0 if max_m >= GLOBE else (2 * math.sin(min(max_m / EARTH_M, math.pi) / 2) + SLACK) ** 2
    points = Octs.place(df.select(F.col(id_col), F.col(lat).alias("__lat"), F.col(lon).alias("__lon")), "__lat", "__lon")
    points = cut_lineage(points.select(id_col, "__lat", "__lon", "__x", "__y", "__z", "__code"))
    spots = ref.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.col(ref_id), F.col(lat).alias("__lat2"), F.col(lon).alias("__lon2"))
    first = Window.partitionBy("__lat2", "__lon2").orderBy(ref_id)
    spots = spots.withColumn("__k", F.row_number().over(first)).filter(F.col("__k") <= k).drop("__k")
    spots = cut_lineage(Octs.place(spots, "__lat2", "__lon2"))

    def beside(pairs: DataFrame) -> DataFrame:
        """Pairs of cells (q, r) that may be needed, with the squared chord within which
        every row of q has its k nearest, and how many candidates q has."""
        near, far = Octs.apart("q_box", "r_box")
        pairs = pairs.select("q", "r", "q_n", "r_n", near.alias("near"), far.alias("far")).filter(F.col("near") <= cap)
        q = Window.partitionBy("q")
        upto = F.sum("r_n").over(q.orderBy("far").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        pairs = pairs.withColumn("upto", upto)
        pairs = pairs.withColumn("within", F.least(F.coalesce(F.min(F.when(F.col("upto") >= k, F.col("far"))).over(q), F.lit(4.0)), F.lit(cap)))
        pairs = pairs.filter(F.sqrt("near") <= F.sqrt("within") + SLACK)
        return pairs.withColumn("left", F.sum("r_n").over(q)).select("q", "r", "q_n", "within", "left")

    level, found = FIRST, None
    pairs = Octs.boxes(points, level, "q").crossJoin(F.broadcast(Octs.boxes(spots, level, "r")))
    while True:
        pairs = cut_lineage(beside(pairs))
        few = (F.col("left") <= k + FEW) | (F.col("left") * F.col("q_n") <= 64 * FEW) | F.lit(level == Octs.LEVELS)
        counts = pairs.agg(F.count_if(few).alias("done"), F.count_if(~few).alias("open")).first()
        if counts["done"]:
            near = _tried(points, spots, pairs.filter(few), level, id_col, ref_id)
            found = near if found is None else found.unionByName(near)
        if not counts["open"]:
            break
        up, level = F.shiftright("cell", 3), level + 1
        cells = [Octs.boxes(side, level, name).withColumnRenamed(name, "cell").withColumn("__" + name, up)
                 for side, name in ((points, "q"), (spots, "r"))]
        pairs = pairs.filter(~few).select(F.col("q").alias("__q"), F.col("r").alias("__r"))
        pairs = (pairs.join(cells[0].withColumnRenamed("cell", "q"), "__q")
                 .join(cells[1].withColumnRenamed("cell", "r"), "__r").drop("__q", "__r"))
    if found is None:
        found = points.crossJoin(spots).select(id_col, ref_id, F.lit(0.0).alias("dist_m")).limit(0)
    near = found.filter(F.col("dist_m") <= max_m)
    w = Window.partitionBy(id_col).orderBy("dist_m", ref_id)
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _tried(points: DataFrame, spots: DataFrame, pairs: DataFrame, level: int, id_col: str, ref_id: str) -> DataFrame:
    """(id, ref_id, dist_m) of the rows in the cells of one level and their candidates."""
    within = 2 * EARTH_M * F.asin(F.least(F.sqrt("within") / 2 + SLACK, F.lit(1.0)))
    there = spots.select(Octs.at(level).alias("r"), ref_id, "__lat2", "__lon2")
    there = pairs.select("q", "r", within.alias("__within")).join(there, "r").drop("r")
    here = points.select(Octs.at(level).alias("q"), id_col, "__lat", "__lon")
    cells = pairs.select("q").distinct()
    if fits_broadcast(cells):  # rows of other levels are not shuffled
        here = here.join(F.broadcast(cells), "q", "left_semi")
    there = F.broadcast(there) if fits_broadcast(there) else there
    dist = haversine_m(F.col("__lat"), F.col("__lon"), F.col("__lat2"), F.col("__lon2"))
    return here.join(there, "q").select(id_col, ref_id, dist.alias("dist_m"), "__within").filter(
        F.col("dist_m") <= F.col("__within") + 1.0).drop("__within")
