"""Angles, distances and grid cells as columns. Degrees in, metres out."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

EARTH_M = 6_371_008.8          # mean radius
METRES_PER_DEGREE = EARTH_M * math.pi / 180


def wrap_lon(lon: Column) -> Column:
    """To [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def wrap_course(course: Column) -> Column:
    """To [0, 360)."""
    return F.pmod(course, F.lit(360.0))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the sphere; null if any of the four is null."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    s1 = F.sin((p2 - p1) / 2)
    s2 = F.sin(F.radians(lon2 - lon1) / 2)
    a = s1 * s1 + F.cos(p1) * F.cos(p2) * s2 * s2
    return 2 * EARTH_M * F.asin(F.sqrt(F.when(a > 1.0, F.lit(1.0)).otherwise(a)))  # least() would pass over a null


BAND, CELL = "__band", "__cell"


class Cells:
    """Latitude bands, each cut into longitude cells at least `cell_m` wide.

    A band is `cell_m` high; its cells are sized at the band edge nearest a pole,
    so any circle of radius <= cell_m meets few cells at every latitude, and the
    cells of a band close around the ±180° line.
    """

    def __init__(self, cell_m: float):
        self.cell_m = cell_m
        self.step = cell_m / METRES_PER_DEGREE
        self.bands = max(1, math.ceil(180.0 / self.step))

    def band(self, lat: Column) -> Column:
        return F.least(F.greatest(F.floor((lat + 90.0) / self.step), F.lit(0)),
                       F.lit(self.bands - 1)).cast("int")

    def per_band(self, band: Column) -> Column:
        low = F.abs(band * self.step - 90.0)
        high = F.abs((band + 1) * self.step - 90.0)
        narrow = F.cos(F.radians(F.least(F.greatest(low, high), F.lit(90.0))))
        return F.greatest(F.lit(1), F.floor(narrow * 360.0 / self.step)).cast("int")

    def lon_cell(self, lon: Column, n: Column) -> Column:
        """Cell number before wrapping: may be < 0 or >= n."""
        return F.floor((lon + 180.0) / 360.0 * n).cast("int")

    def _cells(self, df: DataFrame, first: Column, last: Column) -> DataFrame:
        """One row per cell first..last of the row's band, wrapped around the globe."""
        n = self.per_band(F.col(BAND))
        run = F.sequence(first, F.least(last, first + n - 1))
        return (df.withColumn("__run", F.explode(run))
                  .withColumn(CELL, F.pmod(F.col("__run"), n)).drop("__run"))

    def place(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """Adds the one cell the point lies in."""
        df = df.withColumn(BAND, self.band(F.col(lat)))
        n = self.per_band(F.col(BAND))
        return df.withColumn(CELL, F.pmod(self.lon_cell(F.col(lon), n), n))

    def reach(self, df: DataFrame, lat: str, lon: str, radius_m: float) -> DataFrame:
        """One row per cell that a circle around the point can meet."""
        angle = radius_m / EARTH_M
        dlat = math.degrees(angle) + 1e-9
        y, x = F.col(lat), F.col(lon)
        # widest longitude reach of the circle; the whole band once it holds a pole
        ratio = math.sin(min(angle, math.pi / 2)) / F.cos(F.radians(y))
        dlon = F.when((F.abs(y) + dlat >= 90.0) | (ratio >= 1.0), F.lit(180.0)) \
                .otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-9)
        df = df.withColumn(BAND, F.explode(F.sequence(self.band(y - dlat), self.band(y + dlat))))
        n = self.per_band(F.col(BAND))
        return self._cells(df, self.lon_cell(x - dlon, n), self.lon_cell(x + dlon, n))

    def cover(self, df: DataFrame, min_lat: str, max_lat: str, min_lon: str, max_lon: str) -> DataFrame:
        """One row per cell that the row's box meets (min_lon <= max_lon)."""
        df = df.withColumn(BAND, F.explode(F.sequence(self.band(F.col(min_lat)), self.band(F.col(max_lat)))))
        n = self.per_band(F.col(BAND))
        return self._cells(df, self.lon_cell(F.col(min_lon), n), self.lon_cell(F.col(max_lon), n))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether the point lies in the closed ring of {x, y} points (even-odd rule;
    an edge counts its lower end and not its upper end, so shared and horizontal
    edges are counted once)."""
    ahead = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    edges = F.arrays_zip(ring.alias("a"), ahead.alias("b"))

    def crosses(e: Column) -> Column:
        ax, ay = e["a"]["x"], e["a"]["y"]
        bx, by = e["b"]["x"], e["b"]["y"]
        spans = (ay > y) != (by > y)
        at = ax + (y - ay) * (bx - ax) / F.when(by == ay, F.lit(1.0)).otherwise(by - ay)
        return spans & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def in_edges(x: Column, y: Column, edges: Column) -> Column:
    """`in_ring` over an array of edges {ax, ay, bx, by}."""
    def crosses(e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        at = e["ax"] + (y - e["ay"]) * (e["bx"] - e["ax"]) / F.when(e["by"] == e["ay"], F.lit(1.0)).otherwise(e["by"] - e["ay"])
        return spans & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


class Quads:
    """Cells of all sizes: level L cuts longitude and latitude into 2^L parts each, and a
    cell's four children are on the next level. A cell is one number, so a point meets a
    cell of any level by equality with its ancestor there."""

    LEVELS = 24

    @staticmethod
    def number(level: Column, x: Column, y: Column) -> Column:
        return F.shiftleft(level.cast("bigint"), 56) + F.shiftleft(x.cast("bigint"), 28) + y.cast("bigint")

    @staticmethod
    def across(level: Column) -> Column:
        """Cells of a level side by side."""
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), level.cast("int"))

    @staticmethod
    def of_point(level: Column, lat: Column, lon: Column) -> Column:
        """The cell of a level that holds the point; lon in [-180, 180)."""
        n = Quads.across(level)
        clip = lambda c: F.least(F.greatest(c, F.lit(0)), n - 1)
        return Quads.number(level, clip(F.floor((lon + 180.0) / 360.0 * n)), clip(F.floor((lat + 90.0) / 180.0 * n)))

    @staticmethod
    def cover(zones: DataFrame, depth: int) -> DataFrame:
        """(zone_id, cell, level, turn, edges): cells that make up each zone. `zones` has
        zone_id, edges and the box (min_x <= max_x, from -180 on). Cells wholly inside have
        no edges; those the outline touches have the edges a ray from them to the east can
        meet, and longitudes of such a cell are `turn` degrees behind its zone's.

        Cells begin at the size of the box and are cut where the outline runs, `depth`
        times: their number goes by the shape of the outline, not by the size of the zone.
        """
        width = F.greatest((F.col("max_x") - F.col("min_x")) / 360.0, (F.col("max_y") - F.col("min_y")) / 180.0)
        level = F.greatest(F.lit(0), F.least(F.lit(Quads.LEVELS - depth), F.floor(-F.log2(F.greatest(width, F.lit(1e-9)))))).cast("int")
        zones = zones.withColumn("level", level)
        n = Quads.across(F.col("level"))
        first = lambda c, low, size: F.floor((F.col(c) - low) / size * n).cast("bigint")
        rows = F.sequence(F.greatest(first("min_y", -90.0, 180.0), F.lit(0)), F.least(first("max_y", -90.0, 180.0), n - 1))
        cells = (zones.withColumn("x", F.explode(F.sequence(first("min_x", -180.0, 360.0), first("max_x", -180.0, 360.0))))
                 .withColumn("y", F.explode(rows)).select("zone_id", "edges", "level", "x", "y"))
        done = []
        for step in range(depth + 1):
            n = Quads.across(F.col("level"))
            cells = cells.withColumns({"x0": F.col("x") / n * 360.0 - 180.0, "x1": (F.col("x") + 1) / n * 360.0 - 180.0,
                                       "y0": F.col("y") / n * 180.0 - 90.0, "y1": (F.col("y") + 1) / n * 180.0 - 90.0})
            here = F.filter("edges", lambda e: (F.greatest(e["ay"], e["by"]) >= F.col("y0")) & (F.least(e["ay"], e["by"]) <= F.col("y1"))
                            & (F.greatest(e["ax"], e["bx"]) >= F.col("x0")))
            cells = cells.withColumn("edges", here)
            inside = in_edges((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, F.col("edges"))
            state = F.when(F.exists("edges", _touches), "outline").when(inside, "inner").otherwise("outside")
            cells = cut_lineage(cells.withColumn("state", state).filter("state <> 'outside'").drop("x0", "x1", "y0", "y1"))
            done.append(cells.filter(F.lit(True) if step == depth else F.col("state") == "inner"))
            four = F.array(*[F.struct((F.col("x") * 2 + i).alias("x"), (F.col("y") * 2 + j).alias("y")) for i in (0, 1) for j in (0, 1)])
            cells = (cells.filter("state = 'outline'").withColumn("__c", F.explode(four))
                     .select("zone_id", "edges", (F.col("level") + 1).alias("level"), "__c.x", "__c.y"))
        found = done[0]
        for part in done[1:]:
            found = found.unionByName(part)
        n = Quads.across(F.col("level"))
        return found.select("zone_id", Quads.number(F.col("level"), F.pmod(F.col("x"), n), F.col("y")).alias("cell"), "level",
                            (F.floor(F.col("x") / n) * 360.0).cast("double").alias("turn"),
                            F.when(F.col("state") == "outline", F.col("edges")).alias("edges"))


class Octs:
    """Cells of all sizes in space, for points as unit vectors: level L cuts each axis into
    2^L parts. A cell's number interleaves the three, so its parent is the number shifted by
    three bits. No cell is special at the poles or at the ±180° line."""

    LEVELS = 20

    @staticmethod
    def place(df: DataFrame, lat: str, lon: str) -> DataFrame:
        """Adds __x, __y, __z and the point's cell on the last level, __code; points without
        a position are left out."""
        p, l = F.radians(F.col(lat)), F.radians(F.col(lon))
        at = df.withColumns({"__x": F.cos(p) * F.cos(l), "__y": F.cos(p) * F.sin(l), "__z": F.sin(p)})
        at = at.filter(~F.isnan("__x") & ~F.isnan("__y") & ~F.isnan("__z")
                       & F.col("__x").isNotNull() & F.col("__y").isNotNull() & F.col("__z").isNotNull())
        n = 1 << Octs.LEVELS

        def spread(c: str) -> Column:
            v = F.least(F.greatest(F.floor((F.col(c) + 1) / 2 * n), F.lit(0)), F.lit(n - 1)).cast("bigint")
            for shift, mask in ((32, 0x1f00000000ffff), (16, 0x1f0000ff0000ff), (8, 0x100f00f00f00f00f),
                                (4, 0x10c30c30c30c30c3), (2, 0x1249249249249249)):
                v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
            return v

        return at.withColumn("__code", spread("__x").bitwiseOR(F.shiftleft(spread("__y"), 1)).bitwiseOR(F.shiftleft(spread("__z"), 2)))

    @staticmethod
    def at(level: int) -> Column:
        """The cell of a level that holds the point."""
        return F.shiftright("__code", 3 * (Octs.LEVELS - level))

    @staticmethod
    def boxes(placed: DataFrame, level: int, name: str) -> DataFrame:
        """(name, name_n, name_box) of the cells of a level that hold points: how many, and the box around them."""
        sides = [f(c).alias(f"{c}{i}") for c in ("x", "y", "z") for i, f in ((0, lambda c: F.min(f"__{c}")), (1, lambda c: F.max(f"__{c}")))]
        found = placed.groupBy(Octs.at(level).alias(name)).agg(F.count(F.lit(1)).alias(f"{name}_n"), *sides)
        return found.select(name, f"{name}_n", F.struct("x0", "x1", "y0", "y1", "z0", "z1").alias(f"{name}_box"))

    @staticmethod
    def apart(a: str, b: str) -> tuple[Column, Column]:
        """Least and greatest squared chord between points of two boxes."""
        near, far = [], []
        for c in ("x", "y", "z"):
            gap = F.greatest(F.col(f"{a}.{c}0") - F.col(f"{b}.{c}1"), F.col(f"{b}.{c}0") - F.col(f"{a}.{c}1"), F.lit(0.0))
            span = F.greatest(F.col(f"{a}.{c}1") - F.col(f"{b}.{c}0"), F.col(f"{b}.{c}1") - F.col(f"{a}.{c}0"))
            near.append(gap * gap)
            far.append(span * span)
        return near[0] + near[1] + near[2], far[0] + far[1] + far[2]


def _touches(e: Column) -> Column:
    """Whether an edge may meet the closed box x0..x1, y0..y1: their boxes meet, and the
    corners do not all lie on one side of the edge's line."""
    x0, x1, y0, y1 = (F.col(c) for c in ("x0", "x1", "y0", "y1"))
    meet = ((F.greatest(e["ax"], e["bx"]) >= x0) & (F.least(e["ax"], e["bx"]) <= x1)
            & (F.greatest(e["ay"], e["by"]) >= y0) & (F.least(e["ay"], e["by"]) <= y1))
    side = lambda x, y: (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    sides = [side(x, y) for x in (x0, x1) for y in (y0, y1)]
    return meet & (F.least(*sides) <= 1e-9) & (F.greatest(*sides) >= -1e-9)
