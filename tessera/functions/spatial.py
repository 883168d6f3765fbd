"""Planar spatial functions on coordinates and on WKT text."""

from __future__ import annotations

import json
import re
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, StringType

_POINT = r"^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$"


def st_point(x: Column, y: Column) -> Column:
    """WKT of a point."""
    return F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))


def st_x(point: Column) -> Column:
    return F.nullif(F.regexp_extract(point, _POINT, 1), F.lit("")).try_cast("double")


def st_y(point: Column) -> Column:
    return F.nullif(F.regexp_extract(point, _POINT, 2), F.lit("")).try_cast("double")


def st_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt(F.pow(ax - bx, F.lit(2)) + F.pow(ay - by, F.lit(2)))


def st_distance_wkt(a: Column, b: Column) -> Column:
    return st_distance(st_x(a), st_y(a), st_x(b), st_y(b))


def st_within_box(x: Column, y: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    return x.between(x0, x1) & y.between(y0, y1)


def _ring(wkt: str) -> list[tuple[float, float]]:
    return [tuple(map(float, p.split())) for p in re.search(r"POLYGON\s*\(\(([^)]*)\)", wkt)[1].split(",")]


def st_within(x: Column, y: Column, polygon: str) -> Column:
    """Whether points lie inside a polygon (WKT, outer ring), by ray casting; points on an edge may go
    either way. A box of the ring's bounds comes first, in plain columns."""
    ring = _ring(polygon)
    xs, ys = zip(*ring)
    inside = F.lit(False)
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if ay == by:
            continue
        crosses = (F.lit(ay) > y) != (F.lit(by) > y)
        at = F.lit(bx - ax) * (y - ay) / F.lit(by - ay) + ax
        inside = inside != (crosses & (x < at))
    return st_within_box(x, y, min(xs), min(ys), max(xs), max(ys)) & inside


def st_contains(polygon: str, x: Column, y: Column) -> Column:
    return st_within(x, y, polygon)


def st_intersects_box(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Whether boxes (x0, y0, x1, y1) share a point."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


@pandas_udf(StringType())
def st_geomfromwkb(wkb: pd.Series) -> pd.Series:
    """WKT of points and polygons in WKB, either byte order; null for other or broken bytes."""

    def one(data: bytes) -> str | None:
        order = "<" if data[:1] == b"\x01" else ">"
        try:
            kind = struct.unpack_from(order + "I", data, 1)[0]
            if kind == 1:
                return "POINT ({!r} {!r})".format(*struct.unpack_from(order + "2d", data, 5))
            if kind != 3:
                return None
            rings, at = [], 9
            for _ in range(struct.unpack_from(order + "I", data, 5)[0]):
                n = struct.unpack_from(order + "I", data, at)[0]
                values = struct.unpack_from(f"{order}{2 * n}d", data, at + 4)
                rings.append("(" + ", ".join(f"{x!r} {y!r}" for x, y in zip(values[::2], values[1::2])) + ")")
                at += 4 + 16 * n
            return f"POLYGON ({', '.join(rings)})"
        except struct.error:
            return None

    return wkb.map(one, na_action="ignore")


@pandas_udf(BinaryType())
def st_asbinary(wkt: pd.Series) -> pd.Series:
    """Little-endian WKB of points and of polygons' outer rings in WKT; null for other texts."""

    def one(text: str) -> bytes | None:
        if m := re.match(_POINT, text):
            return struct.pack("<BI2d", 1, 1, float(m[1]), float(m[2]))
        if not re.match(r"\s*POLYGON", text):
            return None
        ring = _ring(text)
        return struct.pack(f"<BIII{2 * len(ring)}d", 1, 3, 1, len(ring), *[v for p in ring for v in p])

    return wkt.map(one, na_action="ignore")


def spatial_join(points: DataFrame, boxes: DataFrame, x: str, y: str, bounds: tuple[str, str, str, str], size: float) -> DataFrame:
    """Points beside the boxes (columns x0, y0, x1, y1) that hold them: both meet in cells of a grid, so that only neighbours
    are compared. ``size`` should be about a box's width: a box is repeated for every cell that it touches."""
    x0, y0, x1, y1 = (F.col(b) for b in bounds)
    cells = lambda a, b: F.sequence(F.floor(a / size), F.floor(b / size))
    spread = boxes.withColumn("grid_x", F.explode(cells(x0, x1))).withColumn("grid_y", F.explode(cells(y0, y1)))
    placed = points.withColumns({"grid_x": F.floor(F.col(x) / size), "grid_y": F.floor(F.col(y) / size)})
    return placed.join(spread, ["grid_x", "grid_y"]).where(F.col(x).between(x0, x1) & F.col(y).between(y0, y1)).drop("grid_x", "grid_y")


@pandas_udf(StringType())
def st_asgeojson(wkt: pd.Series) -> pd.Series:
    """GeoJSON of points and polygons in WKT."""

    def one(text: str | None) -> str | None:
        if text is None:
            return None
        if m := re.match(_POINT, text):
            return json.dumps({"type": "Point", "coordinates": [float(m[1]), float(m[2])]})
        return json.dumps({"type": "Polygon", "coordinates": [[list(p) for p in _ring(text)]]})

    return wkt.map(one, na_action="ignore")


def grid_cell(x: Column, y: Column, size: float) -> Column:
    """Cell that a spatial index would keep; equal cells are a join's first filter."""
    return F.struct(F.floor(x / size).alias("cx"), F.floor(y / size).alias("cy"))
