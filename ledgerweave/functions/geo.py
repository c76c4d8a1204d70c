"""Polygons written as WKT: parsing, areas and centroids."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rings of less area than this have none.
NO_AREA = 1e-12

Point = tuple[float, float]


def parse_wkt(wkt: str | None) -> list[list[list[Point]]] | None:
    """Polygons, each a list of rings, each a closed list of points; null for anything but POLYGON and MULTIPOLYGON.

    Open rings are closed; rings with fewer than three points are left out.
    """
    if not wkt:
        return None
    m = re.match(r"\s*(MULTI)?POLYGON\s*(?:Z|M|ZM)?\s*(\(.*\))\s*$", wkt, re.I | re.S)
    if not m:
        return None
    body = m.group(2) if m.group(1) else f"({m.group(2)})"
    polygons, rings, depth, start = [], [], 0, 0
    for i, c in enumerate(body):
        if c == "(":
            depth += 1
            if depth == 2:
                rings = []
            elif depth == 3:
                start = i + 1
        elif c == ")":
            if depth == 3:
                points = []
                for pair in body[start:i].split(","):
                    xy = pair.split()
                    try:
                        points.append((float(xy[0]), float(xy[1])))
                    except (ValueError, IndexError):
                        continue
                if points and points[0] != points[-1]:
                    points.append(points[0])
                if len(points) >= 4:
                    rings.append(points)
            elif depth == 2 and rings:
                polygons.append(rings)
            depth -= 1
    return polygons or None


def ring_moments(ring: list[Point]) -> tuple[float, float, float] | None:
    """Signed area and centroid; null where the ring has no area.

    Coordinates are taken from the first point, as small rings far from the origin would else lose their digits.
    """
    area = x = y = 0.0
    left, low = ring[0]
    near = [(px - left, py - low) for px, py in ring]
    for (x0, y0), (x1, y1) in zip(near, near[1:], strict=False):
        cross = x0 * y1 - x1 * y0
        area += cross
        x += (x0 + x1) * cross
        y += (y0 + y1) * cross
    if abs(area / 2) < NO_AREA:
        return None
    return area / 2, left + x / (3 * area), low + y / (3 * area)


def centroid(polygons: list[list[list[Point]]] | None) -> tuple[float | None, float | None, float]:
    """Centroid of the outer rings weighted by area, else the mean of their points; and their area."""
    if not polygons:
        return None, None, 0.0
    parts = [m for m in (ring_moments(rings[0]) for rings in polygons) if m]
    total = sum(abs(a) for a, _, _ in parts)
    if total:
        return sum(abs(a) * x for a, x, _ in parts) / total, sum(abs(a) * y for a, _, y in parts) / total, total
    points = [p for rings in polygons for p in rings[0]]
    return sum(x for x, _ in points) / len(points), sum(y for _, y in points) / len(points), 0.0


_CENTROID = T.StructType([T.StructField(n, T.DoubleType()) for n in ("lon", "lat", "area")] + [T.StructField("polygons", T.IntegerType())])


def centroid_of(c: Column) -> Column:
    """``struct<lon, lat, area, polygons>`` of a WKT column."""

    @F.pandas_udf(_CENTROID)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shapes = [parse_wkt(w) for w in batch]
            yield pd.DataFrame([(*centroid(s), None if s is None else len(s)) for s in shapes], columns=["lon", "lat", "area", "polygons"]).astype({"polygons": "Int32"})

    return of(c)
