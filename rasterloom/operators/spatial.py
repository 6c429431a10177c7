"""Polygon masks, tie-point interpolation and map projections as column expressions."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rings_to_edges(rings: list[list[tuple[float, float]]]) -> list[tuple[int, int, float, float, float, float]]:
    """(polygon, seq, x1, y1, x2, y2) of closed rings."""
    return [(p, i, *map(float, ring[i]), *map(float, ring[(i + 1) % len(ring)])) for p, ring in enumerate(rings) for i in range(len(ring))]


def crossings(x: Column, y: Column, edges: list[tuple]) -> Column:
    """How many edges a ray to the right of (x, y) crosses."""
    out = F.lit(0)
    for _, _, x1, y1, x2, y2 in edges:
        if y1 != y2:
            at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
            out = out + F.when(((F.lit(y1) > y) != (F.lit(y2) > y)) & (x < at), 1).otherwise(0)
    return out


def inside(x: Column, y: Column, rings: list[list[tuple[float, float]]]) -> Column:
    """Even-odd membership in any of a few polygons, guarded by each one's bounding box."""
    out = F.lit(False)
    for ring in rings:
        xs, ys = [p[0] for p in ring], [p[1] for p in ring]
        box = x.between(min(xs), max(xs)) & y.between(min(ys), max(ys))
        out = out | (box & (crossings(x, y, rings_to_edges([ring])) % 2 == 1))
    return out


def touched(row: Column, col: Column, rings: list[list[tuple[float, float]]]) -> Column:
    """Whether an edge of the rings meets the cell [col, col + 1) x [row, row + 1): the part of the edge inside the cell is not empty."""
    out = F.lit(False)
    for _, _, x1, y1, x2, y2 in rings_to_edges(rings):
        low, high = F.lit(0.0), F.lit(1.0)
        beyond = F.lit(False)
        for start, end, cell in ((x1, x2, col), (y1, y2, row)):
            d = end - start
            if d == 0:
                beyond = beyond | (F.lit(start) < cell) | (F.lit(start) > cell + 1)
            else:
                a, b = (cell - start) / d, (cell + 1 - start) / d
                low, high = F.greatest(low, F.least(a, b)), F.least(high, F.greatest(a, b))
        out = out | (~beyond & (low <= high))
    return out


def inside_table(points: DataFrame, edges: DataFrame, cell: float = 64.0) -> DataFrame:
    """points (id, x, y) with inside, for any number of polygons in an edge table (poly, x1, y1, x2, y2).

    Edges are dealt to the horizontal bands that they span and meet points by band: an equality
    join.  Each point counts, by polygon, the crossings to its right.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    bands = F.sequence(F.floor(low / cell), F.floor(high / cell))
    dealt = edges.where("y1 <> y2").withColumn("band", F.explode(bands))
    met = points.withColumn("band", F.floor(F.col("y") / cell)).join(dealt, "band")
    at = (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    cross = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < at)
    hits = met.where(cross).groupBy("id", "poly").agg(F.count("*").alias("n")).where("n % 2 = 1").select("id").distinct()
    return points.join(hits.withColumn("inside", F.lit(True)), "id", "left").withColumn("inside", F.coalesce("inside", F.lit(False)))


def grid_interpolate(row: Column, col: Column, rows: list[float], cols: list[float], values: list[list[float]]) -> Column:
    """Bilinear value on a tie-point grid, clamped to its edge."""
    table = F.array(*[F.lit(float(v)) for line in values for v in line])

    def cell(at: Column, axis: list[float]) -> tuple[Column, Column]:
        index = F.lit(0)
        for i in range(1, len(axis) - 1):
            index = F.when(at >= axis[i], i).otherwise(index)
        marks = F.array(*[F.lit(float(a)) for a in axis])
        low, high = F.get(marks, index), F.get(marks, index + 1)
        return index, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (at - low) / (high - low)))

    i, u = cell(row, rows)
    j, v = cell(col, cols)
    at = lambda a, b: F.get(table, a * len(cols) + b)
    return (1 - u) * ((1 - v) * at(i, j) + v * at(i, j + 1)) + u * ((1 - v) * at(i + 1, j) + v * at(i + 1, j + 1))


# Conic projection of the Canadian atlas (Clarke 1866, standard parallels 49 and 77).
LCC = {"a": 6378206.4, "e": 0.08227185, "phi_1": 49.0, "phi_2": 77.0, "phi_0": 40.0, "lambda_0": -100.0}


def _conic(p: dict[str, float]) -> tuple[float, float, float]:
    e = p["e"]
    m = lambda phi: math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)
    t = lambda phi: math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
    one, two, zero = (math.radians(p[k]) for k in ("phi_1", "phi_2", "phi_0"))
    n = (math.log(m(one)) - math.log(m(two))) / (math.log(t(one)) - math.log(t(two)))
    f = m(one) / (n * t(one) ** n)
    return n, f, p["a"] * f * t(zero) ** n


def lcc_forward(lat: Column, lon: Column, p: dict[str, float] = LCC) -> tuple[Column, Column]:
    """Easting and northing of the Lambert conformal conic projection with two standard parallels."""
    n, f, rho0 = _conic(p)
    phi, s = F.radians(lat), p["e"] * F.sin(F.radians(lat))
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(p["e"] / 2))
    rho, theta = p["a"] * f * F.pow(t, F.lit(n)), n * (F.radians(lon) - math.radians(p["lambda_0"]))
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def lcc_inverse(x: Column, y: Column, p: dict[str, float] = LCC, rounds: int = 6) -> tuple[Column, Column]:
    """Latitude and longitude; the latitude's fixed point is unrolled."""
    n, f, rho0 = _conic(p)
    rho = F.sqrt(x * x + (rho0 - y) * (rho0 - y))
    t = F.pow(rho / (p["a"] * f), F.lit(1 / n))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        s = p["e"] * F.sin(phi)
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(p["e"] / 2)))
    return F.degrees(phi), F.degrees(F.atan2(x, rho0 - y) / n) + p["lambda_0"]


# North polar stereographic on WGS 84, true at 70 degrees north, central meridian 45 degrees west.
POLAR = {"a": 6378137.0, "e": 0.0818191908426215, "phi_c": 70.0, "lambda_0": -45.0}


def polar_forward(lat: Column, lon: Column, p: dict[str, float] = POLAR) -> tuple[Column, Column]:
    e, c = p["e"], math.radians(p["phi_c"])
    tc = math.tan(math.pi / 4 - c / 2) / ((1 - e * math.sin(c)) / (1 + e * math.sin(c))) ** (e / 2)
    mc = math.cos(c) / math.sqrt(1 - (e * math.sin(c)) ** 2)
    s = e * F.sin(F.radians(lat))
    t = F.tan(math.pi / 4 - F.radians(lat) / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
    rho, theta = p["a"] * mc / tc * t, F.radians(lon) - math.radians(p["lambda_0"])
    return rho * F.sin(theta), -rho * F.cos(theta)


def sensor_land_mask(pixels: DataFrame, lat: Column, lon: Column, rings: list[list[tuple[float, float]]], cell: float, origin: tuple[float, float], size: tuple[int, int], threshold: float = 0.5) -> DataFrame:
    """row, col, land: pixels are projected, the ocean (rings in projected metres) is rasterised on a grid of `cell` metres from
    origin (x of the left, y of the top edge) and sampled bilinearly; outside the grid counts as land.

    The four cells around a place are tested directly, so the grid itself is never built.
    """
    x, y = polar_forward(lat, lon)
    placed = pixels.withColumns({"gx": (x - origin[0]) / cell - 0.5, "gy": (origin[1] - y) / cell - 0.5})
    placed = placed.withColumns({"c": F.floor("gx"), "r": F.floor("gy")})
    u, v, total = F.col("gy") - F.col("r"), F.col("gx") - F.col("c"), F.lit(0.0)
    for i in (0, 1):
        for j in (0, 1):
            row, col = F.col("r") + i, F.col("c") + j
            held = row.between(0, size[0] - 1) & col.between(0, size[1] - 1)
            sea = inside(origin[0] + (col + 0.5) * cell, origin[1] - (row + 0.5) * cell, rings)
            total = total + F.when(held & sea, F.abs(1 - i - u) * F.abs(1 - j - v)).otherwise(0.0)
    return placed.select("row", "col", (~(total > threshold)).alias("land"))


def clip_polygon(ring: list[tuple[float, float]], box: tuple[float, float, float, float]) -> list[tuple[float, float]]:
    """Sutherland-Hodgman clip of a ring to (x low, y low, x high, y high)."""
    x0, y0, x1, y1 = box
    sides = ((lambda p: p[0] >= x0, 0, x0), (lambda p: p[0] <= x1, 0, x1), (lambda p: p[1] >= y0, 1, y0), (lambda p: p[1] <= y1, 1, y1))
    for keeps, axis, limit in sides:
        out = []
        for a, b in zip(ring[-1:] + ring[:-1], ring, strict=True):
            if keeps(a) != keeps(b):
                u = (limit - a[axis]) / (b[axis] - a[axis])
                out.append(tuple(a[i] + u * (b[i] - a[i]) for i in (0, 1)))
            if keeps(b):
                out.append(b)
        ring = out
        if not ring:
            return []
    return ring


def linear_moments(frame: DataFrame, x: str, y: str, targets: list[str]) -> DataFrame:
    """The sums of the first-order polynomial's normal equations, in one pass."""
    terms = {"1": F.lit(1.0), "x": F.col(x), "y": F.col(y)}
    names = list(terms)
    sums = [F.sum(terms[a] * terms[b]).alias(f"m_{a}_{b}") for i, a in enumerate(names) for b in names[i:]]
    return frame.agg(*sums, *[F.sum(terms[a] * F.col(t)).alias(f"r_{a}_{t}") for t in targets for a in names])


def solve_moments(moments: DataFrame, target: str) -> list[float]:
    """Coefficients from the one row of sums."""
    row = moments.first().asDict()
    names = [c.removeprefix("r_").removesuffix(f"_{target}") for c in row if c.startswith("r_") and c.endswith(f"_{target}")]
    m = np.array([[row.get(f"m_{a}_{b}", row.get(f"m_{b}_{a}")) for b in names] for a in names], dtype=float)
    return np.linalg.solve(m, np.array([row[f"r_{a}_{target}"] for a in names], dtype=float)).tolist()


def polynomial_moments(frame: DataFrame, x: str, y: str, targets: list[str]) -> DataFrame:
    """The sums of the second-order polynomial's normal equations, in one pass."""
    terms = {"1": F.lit(1.0), "x": F.col(x), "y": F.col(y), "xy": F.col(x) * F.col(y), "xx": F.col(x) * F.col(x), "yy": F.col(y) * F.col(y)}
    names = list(terms)
    sums = [F.sum(terms[a] * terms[b]).alias(f"m_{a}_{b}") for i, a in enumerate(names) for b in names[i:]]
    return frame.agg(*sums, *[F.sum(terms[a] * F.col(t)).alias(f"r_{a}_{t}") for t in targets for a in names])
