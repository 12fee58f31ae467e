"""Nearest neighbours in space and planes through them, as rounds of equi-joins over cells.

A round at cell size s joins every open query with the points of its own cell and the 26 around it. Whatever lies outside
these is farther than s, so a query whose k-th neighbour is nearer than s is answered, and so is every query once s
reaches the radius; the others go on with cells of twice the size. Dense places are thus settled in small cells, and only
queries in sparse ones see large cells. The first size is halved until the fullest cell is small. The k nearest are kept
by a ranked limit that is applied before rows are shuffled, and cells with very many points are joined in slices.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.skew import salted_join
from trackloom.session import discard, stage

XYZ = ["x", "y", "z"]
#: points in the fullest cell of the first round
FULLEST = 256


def cell_size(points: DataFrame, keys: list[str], size: float, fullest: int = FULLEST, least: float = 1e-3) -> float:
    """`size` halved until no cell holds more than `fullest` points at unlike places (or cells are `least` wide)."""
    while size > least:
        cells = [F.floor(F.col(c) / size).alias(f"_{c}") for c in XYZ]
        most = points.select(*keys, *XYZ).distinct().groupBy(*keys, *cells).count().agg(F.max("count")).first()[0]
        if (most or 0) <= fullest:
            break
        size /= 2
    return size


def nearest(
    points: DataFrame, queries: DataFrame, keys: list[str], point: str, query: str, k: int, radius: float, first: float | None = None
) -> DataFrame:
    """(keys, query, rank INT, point, d, dx, dy, dz): the k points nearest to each query, nearer than `radius`.

    `points`: keys, `point`, x, y, z; `queries`: keys, `query`, x, y, z; both ids are unique within the keys. Equal
    distances are ordered by point id. A query with fewer than k points in reach has fewer rows. Points and queries with
    a missing or NaN coordinate are left out.
    """
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in XYZ])
    points = stage(points.where(whole).select(*keys, F.col(point).alias("_point"), *(F.col(c).alias(f"p{c}") for c in XYZ)), "points")
    left = stage(queries.where(whole).select(*keys, F.col(query).alias("_query"), *XYZ), "queries")
    size = first or cell_size(points.select(*keys, *(F.col(f"p{c}").alias(c) for c in XYZ)), keys, radius)
    steps = F.array(*[F.struct(*(F.lit(v).cast("long").alias(c) for v, c in zip(s, "ijk"))) for s in product((-1, 0, 1), repeat=3)])
    best = Window.partitionBy(*keys, "_query").orderBy("d2", "_point")
    found = []
    while True:
        cell = [f"_{c}" for c in XYZ]
        filed = points.withColumns({f"_{c}": F.floor(F.col(f"p{c}") / size) for c in XYZ})
        near = left.withColumn("_s", F.explode(steps)).select(
            *keys, "_query", *XYZ, *((F.floor(F.col(c) / size) + F.col(f"_s.{i}")).alias(f"_{c}") for c, i in zip(XYZ, "ijk"))
        )
        met = salted_join(filed, near, [*keys, *cell], ["_point"])
        met = met.withColumns({f"d{c}": F.col(f"p{c}") - F.col(c) for c in XYZ})
        met = met.withColumn("d2", F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") + F.col("dz") * F.col("dz"))
        top = met.where(F.col("d2") < radius * radius).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        top = stage(top.select(*keys, "_query", "rank", "_point", "d2", "dx", "dy", "dz"), "near")
        if size >= radius:
            found.append(top)
            break
        done = top.groupBy(*keys, "_query").agg(F.count("*").alias("n"), F.max("d2").alias("far"))
        done = stage(done.where((F.col("n") == k) & (F.col("far") < size * size)).select(*keys, "_query"), "near")
        found.append(stage(top.join(done, [*keys, "_query"], "left_semi"), "near"))
        more = stage(left.join(done, [*keys, "_query"], "left_anti"), "queries")
        for t in (left, top, done):
            discard(t)
        left, size = more, size * 2
    out = reduce(DataFrame.unionByName, found)
    return out.select(*keys, F.col("_query").alias(query), "rank", F.col("_point").alias(point), F.sqrt("d2").alias("d"), "dx", "dy", "dz")


def smallest_axis(s: dict[str, Column]) -> dict[str, Column]:
    """Eigenvalues w0 <= w1 <= w2 of a symmetric matrix (xx, xy, xz, yy, yz, zz) and the unit vector nx, ny, nz of w0.

    The trigonometric solution of the cubic; the vector is the longest cross product of two rows of the matrix less
    w0, its first part that is not 0 positive. Where w0 is not a single root the vector is one of many, or null.
    """
    mean = (s["xx"] + s["yy"] + s["zz"]) / 3
    off = s["xy"] * s["xy"] + s["xz"] * s["xz"] + s["yz"] * s["yz"]
    a, b, c = (s[d] - mean for d in ("xx", "yy", "zz"))
    p = F.sqrt((a * a + b * b + c * c + 2 * off) / 6)
    det = a * (b * c - s["yz"] * s["yz"]) - s["xy"] * (s["xy"] * c - s["yz"] * s["xz"]) + s["xz"] * (s["xy"] * s["yz"] - b * s["xz"])
    r = F.when(p > 0, det / (2 * p * p * p)).otherwise(0.0)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))) / 3
    w2, w0 = mean + 2 * p * F.cos(angle), mean + 2 * p * F.cos(angle + 2 * math.pi / 3)
    w1 = 3 * mean - w0 - w2
    rows = [[s["xx"] - w0, s["xy"], s["xz"]], [s["xy"], s["yy"] - w0, s["yz"]], [s["xz"], s["yz"], s["zz"] - w0]]
    cross = lambda u, v: [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    options = [cross(rows[i], rows[j]) for i, j in ((0, 1), (0, 2), (1, 2))]
    packed = [F.struct((v[0] * v[0] + v[1] * v[1] + v[2] * v[2]).alias("n"), *(c.alias(n) for c, n in zip(v, XYZ))) for v in options]
    one = F.greatest(*packed)
    sign = lambda v: F.when(v["x"] != 0, F.signum(v["x"])).when(v["y"] != 0, F.signum(v["y"])).otherwise(F.signum(v["z"]))
    scaled = lambda v, c: F.when(v["n"] > 0, sign(v) * v[c] / F.sqrt(v["n"]))
    return {"w0": w0, "w1": w1, "w2": w2, **{f"n{c}": scaled(one, c) for c in XYZ}}


def planes(near: DataFrame, keys: list[str], query: str, k: int) -> DataFrame:
    """(keys, query, w0, w1, w2, planarity, thickness, nx, ny, nz, distance, cx, cy, cz) of queries with k neighbours.

    The plane through the neighbours: eigenvalues of their covariance, (w1 - w0) / w2, the root of w0, the normal, the
    query's distance from the plane, and the neighbours' centre relative to the query.
    """
    second = {a + b: F.sum(F.col(f"d{a}") * F.col(f"d{b}")) for a, b in (("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z"))}
    sums = near.groupBy(*keys, query).agg(
        F.count("*").alias("n"), *(F.avg(f"d{c}").alias(f"c{c}") for c in XYZ), *(c.alias(n) for n, c in second.items())
    )
    full = sums.where(F.col("n") == k)
    spread = {n: F.col(n) / k - F.col(f"c{n[0]}") * F.col(f"c{n[1]}") for n in second}
    full = full.select(*keys, query, *(f"c{c}" for c in XYZ), *(c.alias(n) for n, c in spread.items()))
    fitted = full.withColumns(smallest_axis({n: F.col(n) for n in second}))
    away = F.abs(sum(F.col(f"c{c}") * F.col(f"n{c}") for c in XYZ))
    return fitted.select(
        *keys, query, "w0", "w1", "w2", ((F.col("w1") - F.col("w0")) / F.greatest(F.col("w2"), F.lit(1e-12))).alias("planarity"),
        F.sqrt(F.greatest(F.col("w0"), F.lit(0.0))).alias("thickness"), "nx", "ny", "nz", away.alias("distance"), "cx", "cy", "cz",
    )


def on_planes(
    points: DataFrame, queries: DataFrame, keys: list[str], point: str, query: str, gate: float, k: int = 16, radius: float = 0.4, planarity: float = 0.6,
    thickness: float = 0.03,
) -> DataFrame:
    """The fitted planes of the queries that lie on one: k points in reach, flat, thin, and the query within `gate`."""
    fitted = planes(nearest(points, queries, keys, point, query, k, radius), keys, query, k)
    return fitted.where((F.col("planarity") > planarity) & (F.col("thickness") < thickness) & (F.col("distance") < gate))
