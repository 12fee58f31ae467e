"""Cells over points: occupancy, change between scans, heat maps, voxels, nearest-depth filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.ordered import Axis, following, prev, scan
from trackloom.operators.skew import salted_join

# Fixed values of the occupancy rule: half size, cell, ground cell (m), height band above ground, own-body radius.
HALF, CELL, GROUND_CELL = 40.0, 0.5, 2.0
BAND = (0.4, 2.5)
BODY = 2.5


def _neighbours(cells: DataFrame, cx: str, cy: str, reach: int = 1) -> DataFrame:
    span = range(-reach, reach + 1)
    offs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in span for j in span])
    return cells.withColumn("_o", F.explode(offs)).select(
        *[c for c in cells.columns if c not in (cx, cy)],
        (F.col(cx) + F.col("_o")["i"]).alias(cx),
        (F.col(cy) + F.col("_o")["j"]).alias(cy),
    )


def _index(value: Column, half: float, cell: float) -> Column:
    top = int(2 * half / cell) - 1
    return F.least(F.greatest(F.floor((value + half) / cell), F.lit(0)), F.lit(top)).cast("int")


def finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose `columns` are all finite numbers."""
    for c in columns:
        df = df.where(~F.isnan(c) & (F.abs(F.col(c)) < F.lit(float("inf"))))
    return df


def in_range(df: DataFrame, x: str, y: str, z: str, low: float, high: float) -> DataFrame:
    r = F.sqrt(F.col(x) * F.col(x) + F.col(y) * F.col(y) + F.col(z) * F.col(z))
    return df.where((r > low) & (r < high))


def cell_counts(df: DataFrame, keys: list[str], x: str, y: str, cell: float) -> DataFrame:
    """Points per cell."""
    return df.groupBy(
        *keys, F.floor(F.col(x) / cell).alias("cx"), F.floor(F.col(y) / cell).alias("cy")
    ).agg(F.count(F.lit(1)).alias("n"))


def occupancy(
    points: DataFrame, keys: list[str], x: str = "x", y: str = "y", z: str = "z", min_hits: int = 2,
    half: float = HALF, cell: float = CELL, ground_cell: float = GROUND_CELL, band: tuple[float, float] = BAND,
    body: float = BODY,
) -> DataFrame:
    """Occupied cells (cx, cy) of a scan: at least `min_hits` points in the height band above the local ground.

    Ground is the lowest point of the coarse cell and the eight around it; points on the own body do not count.
    """
    near = points.where((F.abs(F.col(x)) < half) & (F.abs(F.col(y)) < half)).select(
        *keys, x, y, z,
        _index(F.col(x), half, ground_cell).alias("_gx"),
        _index(F.col(y), half, ground_cell).alias("_gy"),
    )
    lowest = near.groupBy(*keys, "_gx", "_gy").agg(F.min(z).alias("_z"))
    ground = _neighbours(lowest, "_gx", "_gy").groupBy(*keys, "_gx", "_gy").agg(F.min("_z").alias("_ground"))
    h = F.col(z) - F.col("_ground")
    solid = near.join(ground, [*keys, "_gx", "_gy"]).where(
        (h > band[0]) & (h < band[1]) & (F.col(x) * F.col(x) + F.col(y) * F.col(y) > body * body)
    )
    return (
        solid.groupBy(*keys, _index(F.col(x), half, cell).alias("cx"), _index(F.col(y), half, cell).alias("cy"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_hits)
    )


def dilate(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells within one step (diagonals too) of the given ones."""
    return _neighbours(cells.select(*keys, "cx", "cy"), "cx", "cy").distinct()


def change_cells(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that appeared or disappeared between two scans, allowing one cell of play: (keys, cx, cy, change)."""
    a, b = before.select(*keys, "cx", "cy").distinct(), after.select(*keys, "cx", "cy").distinct()
    on = [*keys, "cx", "cy"]
    gone = a.join(dilate(b, keys), on, "left_anti").withColumn("change", F.lit("gone"))
    new = b.join(dilate(a, keys), on, "left_anti").withColumn("change", F.lit("new"))
    return gone.unionByName(new)


def blobs(cells: DataFrame, keys: list[str], min_cells: int = 4) -> DataFrame:
    """Connected groups (diagonals count) of at least `min_cells` cells: (keys, cx, cy, blob)."""
    from trackloom.operators.graph import components

    ident = F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.col("cx").cast("string"), F.col("cy").cast("string"))
    nodes = cells.select(*keys, "cx", "cy").distinct().withColumn("node", ident)
    around = _neighbours(nodes.select(*keys, "cx", "cy", F.col("node").alias("other")), "cx", "cy")
    edges = around.join(nodes, [*keys, "cx", "cy"]).where("node <> other").select("node", "other")
    comp = components(nodes, edges, "node", "node", "other").withColumnRenamed("component", "blob")
    big = comp.groupBy("blob").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_cells).select("blob")
    return nodes.join(comp, "node").join(big, "blob", "left_semi").select(*keys, "cx", "cy", "blob")


def heat_norms(heat: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Heat map (key, cx, cy, n) after a 3 x 3 box sum, and its Euclidean norm per key."""
    blurred = _neighbours(heat.select(key, "cx", "cy", "n"), "cx", "cy").groupBy(key, "cx", "cy").agg(F.sum("n").alias("n"))
    norms = blurred.groupBy(key).agg(F.sqrt(F.sum(F.col("n").cast("double") * F.col("n"))).alias("norm"))
    return blurred, norms


def heat_cosine(heat: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """(a, b, cosine) of the blurred heat maps of the given pairs; 0 where one of them is empty or they never meet."""
    blurred, norms = heat_norms(heat, key)
    left = blurred.select(F.col(key).alias("a"), "cx", "cy", F.col("n").alias("_na"))
    right = blurred.select(F.col(key).alias("b"), "cx", "cy", F.col("n").alias("_nb"))
    asked = salted_join(left, pairs.select("a", "b").distinct(), ["a"], ["cx", "cy"])
    dots = salted_join(asked, right, ["b", "cx", "cy"], ["a"]).groupBy("a", "b").agg(
        F.sum(F.col("_na").cast("double") * F.col("_nb")).alias("_dot")
    )
    out = pairs.select("a", "b").distinct().join(dots, ["a", "b"], "left")
    out = out.join(norms.select(F.col(key).alias("a"), F.col("norm").alias("_a")), "a", "left")
    out = out.join(norms.select(F.col(key).alias("b"), F.col("norm").alias("_b")), "b", "left")
    return out.select("a", "b", F.coalesce(F.col("_dot") / (F.col("_a") * F.col("_b")), F.lit(0.0)).alias("cosine"))


def voxel_first(df: DataFrame, keys: list[str], xyz: list[str], voxel: float, index: str) -> DataFrame:
    """The first point (by `index`) of every voxel."""
    cells = [F.floor(F.col(c) / voxel).alias(f"_v{i}") for i, c in enumerate(xyz)]
    best = df.select("*", *cells).groupBy(*keys, *[f"_v{i}" for i in range(len(xyz))]).agg(
        F.min_by(F.struct(*[c for c in df.columns if c not in keys]), index).alias("_p")
    )
    return best.select(*keys, *[F.col("_p")[c].alias(c) for c in df.columns if c not in keys]).select(*df.columns)


def visible(
    df: DataFrame, keys: list[str], u: str, v: str, depth: str, width: int, height: int, cell: int = 6, tol: float = 0.08
) -> DataFrame:
    """Points inside the image that are not behind a nearer one of the same pixel cell (8 % + 0.2 m of play)."""
    inside = df.where(
        ~F.isnan(u) & ~F.isnan(v) & (F.col(u) >= 0) & (F.col(u) < width) & (F.col(v) >= 0) & (F.col(v) < height)
    ).withColumn("_cx", F.floor(F.col(u) / cell)).withColumn("_cy", F.floor(F.col(v) / cell))
    nearest = inside.groupBy(*keys, "_cx", "_cy").agg(F.min(depth).alias("_z"))
    return inside.join(nearest, [*keys, "_cx", "_cy"]).where(F.col(depth) <= F.col("_z") * (1 + tol) + 0.2).select(*df.columns)


def range_edges(
    df: DataFrame, keys: list[str], ring: str, at: str, rng: str, span: int, jump: float = 0.3, rel: float = 0.05
) -> DataFrame:
    """Adds `edge`: the near side of a range jump above max(jump, rel * nearer range) along the ring in time order."""
    s = scan(df, Axis((*keys, ring), at, span), {"_p": prev(rng), "_n": following(rng)})
    r = F.col(rng)

    def near_side(other: str) -> Column:
        d = F.col(other) - r
        return F.coalesce((d > 0) & (d > F.greatest(F.lit(jump), F.lit(rel) * F.least(F.col(other), r))), F.lit(False))

    return s.select(*df.columns, (near_side("_p") | near_side("_n")).alias("edge"))


def ring_of(df: DataFrame, device: str, channel: str, angle: str) -> DataFrame:
    """Adds `ring`: how many of the device's channels point lower. A device has a few hundred channels at most."""
    w = Window.partitionBy(device).orderBy(angle)
    rings = df.select(device, channel, angle).distinct().select(device, channel, (F.rank().over(w) - 1).alias("ring"))
    return df.join(rings, [device, channel])


def drop_static_tracks(
    obs: DataFrame, track: list[str], frame: str, u: str, v: str, pos: list[str], min_px: float = 3.0, min_travel: float = 2.0
) -> DataFrame:
    """Observations without the tracks that stay put in the image while the car travels."""
    ends = obs.groupBy(*track).agg(
        F.min(F.struct(frame, u, v, *pos)).alias("_a"), F.max(F.struct(frame, u, v, *pos)).alias("_b")
    )

    def length(cols: list[str]) -> Column:
        return F.sqrt(sum(((F.col("_b")[c] - F.col("_a")[c]) ** 2 for c in cols[1:]), (F.col("_b")[cols[0]] - F.col("_a")[cols[0]]) ** 2))

    bad = ends.where((length([u, v]) < min_px) & (length(pos) > min_travel)).select(*track)
    return obs.join(bad, track, "left_anti")


def long_tracks(obs: DataFrame, track: list[str], min_len: int) -> DataFrame:
    """Observations of tracks with at least `min_len` of them."""
    keep = obs.groupBy(*track).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_len).select(*track)
    return obs.join(keep, track, "left_semi")
