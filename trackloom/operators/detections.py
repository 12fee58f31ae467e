"""Rules over 2-D detection boxes: flags, per-sample counts, motion between frames, recurring own-body places."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.functions.boxes import area, intersection, iou
from trackloom.operators.skew import salted_join

# Detector class -> road-user group, and the thresholds of the counting rules.
GROUP = {"person": "ped", "bicycle": "two", "motorcycle": "two", "car": "veh", "bus": "veh", "truck": "veh"}
BOX = ("x1", "y1", "x2", "y2")
FRAMES = 64  # frames a stretch holds
PAIRS = 1 << 18  # pairs of boxes compared at a time


def near_boxes(
    boxes: DataFrame, others: DataFrame, keys: list[str], reach: float, spread: list[str], prefix: str = "o_"
) -> DataFrame:
    """Pairs of boxes of one image whose overlap can be `reach` or more (IoU), found by the cell of the box corner.

    Two boxes with IoU >= t have widths within a factor t, and left edges at most (1/t - 1) times the smaller width
    apart. Boxes are filed by width class and by a cell at least that wide; a box asks the classes within reach
    and the cells beside its own.
    """
    steps = max(1, math.ceil(-math.log2(reach)))
    cellf = max(1.0, 1.0 / reach - 1.0)

    def classed(df: DataFrame) -> DataFrame:
        size = F.greatest(F.col("x2") - F.col("x1"), F.lit(1e-6))
        return df.withColumn("_cls", F.floor(F.log2(size)).cast("int"))

    def cell(col: str, cls: Column) -> Column:
        return F.floor(F.col(col) / (F.pow(F.lit(2.0), cls + 1) * cellf)).cast("long")

    a = classed(boxes).withColumn("_c", F.explode(F.sequence(F.col("_cls") - steps, F.col("_cls") + steps)))
    a = a.withColumn("_cx", F.explode(F.sequence(cell("x1", F.col("_c")) - 1, cell("x1", F.col("_c")) + 1)))
    b = classed(others)
    b = b.withColumn("_cx", cell("x1", F.col("_cls")))
    b = b.select(*keys, F.col("_cls").alias("_c"), "_cx", *[F.col(c).alias(prefix + c) for c in others.columns if c not in keys])
    return salted_join(a.drop("_cls"), b, [*keys, "_c", "_cx"], spread).drop("_c", "_cx")


def own_body_flag(name: Column, height: int, width: int) -> Column:
    """A vehicle box that reaches the bottom edge and spans much of the image is the recording car itself."""
    return (
        name.isin("car", "bus", "truck")
        & (F.col("y2") > 0.97 * height)
        & ((F.col("x2") - F.col("x1")) > 0.4 * width)
    )


def box_flags(
    boxes: DataFrame, image: list[str], cam: str, name: str, box_id: str, min_conf: float, height: int, width: int,
    regions: DataFrame | None = None, drop_iou: float = 0.5, rider_ioa: float = 0.3,
) -> DataFrame:
    """Adds `flag`: LOW confidence, EGO body (rule or recurring `regions` per camera), RIDER of a two-wheeler, COUNTED."""
    low = F.col("conf") < min_conf
    first = F.when(low, "LOW").when(own_body_flag(F.col(name), height, width), "EGO").otherwise("COUNTED")
    rows = boxes.withColumn("flag", first)
    if regions is not None:
        r = regions.select(cam, *[F.col(c).alias(f"r_{c}") for c in BOX])
        hit = rows.where("flag = 'COUNTED'").join(r, cam)
        hit = hit.where(iou(BOX, tuple(f"r_{c}" for c in BOX), 1e-6) >= drop_iou).select(*image, box_id).distinct()
        rows = rows.join(hit.withColumn("_ego", F.lit(True)), [*image, box_id], "left").withColumn(
            "flag", F.when(F.col("_ego"), "EGO").otherwise(F.col("flag"))
        ).drop("_ego")
    counted = rows.where("flag = 'COUNTED'")
    two = counted.where(F.col(name).isin("bicycle", "motorcycle")).select(*image, *[F.col(c).alias(f"t_{c}") for c in BOX])
    person = counted.where(F.col(name) == "person")
    share = intersection(BOX, tuple(f"t_{c}" for c in BOX)) / F.greatest(area(BOX), F.lit(1e-6))
    riders = salted_join(person, two, image, [box_id]).where(share >= rider_ioa).select(*image, box_id).distinct()
    out = rows.join(riders.withColumn("_rider", F.lit(True)), [*image, box_id], "left")
    return out.withColumn("flag", F.when(F.col("_rider"), "RIDER").otherwise(F.col("flag"))).drop("_rider")


def sample_counts(
    flagged: DataFrame, samples: DataFrame, sample: list[str], name: str, near_px: float
) -> DataFrame:
    """Counted boxes per sample and group, near (tall enough) and all, zero for samples without boxes."""
    group = F.lit(None).cast("string")
    for n, g in GROUP.items():
        group = F.when(F.col(name) == n, g).otherwise(group)
    rows = flagged.where("flag = 'COUNTED'").withColumn("_g", group).withColumn("_near", F.col("y2") - F.col("y1") >= near_px)
    aggs = []
    for g in ("veh", "ped", "two"):
        aggs += [F.count_if(F.col("_g") == g).alias(f"{g}_all"), F.count_if((F.col("_g") == g) & F.col("_near")).alias(f"{g}_near")]
    aggs += [F.count(F.lit(1)).alias("all_all"), F.count_if("_near").alias("all_near")]
    counts = rows.groupBy(*sample).agg(*aggs)
    cols = [c for c in counts.columns if c not in sample]
    return samples.select(*sample).join(counts, sample, "left").select(
        *sample, *[F.coalesce(c, F.lit(0)).alias(c) for c in cols]
    )


def count_summary(counts: DataFrame, scene: list[str], columns: list[str]) -> DataFrame:
    """Per scene and count: mean, min, max and the share of samples that have any."""
    aggs = []
    for c in columns:
        aggs += [
            F.avg(c).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"),
            F.avg((F.col(c) > 0).cast("double")).alias(f"{c}_any"),
        ]
    return counts.groupBy(*scene).agg(*aggs)


def moving_boxes(
    boxes: DataFrame, scene: list[str], frame: str, cam: str, kind: str, box_id: str, static_iou: float = 0.5
) -> DataFrame:
    """Adds `moving`: no box of the same kind overlaps it by static_iou in either neighbouring frame.

    `frame` counts 0, 1, 2, ... within the scene; a frame the scene lacks (before the first, after the last) is
    not asked. Boxes are shuffled once, by camera and stretch of FRAMES frames; the frames at either end of a stretch
    also go to the stretch beside it.
    """
    at = F.coalesce(F.col(frame), F.lit(0)).cast("long")
    block, inside = F.floor(at / FRAMES), F.pmod(at, F.lit(FRAMES))
    beside = F.when(inside == 0, -1).when(inside == FRAMES - 1, 1)
    rows = boxes.withColumn("_side", F.explode(F.array_compact(F.array(F.lit(0), beside)))).withColumn("_block", block + F.col("_side"))
    same, columns = [frame, kind, box_id], boxes.columns

    def mark(table: pa.Table) -> pa.Table:
        still = _still([table.column(c) for c in (*scene, cam)], *[table.column(c) for c in same], [table.column(c) for c in BOX], static_iou)
        own = table.append_column("moving", pa.array(~still)).filter(pc.equal(table.column("_side"), 0))
        return own.select([*columns, "moving"])

    schema = T.StructType([*boxes.schema.fields, T.StructField("moving", T.BooleanType())])
    return rows.groupBy(*scene, cam, "_block").applyInArrow(mark, schema)


def _still(place: list[pa.ChunkedArray], frame, kind, box_id, box: list[pa.ChunkedArray], least: float) -> np.ndarray:
    """Which boxes of a stretch of frames meet one of their kind in the frame before or after."""
    n = len(frame)
    still = np.zeros(n, bool)
    if any(c[0].as_py() is None for c in place):
        return still
    known = pc.and_(pc.is_valid(frame), pc.is_valid(kind)).to_numpy(zero_copy_only=False)
    at = pc.fill_null(frame, 0).to_numpy().astype(np.int64)
    sort = pc.fill_null(kind.combine_chunks().dictionary_encode().indices, -1).to_numpy()
    x1, y1, x2, y2 = (c.to_numpy().astype(float) for c in box)
    order = np.lexsort((x1, at, sort))
    order = order[known[order]]
    edge = np.flatnonzero(np.diff(sort[order]) | np.diff(at[order])) + 1
    images = np.split(order, edge)
    for a, b in zip(images, images[1:]):
        if sort[a[0]] != sort[b[0]] or at[b[0]] != at[a[0]] + 1:
            continue
        # an overlap of `least` leaves this much between the left edges
        width = np.maximum(x2[a] - x1[a], 0)
        step = max(1, PAIRS // len(b))
        for k in range(0, len(a), step):
            i, w = a[k : k + step], width[k : k + step] * (1 + 1e-9) + 1e-6
            low, high = np.nanmin(x1[i] - (1 / least - 1) * w, initial=np.inf), np.nanmax(x1[i] + (1 - least) * w, initial=-np.inf)
            j = b[np.searchsorted(x1[b], low, "left") : np.searchsorted(x1[b], high, "right")]
            p = i[:, None]
            wide = np.maximum(np.minimum(x2[p], x2[j]) - np.maximum(x1[p], x1[j]), 0)
            shared = wide * np.maximum(np.minimum(y2[p], y2[j]) - np.maximum(y1[p], y1[j]), 0)
            whole = (x2[p] - x1[p]) * (y2[p] - y1[p]) + (x2[j] - x1[j]) * (y2[j] - y1[j]) - shared + 1e-9
            with np.errstate(divide="ignore", invalid="ignore"):
                met = shared / whole >= least
            still[i] |= met.any(axis=1)
            still[j] |= met.any(axis=0)
    # rows of one id in one frame are one box
    ids = box_id.combine_chunks().dictionary_encode().indices
    if len(pc.unique(ids)) < n and still.any():
        named = pc.fill_null(ids, -1).to_numpy().astype(np.int64)
        _, one = np.unique(np.stack([named, at]), axis=1, return_inverse=True)
        found = np.zeros(one.max() + 1, bool)
        found[one.ravel()[still & (named >= 0)]] = True
        still |= found[one.ravel()] & known
    return still
