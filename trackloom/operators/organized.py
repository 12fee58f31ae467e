"""Organized clouds: the returns of rotating sensors put back into their grid of rows (lasers) and columns (firings).

All sweeps at once. A row fires at a fixed offset within a column, so a return's time less its row's offset is its
column's time; runs of such times without a gap of half a column are the columns that have returns, their medians the
columns' times. Columns without a return are put between by the gaps, as far as the grid has room for them: where there
are too many, the longest stretches of them lose first, one after the other, and only then the columns before the first
return. Cells without a return get the interpolated time and no coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.session import stage


def _columns(based: DataFrame, keys: list[str], width: int, step: float) -> tuple[DataFrame, DataFrame]:
    """(keys, place, col, at) of the columns with returns, and the returns with their column's place."""
    order = Window.partitionBy(*keys).orderBy("_base")  # one sweep, at most as many returns as its grid has cells
    fresh = F.coalesce((F.col("_base") - F.lag("_base").over(order) > step / 2).cast("int"), F.lit(0))
    cut = based.withColumn("_new", fresh).withColumn("_place", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
    cut = stage(cut, "columns")
    med = cut.groupBy(*keys, "_place").agg(F.percentile("_base", F.lit(0.5)).alias("_at"), F.min("_stamp").alias("_stamp"))
    by = Window.partitionBy(*keys).orderBy("_place")
    every = Window.partitionBy(*keys)
    rounded = lambda c: F.bround(c / step).cast("long")
    m = med.withColumn("_k", F.count("*").over(every)).where(F.col("_k") <= width)
    m = m.withColumns({
        "_extra": F.when(F.col("_k") < width, F.greatest(F.coalesce(rounded(F.lead("_at").over(by) - F.col("_at")) - 1, F.lit(0)), F.lit(0))).otherwise(0),
        "_lead": F.when(F.col("_k") < width, F.greatest(rounded(F.first("_at").over(by) - F.first("_stamp").over(by)), F.lit(0))).otherwise(0),
    })
    m = m.withColumn("_sum", F.sum("_extra").over(every))
    m = m.withColumn("_over", F.greatest(F.col("_lead") + F.col("_k") + F.col("_sum") - width, F.lit(0)))
    # taking one from the longest, again and again, ends at a level: the least at which what lies above it is not too much
    longest = Window.partitionBy(*keys).orderBy(F.desc("_extra"), "_place").rowsBetween(Window.unboundedPreceding, 0)
    need = F.ceil((F.sum("_extra").over(longest) - F.col("_over")) / F.count("*").over(longest))
    m = m.withColumn("_need", need).withColumn("_level", F.greatest(F.max("_need").over(every), F.lit(0)))
    taken = F.col("_over") > 0
    m = m.withColumn("_cut", F.when(taken, F.least("_extra", "_level")).otherwise(F.col("_extra")))
    m = m.withColumn("_rest", F.least("_over", "_sum") - (F.col("_sum") - F.sum("_cut").over(every)))
    at_level = (taken & (F.col("_cut") == F.col("_level")) & (F.col("_level") > 0)).cast("int")
    m = m.withColumn("_nth", F.sum(at_level).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    left = F.col("_cut") - F.when((at_level == 1) & (F.col("_nth") <= F.col("_rest")), 1).otherwise(0)
    lead = F.col("_lead") - F.greatest(F.col("_over") - F.col("_sum"), F.lit(0))
    before = F.coalesce(F.sum("_left").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    m = m.withColumn("_left", left).withColumn("col", (lead + F.col("_place") + before).cast("int"))
    return stage(m.select(*keys, "_place", "col", "_at"), "columns"), cut


def organize(
    points: DataFrame, grid: list[tuple[int, int, float]], keys: list[str], stamp: str, ring: str, t: str, values: list[str], width: int, sweep: float
) -> tuple[DataFrame, DataFrame]:
    """The organized sweeps, (keys, row, col, ring, at, values), a row per cell; and (keys, why) of sweeps that do not fit.

    `points`: keys, `stamp` (the sweep's start), `ring`, `t` (after the stamp), `values`; `grid`: (row, ring,
    offset) of every laser. A sweep does not fit if a ring is unknown, if it has more columns than `width`, or two returns in a cell.
    """
    row_of = F.create_map(*(F.lit(v) for row, r, _ in grid for v in (r, row)))
    offset_of = F.create_map(*(F.lit(v) for row, _, o in grid for v in (row, float(o))))
    met = points.withColumn("_row", row_of[F.col(ring)]).withColumn("_offset", offset_of[F.col("_row")])
    strange = met.where(F.col("_row").isNull()).select(*keys).distinct().withColumn("why", F.lit("ring"))
    based = met.withColumn("_stamp", F.col(stamp)).withColumn("_base", F.col(stamp) + F.col(t) - F.col("_offset"))
    based = based.join(strange, keys, "left_anti").select(*keys, "_row", "_base", "_stamp", (F.col(stamp) + F.col(t)).alias("_t"), *values)
    columns, cut = _columns(based, keys, width, sweep / width)
    placed = stage(cut.join(columns.select(*keys, "_place", "col"), [*keys, "_place"]), "columns")
    wide = cut.select(*keys).distinct().join(columns.select(*keys).distinct(), keys, "left_anti").withColumn("why", F.lit("columns"))
    twice = placed.groupBy(*keys, "_row", "col").count().where("count > 1").select(*keys).distinct().withColumn("why", F.lit("cell"))
    misfits = stage(strange.unionByName(wide).unionByName(twice), "columns")
    known = columns.join(misfits, keys, "left_anti")
    whole = known.select(*keys).distinct().withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    up, down = Window.partitionBy(*keys).orderBy("col"), Window.partitionBy(*keys).orderBy(F.desc("col"))
    spot = F.when(F.col("_at").isNotNull(), F.struct("col", "_at"))
    timed = whole.join(known.select(*keys, "col", "_at"), [*keys, "col"], "left").withColumns(
        {"_lo": F.last(spot, True).over(up), "_hi": F.last(spot, True).over(down)}
    )
    timed = timed.select(*keys, "col", _between(F.col("_lo"), F.col("_hi"), F.col("col")).alias("_time"))
    lasers = F.array(*(F.struct(F.lit(row).alias("_row"), F.lit(r).alias("_ring"), F.lit(float(o)).alias("_offset")) for row, r, o in grid))
    cells = timed.select("*", F.inline(lasers))
    filled = cells.join(placed.select(*keys, "_row", "col", "_t", *values), [*keys, "_row", "col"], "left")
    at = F.coalesce("_t", F.col("_time") + F.col("_offset")).alias("at")
    return filled.select(*keys, F.col("_row").alias("row"), "col", F.col("_ring").alias("ring"), at, *values), misfits


def _between(lo: Column, hi: Column, col: Column) -> Column:
    """The time at `col` on the line between the known columns around it; that of the nearest at either end."""
    slope = (hi["_at"] - lo["_at"]) / (hi["col"] - lo["col"])
    return F.when(lo.isNull(), hi["_at"]).when(hi.isNull() | (hi["col"] == lo["col"]), lo["_at"]).otherwise(lo["_at"] + slope * (col - lo["col"]))
