"""Interval (range) join of points with spans, many to many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.skew import salted_join

_STEP = 8  # every level's bins are 8 times wider than the level below
_TOP = 2**62  # widest bin of the coarsest level stays below this


def _bin(value: Column | str, width: Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.floor((v - F.pmod(v, width)) / width)


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    at: str,
    start: str,
    end: str,
    spread: list[str],
    finest: int,
    margin: int = 0,
    rows_per_task: int = 500_000,
) -> DataFrame:
    """Every point with every span of its key that contains it, both ends included and widened by `margin`.

    Spans are filed in bins of the coarseness that fits their length (at most two bins per span, `finest` wide at
    the lowest level), points look into one bin of each level in use. So a long span costs no more than a short
    one, and a crowded bin is sliced (`salted_join`).
    """
    lo, hi = F.col(start) - margin, F.col(end) + margin
    wide = spans.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi")
    levels = 0
    while finest * _STEP ** (levels + 1) < _TOP:
        levels += 1
    level = F.lit(levels)
    for k in reversed(range(levels)):
        level = F.when(F.col("_hi") - F.col("_lo") <= finest * _STEP**k, F.lit(k)).otherwise(level)
    wide = wide.withColumn("_level", level)
    width = F.pow(F.lit(float(_STEP)), F.col("_level")).cast("long") * F.lit(finest).cast("long")
    filed = wide.withColumn("_w", width).withColumn(
        "_bin", F.explode(F.sequence(_bin("_lo", F.col("_w")), _bin("_hi", F.col("_w"))))
    )
    # the levels in use anywhere: one row with about a dozen numbers at most
    used = wide.agg(F.sort_array(F.collect_set("_level")).alias("_levels")).withColumn("_one", F.lit(1))
    asked = points.withColumn("_one", F.lit(1)).join(F.broadcast(used), "_one").drop("_one")
    asked = asked.withColumn("_level", F.explode("_levels")).drop("_levels")
    asked = asked.withColumn("_bin", _bin(at, width))
    found = salted_join(
        asked, filed.drop("_w"), [*keys, "_level", "_bin"], spread, rows_per_task=rows_per_task
    )
    inside = (F.col(at) >= F.col("_lo")) & (F.col(at) <= F.col("_hi"))
    return found.where(inside).drop("_level", "_bin", "_lo", "_hi")
