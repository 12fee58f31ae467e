"""Equi join with hot keys split over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], spread: list[str], how: str = "inner", rows_per_task: int = 500_000
) -> DataFrame:
    """Join `left` to `right` on `on`; keys with more than `rows_per_task` left rows are cut into slices.

    A left row's slice comes from a hash of the `spread` columns (something that tells the rows of one key apart);
    the right rows of a hot key are copied to each of its slices, those of other keys are not. Inner, left, semi
    and anti joins stay exact. The list of hot keys has at most rows / rows_per_task entries.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do a {how} join")
    hot = (
        left.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows_per_task)
        .select(*on, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_slices"))
    )
    slices = F.coalesce("_slices", F.lit(1))
    salted = left.join(hot, on, "left").withColumn(
        "_salt", F.when(slices > 1, F.pmod(F.xxhash64(*spread), slices)).otherwise(0).cast("int")
    )
    copies = right.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
    return salted.drop("_slices").join(copies.drop("_slices"), [*on, "_salt"], how).drop("_salt")
