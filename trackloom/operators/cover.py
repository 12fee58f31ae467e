"""Representatives of groups: few members that show whatever the others of their group show, within tolerances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.session import discard, stage


def representatives(members: DataFrame, labels: DataFrame, group: str, member: str, tolerances: dict[str, float]) -> DataFrame:
    """(group, member, status, ref, place INT, human BOOLEAN, excess MAP<STRING, DOUBLE>): what becomes of every member.

    `tolerances`: kind of value -> tolerance; `members` holds a column per kind. The member with the largest sum of
    values over tolerances is the first representative of its group (smaller id first at a tie). Then, again and again,
    the first other member in that order that the representatives do not cover becomes one: some value of it is more
    than twice the tolerance above their highest, or `labels` (a, b, same) says that it differs from the representative
    nearest to it; one that a label makes the same as a representative never does. At the end each other member is a
    `dup` of the representative it was labelled the same as (the earliest), or of the nearest one if no value is more
    than the tolerance above their highest, else a `review`.

    All groups advance together: a round adds one representative to every group that still needs one, so there are as
    many rounds as representatives in the group that has most. A round joins the open groups' members with one row
    per group and with the labels of the new representatives; no group is gathered anywhere. Missing values count as 0, members without group or id
    are left out; labels may name pairs in either order, and where they disagree "the same" counts.
    """
    kinds = list(tolerances)
    over = lambda f: reduce(lambda a, b: a + b, [f(k) for k in kinds])
    m = members.where(F.col(group).isNotNull() & F.col(member).isNotNull()).select(
        F.col(group).alias("g"), F.col(member).alias("m"), *(F.coalesce(F.col(k).cast("double"), F.lit(0.0)).alias(f"v_{k}") for k in kinds)
    )
    m = m.withColumn("rank", F.struct((-over(lambda k: F.col(f"v_{k}") / tolerances[k])).alias("s"), "m"))
    # only labels inside a group count; the others are left behind before the rounds
    ids = m.select("g", "m").distinct()
    inside = labels.select("a", "b", "same").where("a <> b and same is not null").join(ids.withColumnRenamed("m", "a"), "a")
    inside = inside.join(ids.withColumnRenamed("m", "b"), ["g", "b"])
    pairs = inside.select("g", F.col("a").alias("m"), F.col("b").alias("r"), "same").union(inside.select("g", "b", "a", "same"))
    pairs = stage(pairs.groupBy("g", "m", "r").agg(F.max("same").alias("same")), "cover")

    id_type = m.schema["m"].dataType
    open_ = m.withColumns({
        "place": F.lit(None).cast("int"), "near": F.lit(None).cast(f"struct<d:double,r:{id_type.simpleString()}>"), "differs": F.lit(False),
        "same_as": F.lit(None).cast(id_type), "human": F.lit(False), **{f"top_{k}": F.lit(None).cast("double") for k in kinds},
    })
    open_ = stage(open_, "cover")
    settled: list[DataFrame] = []
    place = 0
    while True:
        above = [F.col(f"v_{k}") - F.col(f"top_{k}") > 2 * tolerances[k] for k in kinds]
        far = reduce(lambda a, b: a | b, above)
        needs = F.lit(True) if place == 0 else F.col("place").isNull() & F.col("same_as").isNull() & (F.col("differs") | far)
        chosen = open_.where(needs).groupBy("g").agg(
            F.min_by(F.struct("m", F.col("differs").alias("by_label"), *(f"v_{k}" for k in kinds)), "rank").alias("new")
        )
        chosen = stage(chosen, "cover")  # a row per group
        settled.append(stage(open_.join(chosen.select("g"), "g", "left_anti"), "cover"))
        if chosen.isEmpty():
            break
        new = lambda c: F.col(f"new.{c}")
        told = pairs.join(chosen.select("g", new("m").alias("r")), ["g", "r"], "left_semi").drop("r")  # of the new ones alone
        met = open_.join(chosen, "g").withColumn("r", new("m")).join(told, ["g", "m"], "left")
        away = F.greatest(*((F.col(f"v_{k}") - new(f"v_{k}")) / tolerances[k] for k in kinds)) if len(kinds) > 1 else (F.col(f"v_{kinds[0]}") - new(f"v_{kinds[0]}")) / tolerances[kinds[0]]
        this = F.struct(away.alias("d"), F.col("r"))
        nearer = F.col("near").isNull() | (this < F.col("near"))
        is_new = F.col("m") == F.col("r")
        after = met.select(
            "g", "m", *(f"v_{k}" for k in kinds), "rank", F.when(is_new, F.lit(place)).otherwise(F.col("place")).alias("place"),
            F.when(nearer, this).otherwise(F.col("near")).alias("near"),
            F.when(nearer, F.coalesce(~F.col("same"), F.lit(False))).otherwise(F.col("differs")).alias("differs"),
            F.coalesce("same_as", F.when(F.col("same"), F.col("r"))).alias("same_as"),
            F.when(is_new, new("by_label")).otherwise(F.col("human")).alias("human"),
            *(F.greatest(F.col(f"top_{k}"), new(f"v_{k}")).alias(f"top_{k}") for k in kinds),
        )
        after = stage(after, "cover")
        discard(open_)
        discard(chosen)
        open_, place = after, place + 1
    return _fate(reduce(DataFrame.unionByName, settled), group, member, tolerances)


def _fate(m: DataFrame, group: str, member: str, tolerances: dict[str, float]) -> DataFrame:
    excess: dict[str, Column] = {k: F.col(f"v_{k}") - F.col(f"top_{k}") for k in tolerances}
    within = reduce(lambda a, b: a & b, [excess[k] <= t for k, t in tolerances.items()])
    rep, labelled = F.col("place").isNotNull(), F.col("same_as").isNotNull()
    return m.select(
        F.col("g").alias(group), F.col("m").alias(member), F.when(rep, "rep").when(labelled | within, "dup").otherwise("review").alias("status"),
        F.when(rep, F.lit(None)).otherwise(F.coalesce("same_as", "near.r")).alias("ref"), "place", F.when(rep, F.col("human")).otherwise(labelled).alias("human"),
        F.create_map(*(x for k, e in excess.items() for x in (F.lit(k), e))).alias("excess"),
    )
