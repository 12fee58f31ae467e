"""Audits of a normalized dataset: every broken reference, chain and count as one table of problems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (table, column, referenced table): the single-valued references of the dataset
REFERENCES = [
    ("calibrated_sensor", "sensor_token", "sensor"),
    ("scene", "log_token", "log"),
    ("scene", "first_sample_token", "sample"),
    ("scene", "last_sample_token", "sample"),
    ("sample", "scene_token", "scene"),
    ("sample_data", "sample_token", "sample"),
    ("sample_data", "ego_pose_token", "ego_pose"),
    ("sample_data", "calibrated_sensor_token", "calibrated_sensor"),
    ("sample_annotation", "sample_token", "sample"),
    ("sample_annotation", "instance_token", "instance"),
    ("instance", "first_annotation_token", "sample_annotation"),
    ("instance", "last_annotation_token", "sample_annotation"),
]
CHAINS = ["sample", "sample_data"]


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference has no parent row."""
    return child.join(parent.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def broken_links(chain: DataFrame, token: str, prev: str, next_: str) -> DataFrame:
    """(token, side): rows whose neighbour is missing or does not point back. The empty string ends a chain."""

    def side(out: str, back: str) -> DataFrame:
        there = chain.select(F.col(token).alias(out), F.col(back).alias("_back"))
        asked = chain.where(F.col(out) != "").select(token, out)
        bad = asked.join(there, out, "left").where(F.col("_back").isNull() | (F.col("_back") != F.col(token)))
        return bad.select(token, F.lit(out).alias("side"))

    return side(prev, next_).unionByName(side(next_, prev))


def chain_counts(chain: DataFrame, group: str, prev: str, next_: str) -> DataFrame:
    """Per group: rows, heads (no prev) and tails (no next). With links that point back at each other and one head and
    one tail, every row of the group lies on the one chain unless a ring is left over (see `rings`)."""
    return chain.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(prev) == "").alias("heads"), F.count_if(F.col(next_) == "").alias("tails")
    )


def off_chain(chain: DataFrame, token: str, group: str, next_: str, order: str) -> DataFrame:
    """Links that leave their group or do not go forward in `order`; a ring or a side chain has at least one."""
    there = chain.select(F.col(token).alias(next_), F.col(group).alias("_g"), F.col(order).alias("_o"))
    asked = chain.where(F.col(next_) != "").select(token, group, order, next_)
    return asked.join(there, next_).where((F.col("_g") != F.col(group)) | (F.col("_o") <= F.col(order))).select(token)


def dataset_problems(tables: dict[str, DataFrame]) -> DataFrame:
    """(check, token): every broken rule of the 13 tables. An empty result means the set is whole."""

    def found(df: DataFrame, check: str, token: str | Column) -> DataFrame:
        col = F.col(token) if isinstance(token, str) else token
        return df.select(F.lit(check).alias("check"), col.alias("token"))

    parts = []
    for table, column, parent in REFERENCES:
        if table in tables and parent in tables:
            parts.append(found(orphans(tables[table], column, tables[parent], "token"), f"{table}.{column}", "token"))
    for table in CHAINS:
        if table in tables:
            bad = broken_links(tables[table], "token", "prev", "next")
            parts.append(found(bad, f"{table} links", "token"))
    names = tables["scene"].groupBy("name").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts.append(found(names, "scene.name repeated", "name"))

    sample, scene = tables["sample"], tables["scene"]
    per = chain_counts(sample, "scene_token", "prev", "next")
    sized = scene.join(per, scene["token"] == per["scene_token"], "left")
    wrong = (
        F.col("n").isNull() | (F.col("n") != F.col("nbr_samples")) | (F.col("heads") != 1) | (F.col("tails") != 1)
    )
    parts.append(found(sized.where(wrong), "scene chain length", scene["token"]))
    parts.append(found(off_chain(sample, "token", "scene_token", "next", "timestamp"), "sample chain order", "token"))
    for end, column, empty in (("first", "first_sample_token", "prev"), ("last", "last_sample_token", "next")):
        s = sample.select(F.col("token").alias(column), F.col("scene_token").alias("_scene"), F.col(empty).alias("_end"))
        bad = scene.join(s, column).where((F.col("_scene") != F.col("token")) | (F.col("_end") != ""))
        parts.append(found(bad, f"scene {end} sample", "token"))
    mapped = tables["map"].select(F.explode("log_tokens").alias("token")).distinct()
    parts.append(found(tables["log"].join(mapped, "token", "left_anti"), "log without map", "token"))
    parts.append(found(mapped.join(tables["log"].select("token"), "token", "left_anti"), "map of unknown log", "token"))
    if "sample_annotation" in tables:
        ann = tables["sample_annotation"]
        for side in ("prev", "next"):
            asked = ann.where(F.col(side) != "").select("token", side)
            parts.append(found(orphans(asked, side, ann, "token"), f"sample_annotation.{side}", "token"))
    return reduce(DataFrame.unionByName, parts)


def missing_files(sample_data: DataFrame, listing: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """Key frames whose file is not in the listing; scenes in `dropped` (scene_token) are exempt.

    `sample_data` carries scene_token; `listing` has one column `filename`.
    """
    keys = sample_data.where("is_key_frame")
    if dropped is not None:
        keys = keys.join(dropped.select("scene_token").distinct(), "scene_token", "left_anti")
    return keys.join(listing.select("filename").distinct(), "filename", "left_anti")
