"""Table-level changes of a dataset: prune with cascade, renumber, merge, lock, mirror, drop and sync plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.operators.ordered import Axis, position, scan
from trackloom.session import stage


def semi(df: DataFrame, column: str, keep: DataFrame, key: str = "token") -> DataFrame:
    return df.join(keep.select(F.col(key).alias(column)).distinct(), column, "left_semi")


def anti(df: DataFrame, column: str, drop: DataFrame, key: str = "token") -> DataFrame:
    return df.join(drop.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def numbered(df: DataFrame, order: list[str], out: str = "rank") -> DataFrame:
    """Adds the 1-based rank in a total order over the whole table, without one task holding it.

    Rows are range-partitioned and counted per partition; the table is written first so the partitions stay put.
    """
    parted = df.repartitionByRange(*order)
    laid = stage(parted.withColumn("_part", F.spark_partition_id().cast("long")), "numbered")
    return scan(laid, Axis((), "_part", 1, tuple(order)), {out: position()}).drop("_part")


def renumber(names: DataFrame, survivors: DataFrame, name: str) -> DataFrame:
    """(name, new_name): survivors in name order take the sorted names without gaps, so the freed names are the last."""
    pool = numbered(names.select(name).distinct(), [name], "_rank")
    left = numbered(survivors.select(name).distinct(), [name], "_rank")
    return left.join(pool.withColumnRenamed(name, "new_name"), "_rank").select(name, "new_name")


def prune(tables: dict[str, DataFrame], deleted: DataFrame, rename: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables without the deleted scenes (column `token`) and everything only they use; survivors renamed."""
    t = dict(tables)
    gone_sample = semi(t["sample"], "scene_token", deleted)
    gone_data = semi(t["sample_data"], "sample_token", gone_sample)
    t["scene"] = anti(t["scene"], "token", deleted)
    t["sample"] = anti(t["sample"], "scene_token", deleted)
    t["sample_data"] = anti(t["sample_data"], "sample_token", gone_sample)
    t["ego_pose"] = anti(t["ego_pose"], "token", gone_data, "ego_pose_token")
    if "sample_annotation" in t:
        t["sample_annotation"] = anti(t["sample_annotation"], "sample_token", gone_sample)
        if "instance" in t:
            t["instance"] = semi(t["instance"], "first_annotation_token", t["sample_annotation"])
    t["log"] = semi(t["log"], "token", t["scene"], "log_token")
    live = t["map"].withColumn("_log", F.explode("log_tokens")).join(
        t["log"].select(F.col("token").alias("_log")), "_log", "left_semi"
    )
    lists = live.groupBy("token").agg(F.sort_array(F.collect_set("_log")).alias("_logs"))
    kept = t["map"].join(lists, "token", "left")
    t["map"] = kept.withColumn("log_tokens", F.coalesce("_logs", F.array().cast("array<string>"))).select(*t["map"].columns)
    if rename is not None:
        s = t["scene"].join(rename, "name", "left")
        t["scene"] = s.withColumn("name", F.coalesce("new_name", "name")).select(*tables["scene"].columns)
    return {k: v.select(*tables[k].columns) for k, v in t.items()}


def deletion_plan(
    scenes: DataFrame, decisions: DataFrame, locked: DataFrame, logs: DataFrame | None = None
) -> DataFrame:
    """(name, token, action): delete (confirmed drop, not locked), held (confirmed drop, locked) or stay.

    `decisions` has (name, decision); with `logs` (log_token) only scenes of these logs are considered.
    """
    s = scenes.join(decisions.select("name", "decision"), "name", "left")
    s = s.join(locked.select("token").distinct().withColumn("_lock", F.lit(True)), "token", "left")
    scope = F.lit(True)
    if logs is not None:
        s = s.join(logs.select("log_token").distinct().withColumn("_in", F.lit(True)), "log_token", "left")
        scope = F.coalesce("_in", F.lit(False))
    drop = scope & F.coalesce(F.col("decision") == "drop", F.lit(False))
    held = F.coalesce("_lock", F.lit(False))
    return s.select(
        "name", "token", F.when(drop & held, "held").when(drop, "delete").otherwise("stay").alias("action")
    )


def merge_new(existing: DataFrame, new: DataFrame, natural: list[str] | None = None) -> DataFrame:
    """Existing rows plus the new ones; with a natural key, rows whose key exists are not added again."""
    if natural:
        new = new.join(existing.select(*natural).distinct(), natural, "left_anti")
    return existing.unionByName(new)


def not_imported(recordings: DataFrame, key: str, *done: DataFrame) -> DataFrame:
    """Recordings no earlier import knows."""
    for d in done:
        recordings = recordings.join(d.select(key).distinct(), key, "left_anti")
    return recordings


def free_names(official: DataFrame, used: DataFrame, name: str, refused: list[int], number: Column) -> DataFrame:
    """Official names nobody uses, without the refused numbers."""
    return official.where(~number.isin(refused)).join(used.select(name).distinct(), name, "left_anti")


def twin_keys(scenes: DataFrame, samples: DataFrame, logs: DataFrame) -> DataFrame:
    """(token, name, log_token, twin_key): log name plus the scene's sorted sample times. A scene is seconds long."""
    times = samples.groupBy(F.col("scene_token").alias("token")).agg(F.sort_array(F.collect_list("timestamp")).alias("_ts"))
    lg = logs.select(F.col("token").alias("log_token"), "logfile")
    s = scenes.select("token", "name", "log_token").join(lg, "log_token").join(times, "token", "left")
    key = F.struct("logfile", F.coalesce("_ts", F.array().cast("array<bigint>")).alias("times"))
    return s.select("token", "name", "log_token", "logfile", F.sha2(F.to_json(key), 256).alias("twin_key"))


def compare_twins(a: DataFrame, b: DataFrame, a_logs: DataFrame, b_logs: DataFrame) -> DataFrame:
    """How set b stands against set a, from `twin_keys` of both: (kind, a_name, b_name).

    drop: b's scene has no twin though a holds the log; no_twin: the reverse; renamed: twins with unlike names;
    same: twins with one name.
    """
    left = a.select("twin_key", F.col("name").alias("a_name"), F.col("logfile").alias("a_log"))
    right = b.select("twin_key", F.col("name").alias("b_name"), F.col("logfile").alias("b_log"))
    both = left.join(right, "twin_key", "full")
    both = both.join(a_logs.select(F.col("logfile").alias("b_log")).distinct().withColumn("_in_a", F.lit(True)), "b_log", "left")
    both = both.join(b_logs.select(F.col("logfile").alias("a_log")).distinct().withColumn("_in_b", F.lit(True)), "a_log", "left")
    kind = (
        F.when(F.col("a_name").isNull() & F.col("_in_a"), "drop")
        .when(F.col("b_name").isNull() & F.col("_in_b"), "no_twin")
        .when(F.col("a_name") != F.col("b_name"), "renamed")
        .when(F.col("a_name") == F.col("b_name"), "same")
    )
    return both.select(kind.alias("kind"), "a_name", "b_name").where("kind is not null")


def mirror_tokens(rounds: DataFrame, twins: DataFrame) -> DataFrame:
    """Lock rounds (round, tokens ARRAY) of one set expressed in its twin's tokens: (round, token)."""
    flat = rounds.select("round", F.explode("tokens").alias("token"))
    return flat.join(twins.select("token", "twin_token"), "token").select("round", F.col("twin_token").alias("token"))


def scene_state(scenes: DataFrame, locked: DataFrame, human: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Adds `state`: locked, else the human decision, else the candidate kind, else pass."""
    s = scenes.join(locked.select(key).distinct().withColumn("_l", F.lit("locked")), key, "left")
    s = s.join(human.select(key, F.col("decision").alias("_h")), key, "left")
    s = s.join(candidates.select(key, F.col("kind").alias("_c")), key, "left")
    return s.select(*scenes.columns, F.coalesce("_l", "_h", "_c", F.lit("pass")).alias("state"))


def drop_plan(scenes: DataFrame, dropped: DataFrame, published: DataFrame, locked: DataFrame, twins: DataFrame) -> DataFrame:
    """Adds `reason`: the first rule that keeps a scene's files, or "go".

    dropped already, not published, not locked, no twin in the full set (twin under another name counts as none).
    """
    s = scenes
    for df, flag in ((dropped, "_d"), (published, "_p"), (locked, "_l")):
        s = s.join(df.select("token").distinct().withColumn(flag, F.lit(True)), "token", "left")
    s = s.join(twins.select("token", F.col("name").alias("_twin")), "token", "left")
    reason = (
        F.when(F.col("_d"), "dropped already")
        .when(F.col("_p").isNull(), "not published")
        .when(F.col("_l").isNull(), "not locked")
        .when(F.coalesce(F.col("_twin") != F.col("name"), F.lit(True)), "no twin in the full set")
        .otherwise("go")
    )
    return s.select(*scenes.columns, reason.alias("reason"))


def outdated_shards(manifest: DataFrame, state: DataFrame) -> DataFrame:
    """Shards whose (path, sha256) the applied state does not hold."""
    return manifest.join(state.select("path", "sha256"), ["path", "sha256"], "left_anti")


def identical_blobs(a: DataFrame, b: DataFrame, keys: list[str], size: str, digest: str) -> DataFrame:
    """Rows of both sets with one key, classed: identical, size differs, bytes differ, no twin."""
    r = b.select(*keys, F.col(size).alias("_size"), F.col(digest).alias("_digest"))
    j = a.join(r, keys, "left")
    cls = (
        F.when(F.col("_size").isNull(), "no twin")
        .when(F.col("_size") != F.col(size), "size differs")
        .when(F.col("_digest") != F.col(digest), "bytes differ")
        .otherwise("identical")
    )
    return j.select(*a.columns, cls.alias("twin"))


def content_groups(df: DataFrame, ident: str, content: str) -> DataFrame:
    """(digest, keep, copies, bytes): one row per distinct content with its smallest id."""
    d = df.select(ident, F.sha2(F.col(content).cast("binary"), 256).alias("digest"), F.octet_length(content).alias("_b"))
    return d.groupBy("digest").agg(
        F.min(ident).alias("keep"), F.count(F.lit(1)).alias("copies"), F.max("_b").cast("long").alias("bytes")
    )


def trusted_first(chunks: DataFrame, keys: list[str], trusted: str, seq: str) -> DataFrame:
    """One row per recovered chunk: a trusted reading wins, then the earliest."""
    rest = [c for c in chunks.columns if c not in keys]
    order = F.struct((~F.col(trusted)).alias("t"), F.col(seq).alias("s"))
    best = chunks.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return best.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*chunks.columns)


def first_names(pool: DataFrame, name: str, n: int) -> DataFrame:
    """The first `n` names of a pool in order; an error if the pool is too small. Only its size reaches the driver."""
    names = pool.select(name).distinct()
    if names.count() < n:
        raise ValueError(f"fewer than {n} free names")
    return numbered(names, [name], "_rank").where(F.col("_rank") <= n).select(name)


def ordered_union(lists: list[tuple[DataFrame, str]], name: str) -> DataFrame:
    """(name, place): the names of several lists in order of first appearance, without repeats.

    Each list comes with the column that orders it; earlier lists go first.
    """
    rows = [df.select(F.col(name), F.lit(i).alias("_list"), F.col(order).cast("long").alias("_at")) for i, (df, order) in enumerate(lists)]
    first = reduce(DataFrame.unionByName, rows).groupBy(name).agg(F.min(F.struct("_list", "_at")).alias("_f"))
    flat = first.select(name, F.col("_f._list").alias("_list"), F.col("_f._at").alias("_at"))
    return numbered(flat, ["_list", "_at", name], "place").select(name, "place")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "place") -> DataFrame:
    """The first `k` rows of every key in a total order, with their place. Spark limits each group before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w).cast("long")).where(F.col(out) <= k)
