"""From cut scenes to the normalized dataset tables, with reproducible tokens."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.operators.asof import forward, interpolate_pose, nearest_within
from trackloom.operators.intervals import interval_join
from trackloom.operators.ordered import Axis
from trackloom.operators.series import link_chain
from trackloom.plans.scene_yield import YieldParams
from trackloom.schema import TABLES, taxonomy
from trackloom.session import stage

# File suffix and format per modality
SUFFIX = {"lidar": ".pcd.bin", "radar": ".pcd", "camera": ".jpg"}
FORMAT = {"lidar": "pcd", "radar": "pcd", "camera": "jpg"}


@dataclass(frozen=True)
class BuildParams:
    """`stride`: every how many anchor frames a sample; `per_us`: stamp units per microsecond; `tolerance`: reach of
    the channels that are attached when they have a frame nearby; `sizes`: camera channel -> (height, width)."""

    yields: YieldParams
    stride: int
    per_us: int = 1
    tolerance: dict[str, int] = field(default_factory=dict)
    modality: dict[str, str] = field(default_factory=dict)
    sizes: dict[str, tuple[int, int]] = field(default_factory=dict)
    vehicle: str = "car"
    location: str = ""
    global_frame: str = ""

    def channels(self) -> list[str]:
        return [self.yields.anchor, *self.yields.gating, *self.tolerance]


def token(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("/", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts]), 256)


def _case(mapping: dict, col: str, default) -> Column:
    out = F.lit(default)
    for k, v in mapping.items():
        out = F.when(F.col(col) == k, F.lit(v)).otherwise(out)
    return out


def key_frames(scenes: DataFrame, b: BuildParams) -> DataFrame:
    """The samples: every stride-th anchor frame of a scene, with its camera stamps and tokens; one per instant."""
    p = b.yields
    inside = F.expr("(place - 1) % frames_per_scene")
    rows = scenes.where("scene_no is not null").where(inside % b.stride == 0)
    rows = rows.withColumn("scene_token", token(*p.keys, "segment", "scene_no")).dropDuplicates(["scene_token", p.at])
    return rows.select(*p.keys, p.at, *p.gating, "scene_token", token("scene_token", p.at).alias("token"))


def sample_table(keys: DataFrame, b: BuildParams) -> DataFrame:
    p = b.yields
    linked = link_chain(keys.select("scene_token", p.at, "token"), Axis(("scene_token",), p.at, p.span), "token")
    return linked.select("token", F.expr(f"{p.at} div {b.per_us}").alias("timestamp"), "scene_token", "prev", "next")


def scene_table(keys: DataFrame, b: BuildParams) -> DataFrame:
    """One row per scene; names are numbers in time order within the recording until official ones are assigned."""
    p = b.yields
    s = keys.groupBy(*p.keys, "scene_token").agg(
        F.count(F.lit(1)).cast("int").alias("nbr_samples"),
        F.min_by("token", p.at).alias("first_sample_token"),
        F.max_by("token", p.at).alias("last_sample_token"),
        F.min(p.at).alias("_start"),
    )
    return s.select(
        F.col("scene_token").alias("token"),
        F.concat_ws("-", F.lit("scene"), *p.keys, F.col("_start").cast("string")).alias("name"),
        F.lit("").alias("description"),
        token(F.lit("log"), *p.keys).alias("log_token"),
        "nbr_samples", "first_sample_token", "last_sample_token",
    )


def key_stamps(frames: DataFrame, keys: DataFrame, b: BuildParams, poses: DataFrame | None = None) -> DataFrame:
    """(scene_token, channel, at, key_token): the frame of every channel each sample is synchronized with.

    The anchor by its own stamp, gating channels by the chosen set, the others by the nearest frame within reach;
    when two samples of a scene claim one frame the later keeps it. With `poses`, only frames inside pose coverage
    can be attached by nearness.
    """
    p = b.yields
    fixed = F.array(
        F.struct(F.lit(p.anchor).alias("channel"), F.col(p.at).alias("at")),
        *[F.struct(F.lit(c).alias("channel"), F.col(c).alias("at")) for c in p.gating],
    )
    own = keys.select("scene_token", "token", F.col(p.at).alias("_sample_at"), F.explode(fixed).alias("_f"))
    own = own.select("scene_token", "_f.channel", F.col("_f.at").alias(p.at), "token", "_sample_at")
    claimed = own.groupBy("scene_token", "channel", p.at).agg(F.max_by("token", "_sample_at").alias("key_token"))
    if not b.tolerance:
        return claimed
    reach = _case(b.tolerance, p.channel, 0)
    loose = frames.where(F.col(p.channel).isin(list(b.tolerance))).select(*p.keys, p.channel, p.at)
    if poses is not None:
        cover = poses.groupBy(*p.keys).agg(F.min(p.at).alias("_lo"), F.max(p.at).alias("_hi"))
        loose = loose.join(cover, list(p.keys)).where(F.col(p.at).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")
    asked = keys.select(*p.keys, p.at, "scene_token", "token").withColumn(
        p.channel, F.explode(F.array(*[F.lit(c) for c in b.tolerance]))
    )
    near = nearest_within(
        asked, loose, [*p.keys, p.channel], p.at, [], p.span, reach, ["token"], per=("scene_token",)
    )
    got = near.select("scene_token", F.col(p.channel).alias("channel"), F.col("match")[p.at].alias(p.at), F.col("token").alias("key_token"))
    return claimed.unionByName(got)


def sample_data_rows(frames: DataFrame, keys: DataFrame, b: BuildParams, poses: DataFrame | None = None) -> DataFrame:
    """Every frame of every channel in a scene, tied to its sample: the synchronized one, else the one that follows."""
    p = b.yields
    spans = keys.groupBy(*p.keys, "scene_token").agg(F.min(p.at).alias("_from"), F.max(p.at).alias("_to"))
    wanted = frames.where(F.col(p.channel).isin(b.channels())).select(*p.keys, F.col(p.channel).alias("channel"), p.at)
    inside = interval_join(wanted, spans, list(p.keys), p.at, "_from", "_to", ["channel", p.at], p.scene_length)
    inside = inside.select("scene_token", "channel", p.at, F.lit(None).cast("string").alias("key_token"))
    rows = inside.unionByName(key_stamps(frames, keys, b, poses)).groupBy("scene_token", "channel", p.at).agg(
        F.max("key_token").alias("key_token")
    )
    samples = keys.select("scene_token", p.at, "token")
    tied = forward(rows, samples, ["scene_token"], p.at, ["token"], p.span)
    return tied.select(
        "scene_token", "channel", p.at,
        F.coalesce("key_token", F.col("match")["token"]).alias("sample_token"),
        F.col("key_token").isNotNull().alias("is_key_frame"),
    )


def sample_data_table(rows: DataFrame, b: BuildParams) -> DataFrame:
    p = b.yields
    t = rows.withColumn("token", token(F.lit("data"), "scene_token", "channel", p.at))
    linked = link_chain(t, Axis(("scene_token", "channel"), p.at, p.span), "token")
    folder = F.when(F.col("is_key_frame"), "samples").otherwise("sweeps")
    kind = _case(b.modality, "channel", "camera")
    suffix = F.when(kind == "lidar", SUFFIX["lidar"]).when(kind == "radar", SUFFIX["radar"]).otherwise(SUFFIX["camera"])
    form = F.when(kind == "camera", FORMAT["camera"]).otherwise(FORMAT["lidar"])
    return linked.select(
        "token", "sample_token",
        token(F.lit("pose"), "scene_token", "channel", p.at).alias("ego_pose_token"),
        token(F.lit("calibrated"), "channel").alias("calibrated_sensor_token"),
        F.concat(F.concat_ws("/", folder, "channel", "token"), suffix).alias("filename"),
        form.alias("fileformat"), "is_key_frame",
        _case({c: s[0] for c, s in b.sizes.items()}, "channel", 0).alias("height"),
        _case({c: s[1] for c, s in b.sizes.items()}, "channel", 0).alias("width"),
        F.expr(f"{p.at} div {b.per_us}").alias("timestamp"), "prev", "next",
    )


def ego_pose_rows(rows: DataFrame, scenes: DataFrame, poses: DataFrame, b: BuildParams) -> DataFrame:
    """One interpolated pose per frame row; frames outside pose coverage stop the build."""
    p = b.yields
    asked = rows.join(scenes, "scene_token").select(*p.keys, "scene_token", "channel", p.at)
    at = interpolate_pose(asked, poses, list(p.keys), p.at, p.span)
    return at.select(
        token(F.lit("pose"), "scene_token", "channel", p.at).alias("token"), "x", "y", "z", "qw", "qx", "qy", "qz",
        F.expr(f"{p.at} div {b.per_us}").alias("timestamp"),
    )


def build_tables(frames: DataFrame, poses: DataFrame, scenes: DataFrame, calibration: DataFrame, b: BuildParams) -> dict[str, DataFrame]:
    """All tables of the recordings in `frames`; label tables come empty.

    `scenes` is the output of `cut_scenes`; `calibration` holds one row per channel: channel, translation, rotation
    (sensor in the ego frame), camera_intrinsic (empty for other sensors).
    """
    p = b.yields
    spark = frames.sparkSession
    keys = stage(key_frames(scenes, b), "keys")
    rows = stage(sample_data_rows(frames, keys, b, poses), "rows")
    scene_of = keys.select(*p.keys, "scene_token").distinct()
    pose = ego_pose_rows(rows, scene_of, poses, b).select(
        "token", F.array("x", "y", "z").alias("translation"), F.array("qw", "qx", "qy", "qz").alias("rotation"), "timestamp"
    )
    logs = frames.groupBy(*p.keys).agg(F.min(p.at).alias("_first"))
    day = F.to_date(F.timestamp_micros(F.expr(f"_first div {b.per_us}")))
    log = logs.select(
        token(F.lit("log"), *p.keys).alias("token"), F.concat_ws("/", *p.keys).alias("logfile"), F.lit(b.vehicle).alias("vehicle"),
        day.cast("string").alias("date_captured"), F.lit(b.location).alias("location"), F.lit(b.global_frame).alias("global_frame"),
    )
    sensors = [(c, b.modality.get(c, "camera")) for c in b.channels()]
    sensor = spark.createDataFrame(sensors, "channel string, modality string").select(
        token(F.lit("sensor"), "channel").alias("token"), "channel", "modality"
    )
    calibrated = calibration.select(
        token(F.lit("calibrated"), "channel").alias("token"), token(F.lit("sensor"), "channel").alias("sensor_token"),
        "translation", "rotation", "camera_intrinsic",
    )
    maps = log.select(
        token(F.lit("map"), "token").alias("token"), F.lit("semantic_prior").alias("category"),
        F.lit("maps/placeholder.png").alias("filename"), F.array("token").alias("log_tokens"),
    )
    out = {
        "sensor": sensor, "calibrated_sensor": calibrated, "log": log, "scene": scene_table(keys, b),
        "sample": sample_table(keys, b), "sample_data": sample_data_table(rows, b), "ego_pose": pose, "map": maps,
        "sample_annotation": spark.createDataFrame([], TABLES["sample_annotation"]),
        "instance": spark.createDataFrame([], TABLES["instance"]),
        **taxonomy(spark),
    }
    return {k: out[k].select(*[c.split(" ")[0] for c in _columns(k)]) for k in TABLES}


def _columns(table: str) -> list[str]:
    return TABLES[table].split(", ")
