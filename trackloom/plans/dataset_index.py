"""Reading views of a dataset: frames with their scene and channel, sample payloads, ego status, decimated routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.operators.asof import nearest
from trackloom.operators.ordered import Axis
from trackloom.operators.series import every_kth


def frames(t: dict[str, DataFrame]) -> DataFrame:
    """Every frame with log, scene, channel and modality: the chain of references resolved."""
    channel = t["calibrated_sensor"].select(F.col("token").alias("calibrated_sensor_token"), "sensor_token").join(
        t["sensor"].select(F.col("token").alias("sensor_token"), "channel", "modality"), "sensor_token"
    )
    scene = t["scene"].select(F.col("token").alias("scene_token"), F.col("name").alias("scene"), "log_token").join(
        t["log"].select(F.col("token").alias("log_token"), "logfile"), "log_token"
    )
    sample = t["sample"].select(F.col("token").alias("sample_token"), "scene_token", F.col("timestamp").alias("sample_timestamp"))
    return t["sample_data"].join(channel, "calibrated_sensor_token").join(sample, "sample_token").join(scene, "scene_token")


def sample_payload(t: dict[str, DataFrame], anchor: str) -> DataFrame:
    """Key frames with pose and calibration, and `dt_ms` to the sample's anchor frame (or to the sample without one)."""
    key = frames(t).where("is_key_frame")
    ref = key.where(F.col("channel") == anchor).select("sample_token", F.col("timestamp").alias("_ref"))
    pose = t["ego_pose"].select(F.col("token").alias("ego_pose_token"), F.col("translation").alias("ego_translation"), F.col("rotation").alias("ego_rotation"))
    calib = t["calibrated_sensor"].select(
        F.col("token").alias("calibrated_sensor_token"), F.col("translation").alias("calib_translation"), F.col("rotation").alias("calib_rotation"), "camera_intrinsic"
    )
    j = key.join(ref, "sample_token", "left").join(pose, "ego_pose_token").join(calib, "calibrated_sensor_token")
    dt = (F.col("timestamp") - F.coalesce("_ref", "sample_timestamp")) / 1000.0
    return j.select("sample_token", "scene", "channel", "filename", "timestamp", dt.alias("dt_ms"), "ego_translation", "ego_rotation",
                    "calib_translation", "calib_rotation", "camera_intrinsic")


def ego_status(samples: DataFrame, track: DataFrame, scene: str, at: str, columns: list[str], span: int) -> DataFrame:
    """Adds the nearest track row of the sample's scene (the later one on a tie) and its distance in time."""
    n = nearest(samples, track, [scene], at, columns, span, later_wins=True)
    return n.select(
        *samples.columns, (F.col("match")[at] - F.col(at)).alias("dt"), *[F.col("match")[c].alias(c) for c in columns]
    )


def route(track: DataFrame, scene: str, at: str, every: int, span: int) -> DataFrame:
    """Every k-th row of each scene's track."""
    return every_kth(track, Axis((scene,), at, span), every)


def buffered(play: DataFrame, scenes: DataFrame, ready: DataFrame) -> DataFrame:
    """Per scene: how far from its start every channel is ready without a hole, in microseconds, and the ready share.

    `play`: scene, channel, timestamp, filename; `scenes`: scene, start, end; `ready`: filename."""
    r = ready.select("filename").distinct().withColumn("_ok", F.lit(True))
    f = play.join(r, "filename", "left")
    per = f.groupBy("scene").agg(
        F.min(F.when(F.col("_ok").isNull(), F.col("timestamp"))).alias("_hole"), F.count("_ok").alias("_have"), F.count(F.lit(1)).alias("_all")
    )
    j = scenes.join(per, "scene", "left")
    dur = F.col("end") - F.col("start")
    return j.select(
        "scene", dur.alias("duration"),
        F.least(dur, F.greatest(F.coalesce(F.col("_hole") - F.col("start"), dur), F.lit(0))).alias("buffered"),
        F.coalesce(F.col("_have") / F.col("_all"), F.lit(1.0)).alias("share"),
    )
