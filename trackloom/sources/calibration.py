"""Calibration folders: one folder per channel with small text matrices; channels without one get defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The text files of a channel and what each holds.
FILES = {"intrinsic.txt": "intrinsic", "distortion.txt": "distortion", "quat_r.txt": "rotation", "r.txt": "rotation", "t.txt": "translation"}
CAMERA_FILES = ["intrinsic", "distortion", "rotation", "translation"]
OTHER_FILES = ["rotation", "translation"]


def read_calibration(spark: SparkSession, root: str) -> DataFrame:
    """(channel, intrinsic, distortion, rotation, translation) as flat arrays of numbers; null for a missing file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True)
    parts = F.split(F.input_file_name(), "/")
    rows = files.select(F.element_at(parts, -2).alias("channel"), F.element_at(parts, -1).alias("file"), "value")
    numbers = F.transform(F.filter(F.split("value", r"[\s,\[\]]+"), lambda w: w != ""), lambda w: w.cast("double"))
    named = rows.select("channel", "file", numbers.alias("numbers"))
    return named.groupBy("channel").agg(
        *[
            F.max_by("numbers", F.when(F.col("file").isin([f for f, k in FILES.items() if k == kind]), F.col("file"))).alias(kind)
            for kind in CAMERA_FILES
        ]
    )


def missing(calibration: DataFrame, channels: DataFrame) -> DataFrame:
    """The channels (channel, modality) that lack one of their files."""
    j = channels.join(calibration, "channel", "left")
    lacks = F.col("rotation").isNull() | F.col("translation").isNull()
    camera = (F.col("modality") == "camera") & (F.col("intrinsic").isNull() | F.col("distortion").isNull())
    return j.where(lacks | camera).select("channel")


def with_defaults(calibration: DataFrame, channels: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every channel with its calibration, or the default of a channel that lacks one: identity pose, no distortion
    and a 90 degree pinhole for the image size (`sizes`: channel, height, width)."""
    gap = missing(calibration, channels).withColumn("_gap", F.lit(True))
    j = channels.join(calibration, "channel", "left").join(gap, "channel", "left").join(sizes, "channel", "left")
    use = F.col("_gap").isNull()
    half = F.col("width") / 2
    pinhole = F.array(half, F.lit(0.0), half, F.lit(0.0), half, F.col("height") / 2, F.lit(0.0), F.lit(0.0), F.lit(1.0))
    camera = F.col("modality") == "camera"
    numbers = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    return j.select(
        "channel", "modality",
        F.when(use, F.col("rotation")).otherwise(numbers(1, 0, 0, 0)).alias("rotation"),
        F.when(use, F.col("translation")).otherwise(numbers(0, 0, 0)).alias("translation"),
        F.when(camera, F.when(use, F.col("intrinsic")).otherwise(pinhole)).alias("intrinsic"),
        F.when(camera, F.when(use, F.col("distortion")).otherwise(numbers(0, 0, 0, 0, 0))).alias("distortion"),
    )
