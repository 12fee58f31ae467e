"""Names and labels: route keys, topic groups, slugs, sizes, recording names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a recording is named (course, number, start time).
RECORDING = r"^([A-Z][A-Z0-9]*)-(\d+)_(\d{4}(?:-\d\d){5})$"

# Words that tell which sensor family a topic belongs to.
LIDAR_WORDS = ("lidar", "velodyne", "ouster")
INS_WORDS = ("novatel", "gnss", "gps", "/ins", "imu")


def _any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def route_key(name: Column) -> Column:
    """Sort key (course, number, name): A-2 comes before A-10, unnamed routes last."""
    course = F.regexp_extract(name, r"^([A-Za-z]+)-(\d+)", 1)
    number = F.regexp_extract(name, r"^([A-Za-z]+)-(\d+)", 2)
    named = course != ""
    return F.struct(
        F.when(named, course).otherwise("~").alias("course"),
        F.when(named, number.try_cast("decimal(38,0)")).otherwise(0).alias("number"),
        name.alias("name"),
    )


def recording_parts(name: Column) -> Column:
    """Struct (course, number, started) of a recording name; nulls where the name does not fit."""
    hit = name.rlike(RECORDING)
    part = lambda i: F.when(hit, F.regexp_extract(name, RECORDING, i))
    return F.struct(
        part(1).alias("course"), part(2).cast("int").alias("number"),
        F.to_timestamp(part(3), "yyyy-MM-dd-HH-mm-ss").alias("started"),
    )


def sensor_group(topic: Column, kind: Column) -> Column:
    """Which sensor family a topic belongs to: 0 images, 1 LiDAR, 2 radar, 3 GNSS/INS, 4 CAN, 5 status, 6 other."""
    t, k = F.lower(topic), F.lower(kind)
    status = t.contains("camera_info") | k.endswith("camerainfo") | (t.contains("lidar") & t.contains("status"))
    image = k.endswith("compressedimage") | k.endswith("/image") | (t.contains("camera") & k.contains("image"))
    lidar = (k.endswith("pointcloud2") & ~t.contains("radar")) | _any(t, LIDAR_WORDS)
    ins = _any(t, INS_WORDS)
    can = F.replace(t, F.lit("scan"), F.lit("")).contains("can")
    return (
        F.when(status, 5).when(image, 0).when(lidar, 1).when(t.contains("radar"), 2).when(ins, 3).when(can, 4).otherwise(6)
    )


def topic_slug(topic: Column) -> Column:
    """A topic as a file name: outer slashes dropped, inner ones as double underscores."""
    return F.replace(F.btrim(topic, F.lit("/")), F.lit("/"), F.lit("__"))


def pair_key(a: Column, b: Column) -> Column:
    """Order-free key of a pair."""
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def human_size(size: Column) -> Column:
    """Bytes with a unit: whole B and KB, one decimal above; ties round to even."""
    v = size.cast("double")

    def label(power: int, digits: int, unit: str) -> Column:
        return F.format_string(f"%.{digits}f {unit}", F.bround(v / 1024.0**power, digits))

    out = label(4, 1, "TB")
    for power, digits, unit in ((3, 1, "GB"), (2, 1, "MB"), (1, 0, "KB"), (0, 0, "B")):
        out = F.when(v < 1024.0 ** (power + 1), label(power, digits, unit)).otherwise(out)
    return out


def overlap_alpha(k: Column, alpha: float) -> Column:
    """Opacity of k overlapping strokes of one opacity."""
    return 1 - F.pow(F.lit(1 - alpha), k)


def version_index(path: Column, base: str) -> Column:
    """1 for `base`, n for `base_n`, null for other names."""
    pattern = rf"(?:^|/){base}(?:_([2-9]|[1-9]\d+))?$"
    suffix = F.regexp_extract(path, pattern, 1)
    fits = path.rlike(pattern)
    return F.when(fits, F.when(suffix == "", 1).otherwise(suffix.cast("int")))


def course(name: Column) -> Column:
    return F.split(name, "-")[0]
