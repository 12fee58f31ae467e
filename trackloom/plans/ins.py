"""Receiver and IMU rows to poses and rates, and the per-scene motion messages cut from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.functions import geodesy, rotation
from trackloom.operators.asof import forward, interpolate, interpolate_pose
from trackloom.operators.intervals import interval_join
from trackloom.operators.ordered import Axis, position, scan
from trackloom.operators.series import unique_by_time

POSE = ["x", "y", "z", "qw", "qx", "qy", "qz", "vx", "vy", "vz"]
RATES = ["ax", "ay", "az", "wx", "wy", "wz"]


def receiver_poses(rows: DataFrame, keys: list[str], at: str, seq: list[str], origin: tuple[float, float, float]) -> DataFrame:
    """(keys, at, position, quaternion, velocity in the ego frame, lat, lon, height, status), one row per instant.

    Input columns: lat, lon, height, v_north, v_east, v_up, roll, pitch, azimuth, status (degrees, metres, m/s).
    """
    one = unique_by_time(rows, keys, at, seq)
    e, n, u = geodesy.to_enu(F.col("lat"), F.col("lon"), F.col("height"), origin)
    q = rotation.receiver_attitude(F.col("roll"), F.col("pitch"), F.col("azimuth"))
    flat = one.select(
        *keys, at, "lat", "lon", "height", "status", "v_north", "v_east", "v_up",
        e.alias("x"), n.alias("y"), u.alias("z"), *[c.alias(k) for c, k in zip(q, ("qw", "qx", "qy", "qz"))],
    )
    back = rotation.transpose(rotation.to_matrix(rotation.quat()))
    v = rotation.rotate(back, (F.col("v_east"), F.col("v_north"), F.col("v_up")))
    return flat.select(
        *keys, at, "x", "y", "z", "qw", "qx", "qy", "qz", *[c.alias(k) for c, k in zip(v, ("vx", "vy", "vz"))],
        "lat", "lon", "height", "status",
    )


def odometry_poses(
    rows: DataFrame, keys: list[str], at: str, seq: list[str], origin: tuple[float, float, float], zone: int, undulation: float
) -> DataFrame:
    """Poses from UTM odometry with sea-level heights, for recordings without receiver rows.

    Input columns: x, y, z (UTM, above the geoid), qw..qz, vx, vy, vz (ego frame)."""
    one = unique_by_time(rows, keys, at, seq)
    lat, lon = geodesy.from_utm(F.col("x"), F.col("y"), zone)
    geo = one.select(*keys, at, lat.alias("_lat"), lon.alias("_lon"), (F.col("z") + undulation).alias("_h"),
                     "qw", "qx", "qy", "qz", "vx", "vy", "vz")
    e, n, u = geodesy.to_enu(F.col("_lat"), F.col("_lon"), F.col("_h"), origin)
    return geo.select(*keys, at, e.alias("x"), n.alias("y"), u.alias("z"), "qw", "qx", "qy", "qz", "vx", "vy", "vz")


def imu_rates(rows: DataFrame, keys: list[str], at: str, seq: list[str], span: int, ticks: float) -> DataFrame:
    """Accelerations and turn rates in the ego frame from summed increments, plus the measured IMU rate.

    Input columns: count, pitch_rate, roll_rate, yaw_rate, lat_acc, lon_acc, vert_acc. The IMU rate of a recording
    is the samples after its first row over its length.
    """
    one = unique_by_time(rows, keys, at, seq).where("count > 0")
    first = scan(one.select(*keys, at, "count"), Axis(tuple(keys), at, span), {"_pos": position()})
    hz = first.groupBy(*keys).agg(
        (F.sum(F.when(F.col("_pos") > 1, F.col("count")).otherwise(0)) * ticks / (F.max(at) - F.min(at))).alias("imu_hz")
    )
    k = F.col("imu_hz") / F.col("count")
    return one.join(hz, keys).select(
        *keys, at,
        (F.col("lon_acc") * k).alias("ax"), (-F.col("lat_acc") * k).alias("ay"), (F.col("vert_acc") * k).alias("az"),
        (F.col("roll_rate") * k).alias("wx"), (-F.col("pitch_rate") * k).alias("wy"), (F.col("yaw_rate") * k).alias("wz"),
        "imu_hz",
    )


def scene_poses(
    poses: DataFrame, imu: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, scene: str,
    margin: int, finest: int, span: int,
) -> DataFrame:
    """The pose messages of every scene, widened by `margin` at both ends, with accelerations and rates interpolated.

    A pose may belong to two neighbouring scenes."""
    with_rates = interpolate(poses, imu, keys, at, RATES, span)
    return interval_join(with_rates, spans.select(*keys, scene, start, end), keys, at, start, end, [at], finest, margin).drop(start, end)


def scene_imu(
    imu: DataFrame, poses: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, scene: str,
    margin: int, finest: int, span: int,
) -> DataFrame:
    """The IMU messages of every scene with the orientation at their time; those outside pose coverage are left out."""
    turned = interpolate_pose(imu, poses, keys, at, span, outside="null").where("qw is not null").drop("x", "y", "z")
    return interval_join(turned, spans.select(*keys, scene, start, end), keys, at, start, end, [at], finest, margin).drop(start, end)


def receiver_status(poses: DataFrame, receiver: DataFrame, keys: list[str], at: str, span: int) -> DataFrame:
    """Adds the solution status of the first receiver row at or after each pose (the last one past the end)."""
    f = forward(poses, receiver, keys, at, ["status"], span)
    return f.select(*poses.columns, F.col("match")["status"].alias("status"))


def message_rates(messages: DataFrame, scene: list[str], at: str, ticks: float) -> DataFrame:
    """Per scene: message count and mean rate."""
    from trackloom.operators.stats import average_rate

    return average_rate(messages, scene, at, ticks).select(*scene, "n", "rate")


def radar_velocity(v_radial: str, own: tuple[str, str, str]) -> dict[str, "F.Column"]:
    """A radar return's radial speed along its line of sight, raw and with the sensor's own motion added back."""
    r = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    u = [F.when(r > 0, F.col(a) / r).otherwise(0.0) for a in ("x", "y", "z")]
    v = F.col(v_radial)
    comp = v + u[0] * F.col(own[0]) + u[1] * F.col(own[1]) + u[2] * F.col(own[2])
    return {"vx": v * u[0], "vy": v * u[1], "vx_comp": comp * u[0], "vy_comp": comp * u[1]}
