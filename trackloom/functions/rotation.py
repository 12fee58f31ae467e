"""Rotations as flat columns: quaternions are (w, x, y, z) tuples of columns, matrices are 3 x 3 tuples."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Quat = tuple[Column, Column, Column, Column]
Vec = tuple[Column, Column, Column]
Mat = tuple[Vec, Vec, Vec]


def quat(names: tuple[str, str, str, str] = ("qw", "qx", "qy", "qz")) -> Quat:
    return tuple(F.col(n) for n in names)


def normalize(q: Quat) -> Quat:
    n = F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))
    return tuple(c / n for c in q)


def multiply(p: Quat, q: Quat) -> Quat:
    """Hamilton product."""
    a, b, c, d = p
    e, f, g, h = q
    return (
        a * e - b * f - c * g - d * h,
        a * f + b * e + c * h - d * g,
        a * g - b * h + c * e + d * f,
        a * h + b * g - c * f + d * e,
    )


def conjugate(q: Quat) -> Quat:
    return q[0], -q[1], -q[2], -q[3]


def to_matrix(q: Quat) -> Mat:
    """Rotation matrix of a unit quaternion."""
    w, x, y, z = q
    return (
        (1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)),
        (2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)),
        (2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)),
    )


def from_matrix(m: Mat) -> Quat:
    """Unit quaternion (w >= 0) of a rotation matrix, from its largest component so that no digits are lost."""
    d0, d1, d2 = m[0][0], m[1][1], m[2][2]
    squares = (1 + d0 + d1 + d2, 1 + d0 - d1 - d2, 1 - d0 + d1 - d2, 1 - d0 - d1 + d2)  # 4 w^2, 4 x^2, 4 y^2, 4 z^2
    best = F.greatest(*squares)
    s = 2 * F.sqrt(best)  # four times the largest component
    yx, zx, zy = m[1][0] - m[0][1], m[0][2] - m[2][0], m[2][1] - m[1][2]
    xy, xz, yz = m[0][1] + m[1][0], m[0][2] + m[2][0], m[1][2] + m[2][1]
    rows = ((s / 4, zy / s, zx / s, yx / s), (zy / s, s / 4, xy / s, xz / s), (zx / s, xy / s, s / 4, yz / s), (yx / s, xz / s, yz / s, s / 4))

    def pick(i: int) -> Column:
        out = rows[3][i]
        for k in (2, 1, 0):
            out = F.when(squares[k] >= best, rows[k][i]).otherwise(out)
        return out

    sign = F.when(pick(0) < 0, -1.0).otherwise(1.0)
    return tuple(sign * pick(i) for i in range(4))


def rotate(m: Mat, v: Vec) -> Vec:
    return tuple(m[i][0] * v[0] + m[i][1] * v[1] + m[i][2] * v[2] for i in range(3))


def transpose(m: Mat) -> Mat:
    return tuple(tuple(m[j][i] for j in range(3)) for i in range(3))


def angle_between(p: Quat, q: Quat) -> Column:
    """Rotation angle from p to q, in radians."""
    dot = F.abs(sum((a * b for a, b in zip(p[1:], q[1:])), p[0] * q[0]))
    return 2 * F.acos(F.least(dot, F.lit(1.0)))


def yaw(q: Quat) -> Column:
    w, x, y, z = q
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def from_rotation_vector(v: Vec) -> Quat:
    """Unit quaternion of a rotation vector; tiny angles by series."""
    th = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    s = F.when(th < 1e-8, 0.5 - th * th / 48).otherwise(F.sin(th / 2) / th)
    return F.cos(th / 2), v[0] * s, v[1] * s, v[2] * s


def invert_extrinsic(m: Mat, t: Vec) -> tuple[Mat, Vec]:
    """Pose of a sensor in the ego frame from the mapping of ego points into the sensor (P = R p + t)."""
    r = transpose(m)
    back = rotate(r, t)
    return r, tuple(-c for c in back)


def receiver_attitude(roll: Column, pitch: Column, azimuth: Column) -> Quat:
    """Ego orientation in east-north-up from a receiver's degrees: azimuth clockwise from north, then pitch about
    right, then roll about forward (its axes x right, y forward), turned to x forward, y left."""

    def half(angle: Column) -> tuple[Column, Column]:
        a = F.radians(angle) / 2
        return F.cos(a), F.sin(a)

    zero = F.lit(0.0)
    cz, sz = half(-azimuth)
    cx, sx = half(pitch)
    cy, sy = half(roll)
    vehicle = multiply(multiply((cz, zero, zero, sz), (cx, sx, zero, zero)), (cy, zero, sy, zero))
    quarter = math.sqrt(0.5)
    return multiply(vehicle, (F.lit(quarter), zero, zero, F.lit(quarter)))


def box_pose(q: Quat, t: Vec, p: Vec) -> Vec:
    """A point moved by a pose: R p + t."""
    r = rotate(to_matrix(q), p)
    return tuple(a + b for a, b in zip(r, t))
