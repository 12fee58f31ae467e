"""Camera models as column expressions: point in the camera frame to pixel, and pixel to unit ray."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]


def _odd(t2: Column, ks: tuple[float, ...], factors: tuple[float, ...] | None = None) -> Column:
    """1 + k1 f1 t2 + k2 f2 t2^2 + ... by Horner."""
    fs = factors or tuple(1.0 for _ in ks)
    out = F.lit(0.0)
    for k, f in zip(reversed(ks), reversed(fs)):
        out = t2 * (k * f + out)
    return 1 + out


def project_pinhole(p: Vec, k: tuple[float, float, float, float]) -> tuple[Column, Column]:
    fx, fy, cx, cy = k
    return fx * p[0] / p[2] + cx, fy * p[1] / p[2] + cy


def project_fisheye(p: Vec, k: tuple[float, float, float, float], d: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Equidistant lens with a four-term polynomial of the angle."""
    fx, fy, cx, cy = k
    r = F.greatest(F.sqrt(p[0] * p[0] + p[1] * p[1]), F.lit(1e-12))
    th = F.atan2(r, p[2])
    s = th * _odd(th * th, d) / r
    return fx * s * p[0] + cx, fy * s * p[1] + cy


def project_radial(p: Vec, k: tuple[float, float, float, float], d: tuple[float, ...]) -> tuple[Column, Column]:
    """Radial-tangential lens; d = (k1, k2, p1, p2, k3) or, with a denominator, (k1, k2, p1, p2, k3, k4, k5, k6)."""
    fx, fy, cx, cy = k
    k1, k2, p1, p2, k3 = d[:5]
    z = F.greatest(p[2], F.lit(1e-6))
    x, y = p[0] / z, p[1] / z
    r2 = x * x + y * y
    rad = _odd(r2, (k1, k2, k3)) / (_odd(r2, tuple(d[5:])) if len(d) > 5 else F.lit(1.0))
    xd = x * rad + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)
    yd = y * rad + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y
    return fx * xd + cx, fy * yd + cy


def _rays(solve: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Callable[[Column, Column], Column]:
    """`solve` on whole batches of pixels as a column expression: struct (x, y, z), null fields where a pixel has a null."""

    def run(u: pa.Array, v: pa.Array) -> pa.Array:
        unknown = np.logical_or(u.is_null().to_numpy(zero_copy_only=False), v.is_null().to_numpy(zero_copy_only=False))
        with np.errstate(all="ignore"):
            ray = solve(*(c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in (u, v)))
        return pa.StructArray.from_arrays([pa.array(c, pa.float64(), mask=unknown) for c in ray], ["x", "y", "z"])

    return F.arrow_udf(run, "x double, y double, z double")


def _series() -> Callable[[np.ndarray, tuple[float, ...]], np.ndarray]:
    """1 + k1 t2 + k2 t2^2 + ... by Horner, on arrays; made here so that tasks need no module of this package."""

    def odd(t2: np.ndarray, ks: tuple[float, ...]) -> np.ndarray:
        out = np.zeros_like(t2)
        for k in reversed(ks):
            out = t2 * (k + out)
        return 1 + out

    return odd


def unproject_fisheye(u: Column, v: Column, k: tuple[float, float, float, float], d: tuple[float, float, float, float], rounds: int = 50) -> Column:
    """Struct (x, y, z) of the unit ray through a pixel.

    The distance from the image centre grows with the ray's angle, so the angle is bracketed in [0, pi] and the
    bracket is halved `rounds` times; the ray then leans that far from the axis towards the pixel.
    """
    odd = _series()

    def solve(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = (u - k[2]) / k[0], (v - k[3]) / k[1]
        away = np.hypot(a, b)
        low, high = np.zeros_like(away), np.full_like(away, np.pi)
        for _ in range(rounds):
            mid = (low + high) / 2
            inside = mid * odd(mid * mid, d) < away
            low, high = np.where(inside, mid, low), np.where(inside, high, mid)
        angle, bearing = (low + high) / 2, np.arctan2(b, a)
        return np.sin(angle) * np.cos(bearing), np.sin(angle) * np.sin(bearing), np.cos(angle)

    return _rays(solve)(u, v)


def unproject_radial(u: Column, v: Column, k: tuple[float, float, float, float], d: tuple[float, ...], rounds: int = 12) -> Column:
    """Struct (x, y, z) of the unit ray through a pixel: Newton's method in two variables on `project_radial`."""
    t1, t2 = d[2:4]
    upper, lower = (d[0], d[1], d[4]), tuple(d[5:])
    odd = _series()

    def slope(r2: np.ndarray, ks: tuple[float, ...]) -> np.ndarray:
        """Derivative of 1 + k1 r2 + k2 r2^2 + ... after r2."""
        return sum((n * c * r2 ** (n - 1) for n, c in enumerate(ks, 1)), np.zeros_like(r2))

    def solve(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        goal_x, goal_y = (u - k[2]) / k[0], (v - k[3]) / k[1]
        x, y = goal_x, goal_y
        for _ in range(rounds):
            r2 = x * x + y * y
            den = odd(r2, lower)
            gain = odd(r2, upper) / den
            bend = 2 * (slope(r2, upper) - gain * slope(r2, lower)) / den
            # what is missing to the goal, and how both coordinates answer to a small step
            miss_x = goal_x - (gain * x + 2 * t1 * x * y + t2 * (r2 + 2 * x * x))
            miss_y = goal_y - (gain * y + 2 * t2 * x * y + t1 * (r2 + 2 * y * y))
            xx = gain + bend * x * x + 2 * t1 * y + 6 * t2 * x
            yy = gain + bend * y * y + 2 * t2 * x + 6 * t1 * y
            xy = bend * x * y + 2 * t1 * x + 2 * t2 * y
            area = xx * yy - xy * xy
            x, y = x + (yy * miss_x - xy * miss_y) / area, y + (xx * miss_y - xy * miss_x) / area
        length = np.sqrt(1 + x * x + y * y)
        return x / length, y / length, 1 / length

    return _rays(solve)(u, v)


def spline_weights(f: Column) -> list[Column]:
    """The four uniform cubic B-spline weights at a fractional position in [0, 1)."""
    g = 1 - f
    return [
        g * g * g / 6,
        (3 * f * f * f - 6 * f * f + 4) / 6,
        (3 * g * g * g - 6 * g * g + 4) / 6,
        f * f * f / 6,
    ]


def deskewed_point(p: Vec, rot_ref, pos_ref: Vec, rot_at, pos_at: Vec) -> Vec:
    """An ego-frame point measured at one pose, expressed at the reference pose (matrices of the two poses)."""
    from trackloom.functions.rotation import rotate, transpose

    world = tuple(a + b for a, b in zip(rotate(rot_at, p), pos_at))
    return rotate(transpose(rot_ref), tuple(w - r for w, r in zip(world, pos_ref)))
