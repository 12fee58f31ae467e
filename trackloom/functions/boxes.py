"""Overlap of axis-aligned boxes given as four corner columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Corners = tuple[str, str, str, str]


def area(b: Corners) -> Column:
    return (F.col(b[2]) - F.col(b[0])) * (F.col(b[3]) - F.col(b[1]))


def intersection(a: Corners, b: Corners) -> Column:
    w = F.least(F.col(a[2]), F.col(b[2])) - F.greatest(F.col(a[0]), F.col(b[0]))
    h = F.least(F.col(a[3]), F.col(b[3])) - F.greatest(F.col(a[1]), F.col(b[1]))
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def iou(a: Corners, b: Corners, eps: float) -> Column:
    """Intersection over union; `eps` keeps empty boxes at 0."""
    inter = intersection(a, b)
    return inter / (area(a) + area(b) - inter + F.lit(eps))
