"""Rectangles and keyframes as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyframes(n: Column, sample_pct: float = 0.10, floor: int = 3, ceiling: int = 25) -> Column:
    """Sorted indices of the frames to read: all of up to ``floor`` frames, else evenly spread ones with both ends."""
    k = F.greatest(F.lit(floor), F.least(F.lit(ceiling), F.bround(n * F.lit(sample_pct)))).cast("int")
    spread = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.bround(i * (n - 1) / (k - 1)).cast("int"))
    both = F.array_sort(F.array_distinct(F.concat(spread, F.array(F.lit(0), (n - 1).cast("int")))))
    return F.when(F.coalesce(n, F.lit(0)) <= 0, F.array().cast("array<int>")).when(n <= floor, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(both)


def corners_to_box(corners: Column) -> Column:
    """struct(x, y, w, h) around corner points, rounded half to even."""
    xs, ys = F.transform(corners, lambda p: p[0]), F.transform(corners, lambda p: p[1])
    x, y = F.bround(F.array_min(xs)).cast("int"), F.bround(F.array_min(ys)).cast("int")
    return F.struct(x.alias("x"), y.alias("y"), F.bround(F.array_max(xs) - F.array_min(xs)).cast("int").alias("w"), F.bround(F.array_max(ys) - F.array_min(ys)).cast("int").alias("h"))


def clamp(value: Column, low: int | Column, high: int | Column) -> Column:
    low, high = (F.lit(v) if isinstance(v, int) else v for v in (low, high))
    return F.greatest(low, F.least(high, value))


def iou(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Intersection over union of two (x, y, w, h) rectangles; 0 where both are empty."""
    (ax, ay, aw, ah), (bx, by, bw, bh) = a, b
    w = F.greatest(F.lit(0), F.least(ax + aw, bx + bw) - F.greatest(ax, bx))
    h = F.greatest(F.lit(0), F.least(ay + ah, by + bh) - F.greatest(ay, by))
    common = w * h
    return F.coalesce(F.try_divide(common, aw * ah + bw * bh - common), F.lit(0.0))
