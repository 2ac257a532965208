"""Boxes as structs of x0, y0, x1, y1 (points, origin at the top left), as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0, y0, x1, y1) -> Column:
    named = zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1))
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(n) for n, c in named])


def width(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x1"] - b["x0"])


def height(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["y1"] - b["y0"])


def area(b: Column) -> Column:
    return width(b) * height(b)


def intersection(a: Column, b: Column) -> Column:
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    return w * h


def iou(a: Column, b: Column) -> Column:
    common = intersection(a, b)
    whole = area(a) + area(b) - common
    return F.when((common > 0) & (whole > 0), common / whole).otherwise(0.0)


def cover(b: Column, page_width: Column, page_height: Column) -> Column:
    return area(b) / (page_width * page_height)


def pad(b: Column, by: float, page_width: Column, page_height: Column) -> Column:
    return box(F.greatest(F.lit(0.0), b["x0"] - by), F.greatest(F.lit(0.0), b["y0"] - by), F.least(page_width, b["x1"] + by), F.least(page_height, b["y1"] + by))


def union(a: Column, b: Column) -> Column:
    return box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def overlap(a: Column, b: Column, margin: float = 0.0, strict: bool = True) -> Column:
    """Overlap of open boxes, or of closed ones widened by a margin."""
    if strict:
        return ~((a["x1"] <= b["x0"]) | (b["x1"] <= a["x0"]) | (a["y1"] <= b["y0"]) | (b["y1"] <= a["y0"]))
    return ~((a["x1"] < b["x0"] - margin) | (a["x0"] > b["x1"] + margin) | (a["y1"] < b["y0"] - margin) | (a["y0"] > b["y1"] + margin))


def close(a: Column, b: Column, gap: float) -> Column:
    dx = F.greatest(F.lit(0.0), F.greatest(a["x0"], b["x0"]) - F.least(a["x1"], b["x1"]))
    dy = F.greatest(F.lit(0.0), F.greatest(a["y0"], b["y0"]) - F.least(a["y1"], b["y1"]))
    return (dx <= gap) & (dy <= gap)


def from_thousandths(b: Column, page_width: Column, page_height: Column) -> Column:
    def edge(p: Column, q: Column, size: Column, low: bool) -> Column:
        p, q = p * size / 1000.0, q * size / 1000.0
        return F.greatest(F.lit(0.0), F.least(F.least(p, q) if low else F.greatest(p, q), size))

    return box(edge(b["x0"], b["x1"], page_width, True), edge(b["y0"], b["y1"], page_height, True), edge(b["x0"], b["x1"], page_width, False), edge(b["y0"], b["y1"], page_height, False))


def inside_any(line: Column, boxes: Column, share: float = 0.5) -> Column:
    own = F.greatest(line["x1"] - line["x0"], F.lit(1e-6)) * F.greatest(line["y1"] - line["y0"], F.lit(1e-6))
    return F.exists(boxes, lambda b: intersection(line, b) >= share * own)


def is_diagonal(dx: Column, dy: Column, tolerance: float = 10.0) -> Column:
    """Whether a direction lies more than the tolerance off all axes; no direction is not diagonal."""
    angle = F.pmod(F.degrees(F.atan2(-dy, dx)), F.lit(360.0))
    off = F.least(*[F.abs(angle - k) for k in (0.0, 90.0, 180.0, 270.0, 360.0)])
    return F.coalesce(((dx != 0) | (dy != 0)) & (off > tolerance), F.lit(False))


def segment_kind(x0: Column, y0: Column, x1: Column, y1: Column, tolerance: float = 1.5, shortest: float = 14.0, least_angle: float = 15.0) -> Column:
    ax, ay = F.abs(x1 - x0), F.abs(y1 - y0)
    angle = F.degrees(F.atan2(ay, ax))
    kind = F.when((ay <= tolerance) & (ax > tolerance), "h").when((ax <= tolerance) & (ay > tolerance), "v")
    kind = kind.when((ax > tolerance) & (ay > tolerance) & angle.between(least_angle, 90.0 - least_angle), "d")
    return F.when(F.hypot(ax, ay) >= shortest, kind)


def accepts_dense(density: Column, covered: Column) -> Column:
    return ((density >= 3.5) & (covered >= 0.30)) | ((density >= 5.0) & (covered >= 0.15)) | ((covered >= 0.45) & (density >= 2.8))


def suppress(boxes: Column, most_iou: float = 0.5) -> Column:
    """Boxes by falling area, without those that overlap one kept before them by more than the limit."""
    order = lambda a, b: F.when(area(a) > area(b), -1).when(area(a) < area(b), 1).otherwise(0)
    empty = F.filter(boxes, lambda b: F.lit(False))
    return F.aggregate(F.array_sort(boxes, order), empty, lambda kept, b: F.when(F.exists(kept, lambda k: iou(b, k) > most_iou), kept).otherwise(F.concat(kept, F.array(b))))
