"""Boxes, as Column expressions. A pixel or normalized corner box is a struct (x1, y1, x2, y2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 32  # cells a side for union coverage


def corners(xc: Column, yc: Column, w: Column, h: Column, width: Column | None = None, height: Column | None = None) -> Column:
    """Centre and size to corners; scaled by width and height where given."""
    sx, sy = (F.lit(1.0) if v is None else v.cast("double") for v in (width, height))
    half = F.lit(2.0)
    return F.struct(((xc - w / half) * sx).alias("x1"), ((yc - h / half) * sy).alias("y1"), ((xc + w / half) * sx).alias("x2"), ((yc + h / half) * sy).alias("y2"))


def area(b: Column) -> Column:
    """0 for boxes turned inside out."""
    return F.greatest(b.x2 - b.x1, F.lit(0.0)) * F.greatest(b.y2 - b.y1, F.lit(0.0))


def height(b: Column) -> Column:
    return F.greatest(b.y2 - b.y1, F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    wide = F.greatest(F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1), F.lit(0.0))
    tall = F.greatest(F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1), F.lit(0.0))
    return wide * tall


def containment(a: Column, b: Column) -> Column:
    """Part of a that lies in b; 0 for an a of no area."""
    return F.coalesce(intersection(a, b) / F.nullif(area(a), F.lit(0.0)), F.lit(0.0))


def mutual_containment(a: Column, b: Column) -> Column:
    return F.least(containment(a, b), containment(b, a))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union has no area."""
    both = intersection(a, b)
    return F.coalesce(both / F.nullif(area(a) + area(b) - both, F.lit(0.0)), F.lit(0.0))


def mirrored(b: Column) -> Column:
    """A normalized box in the picture mirrored left to right."""
    return F.struct((F.lit(1.0) - b.x2).alias("x1"), b.y1.alias("y1"), (F.lit(1.0) - b.x1).alias("x2"), b.y2.alias("y2"))


def rotated_point(x: Column, y: Column, degrees: Column, width: Column, height_: Column) -> tuple[Column, Column]:
    """A pixel after turning the picture by 0, 90, 180 or 270 degrees; null for other angles."""
    right, low = width - 1 - x, height_ - 1 - y
    px = F.when(degrees == 0, x).when(degrees == 90, y).when(degrees == 180, right).when(degrees == 270, low)
    py = F.when(degrees == 0, y).when(degrees == 90, right).when(degrees == 180, low).when(degrees == 270, x)
    return px, py


def rotated(b: Column, degrees: Column, width: Column, height_: Column) -> Column:
    """The box around the four turned corners."""
    turned = [rotated_point(x, y, degrees, width, height_) for x in (b.x1, b.x2) for y in (b.y1, b.y2)]
    xs, ys = [t[0] for t in turned], [t[1] for t in turned]
    return F.struct(F.least(*xs).alias("x1"), F.least(*ys).alias("y1"), F.greatest(*xs).alias("x2"), F.greatest(*ys).alias("y2"))


def outside(xc: Column, yc: Column, w: Column, h: Column, tolerance: float = 1e-4) -> Column:
    """Whether the box passes the edge of the picture by more than the tolerance."""
    b = corners(xc, yc, w, h)
    low, high = F.lit(-tolerance), F.lit(1.0 + tolerance)
    return (b.x1 < low) | (b.y1 < low) | (b.x2 > high) | (b.y2 > high)


def clipped(xc: Column, yc: Column, w: Column, h: Column) -> Column:
    """Struct (xc, yc, w, h) of the part in the picture; null where nothing is left."""
    b = corners(xc, yc, w, h)
    zero, one = F.lit(0.0), F.lit(1.0)
    x1, y1, x2, y2 = (F.least(F.greatest(v, zero), one) for v in (b.x1, b.y1, b.x2, b.y2))
    return F.when((x2 > x1) & (y2 > y1), F.struct(((x1 + x2) / 2).alias("xc"), ((y1 + y2) / 2).alias("yc"), (x2 - x1).alias("w"), (y2 - y1).alias("h")))


def size_bucket(pixels: Column, small: int = 32, medium: int = 96) -> Column:
    """small under 32 x 32, medium under 96 x 96, else large."""
    return F.when(pixels < small * small, "small").when(pixels < medium * medium, "medium").otherwise("large")


def union_coverage(b: Column, others: Column, grid: int = GRID) -> Column:
    """Part of b in the union of an array of boxes, by the centres of grid x grid cells, edges included.

    0 for a b of no area, and for a null or empty array.
    """
    cells = F.sequence(F.lit(0), F.lit(grid * grid - 1))
    step = F.lit(float(grid))

    def covered(i: Column) -> Column:
        x = b.x1 + (b.x2 - b.x1) * ((i % grid).cast("double") + F.lit(0.5)) / step
        y = b.y1 + (b.y2 - b.y1) * (F.floor(i / grid).cast("double") + F.lit(0.5)) / step
        return F.exists(others, lambda o: (x >= o.x1) & (x <= o.x2) & (y >= o.y1) & (y <= o.y2))

    part = F.size(F.filter(cells, covered)) / F.lit(float(grid * grid))
    return F.when((b.x2 > b.x1) & (b.y2 > b.y1) & (F.coalesce(F.size(others), F.lit(0)) > 0), part).otherwise(F.lit(0.0))


def polygon_box(parts: Column) -> Column:
    """Label fields `class x1 y1 x2 y2 ...`: a polygon (more than five) as `class xc yc w h`, others unchanged.

    Coordinates are written with six decimals.
    """
    numbers = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.cast("double"))
    xs, ys = F.filter(numbers, lambda x, i: i % 2 == 0), F.filter(numbers, lambda x, i: i % 2 == 1)
    x1, x2, y1, y2 = F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)
    text = lambda v: F.format_string("%.6f", v)
    return F.when(F.size(parts) > 5, F.array(parts[0], text((x1 + x2) / 2), text((y1 + y2) / 2), text(x2 - x1), text(y2 - y1))).otherwise(parts)


def label_line(class_id: Column, b: Column, width: Column, height_: Column) -> Column:
    """A pixel box as a label line of six decimals."""
    w, h = width.cast("double"), height_.cast("double")
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, (b.x1 + b.x2) / 2 / w, (b.y1 + b.y2) / 2 / h, (b.x2 - b.x1) / w, (b.y2 - b.y1) / h)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hash_of_hex(text: Column) -> Column:
    """BIGINT of up to 16 hex digits, as a signed number."""
    return F.conv(text, 16, -10).cast("bigint")
