"""Bounding boxes: parsing of title strings and arithmetic on box structs (x0, y0, x1, y1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORNERS = ("x0", "y0", "x1", "y1")


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _once(value: Column, then) -> Column:
    """then(value), with the value computed once however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _items(x: Column) -> Column:
    """What stands between blanks. Java compiles a pattern anew for each string that it splits, but not a single character."""
    return F.split(F.when(x.rlike(r"[\t\n\x0B\f\r]|  "), F.regexp_replace(x, r"\s+", " ")).otherwise(x), " ", -1)


def title_bbox(title: Column | str) -> Column:
    """The box in whichever part of a title names one; null without."""
    # one match gives all four numbers
    found = F.regexp_extract(_col(title), r"(?:^|;)\s*bbox\s+(-?\d+\s+-?\d+\s+-?\d+\s+-?\d+)", 1)
    return _once(_items(found), lambda x: F.when(F.size(x) == 4, F.struct(*[F.get(x, F.lit(i)).cast("int").alias(c) for i, c in enumerate(CORNERS)])))


def strict_bbox(title: Column | str) -> Column:
    """The box of a title that is nothing else: exactly five items, the first ``bbox``; null for any other title."""
    numbers = lambda x: F.struct(*[F.get(x, F.lit(i + 1)).try_cast("int").alias(c) for i, c in enumerate(CORNERS)])
    return _once(_items(F.trim(_col(title))), lambda x: F.when((F.size(x) == 5) & (F.get(x, F.lit(0)) == "bbox"), numbers(x)))


def with_bbox(title: Column | str, box: Column) -> Column:
    """A title whose first part is replaced by the box, as writers of this format do whatever that part held."""
    head = F.concat_ws(" ", F.lit("bbox"), *[box[c].cast("string") for c in CORNERS])
    parts = F.split(F.coalesce(_col(title), F.lit("")), ";", -1)
    return F.array_join(F.concat(F.array(head), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))), ";")


def title_number(title: Column | str, position: int) -> Column:
    """The integer at a position of a blank-separated title, -1 if there is none."""
    return F.coalesce(F.get(_items(_col(title)), F.lit(position)).try_cast("int"), F.lit(-1))


def confidences(title: Column | str) -> Column:
    """The floats in the second part of a title, after its label; null if that part is missing or malformed."""
    part = F.get(F.split(_col(title), ";"), F.lit(1))
    numbers = lambda items: F.transform(F.slice(items, F.lit(3), F.size(items) - 2), lambda v: v.try_cast("double"))
    whole = lambda items: _once(numbers(items), lambda values: F.when(~F.exists(values, lambda v: v.isNull()), values))
    return _once(F.split(part, " "), lambda items: F.when(F.size(items) > 2, whole(items)))


def area(box: Column) -> Column:
    return (box["x1"] - box["x0"]).cast("long") * (box["y1"] - box["y0"]).cast("long")


def centre_x(box: Column) -> Column:
    return box["x0"] + (box["x1"] - box["x0"]) / 2.0


def bucket(value: Column, size: int) -> Column:
    """Truncation toward zero of value / size."""
    return (value / size).cast("int")


def union_box(box: Column) -> Column:
    """Aggregate: the smallest box around a group's boxes."""
    return F.struct(F.min(box["x0"]).alias("x0"), F.min(box["y0"]).alias("y0"), F.max(box["x1"]).alias("x1"), F.max(box["y1"]).alias("y1"))


def corners_csv(box: Column, separator: str = ";") -> Column:
    """Upper left, lower left, lower right, upper right as eight numbers."""
    order = ("x0", "y0", "x0", "y1", "x1", "y1", "x1", "y0")
    return F.concat_ws(separator, *[box[c].cast("string") for c in order])


def border_intersections(rho: Column, theta: Column, width: Column, height: Column) -> Column:
    """Where the line x cos(theta) + y sin(theta) = rho meets the top and bottom borders of a page: struct(top_x, bottom_x); null when level."""
    c, s = F.cos(theta), F.sin(theta)
    at = lambda y: (rho - y * s) / c
    return F.when(F.abs(c) > 1e-12, F.struct(at(F.lit(0.0)).alias("top_x"), at(height.cast("double")).alias("bottom_x")))
