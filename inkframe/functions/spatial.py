"""Boxes, polygons and the columns around recognition. A box is a struct or four columns ymin, xmin, ymax, xmax in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import diacritics, strip


def box(ymin, xmin, ymax, xmax) -> Column:
    return F.struct(*[F.col(v).cast("double").alias(n) if isinstance(v, str) else v.cast("double").alias(n) for n, v in zip(("ymin", "xmin", "ymax", "xmax"), (ymin, xmin, ymax, xmax), strict=True)])


def _area(b: Column) -> Column:
    return (b.ymax - b.ymin) * (b.xmax - b.xmin)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where boxes do not overlap."""
    high = F.least(a.ymax, b.ymax) - F.greatest(a.ymin, b.ymin)
    wide = F.least(a.xmax, b.xmax) - F.greatest(a.xmin, b.xmin)
    union = _area(a) + _area(b) - high * wide
    return F.when((high > 0) & (wide > 0) & (union > 0), high * wide / union).otherwise(0.0)


def center_distance(a: Column, b: Column) -> Column:
    dy = (a.ymin + a.ymax) / 2 - (b.ymin + b.ymax) / 2
    dx = (a.xmin + a.xmax) / 2 - (b.xmin + b.xmax) / 2
    return F.sqrt(dy * dy + dx * dx)


def center_in(b: Column, roi: Column) -> Column:
    """The box's centre lies in the region, borders included."""
    return ((b.ymin + b.ymax) / 2).between(roi.ymin, roi.ymax) & ((b.xmin + b.xmax) / 2).between(roi.xmin, roi.xmax)


def same_place(a: Column, b: Column, least_iou: float = 0.25, most_distance: float = 0.25) -> Column:
    return (iou(a, b) >= least_iou) | (center_distance(a, b) <= most_distance)


def polygon_area(points: Column) -> Column:
    """Shoelace area of array<array<number>>."""
    after = F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1))
    cross = F.zip_with(points, after, lambda p, q: p[0].cast("double") * q[1] - q[0].cast("double") * p[1])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def usable_polygon(points: Column, least_area: float = 80.0) -> Column:
    return (F.size(points) >= 4) & (polygon_area(points) >= least_area)


def polygon_box(points: Column, width: Column, height: Column) -> Column:
    """Bounding box of a polygon as parts of the image, within [0, 1], to 4 places."""

    def part(i: int, of: Column, end) -> Column:
        value = end(F.transform(points, lambda p: p[i].cast("double"))) / of
        return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 4)

    return box(part(1, height, F.array_min), part(0, width, F.array_min), part(1, height, F.array_max), part(0, width, F.array_max))


def rescale_polygon(points: Column, scale: Column) -> Column:
    """Points back in pixels of the original image, cut to integers; unchanged at scale 1."""
    return F.when(scale == 1, F.transform(points, lambda p: F.transform(p, lambda v: v.cast("int")))).otherwise(F.transform(points, lambda p: F.transform(p, lambda v: (v / scale).cast("int"))))


def corners(points: Column) -> Column:
    """The corners TL, TR, BR, BL: least and greatest sum x + y, and difference y - x; the first on a tie."""

    def pick(key, least: bool) -> Column:
        keyed = F.transform(points, lambda p, i: F.struct((key(p) if least else -key(p)).alias("k"), i.alias("i"), p.alias("p")))
        return F.array_min(keyed).p

    total, turn = (lambda p: p[0] + p[1]), (lambda p: p[1] - p[0])
    return F.array(pick(total, True), pick(turn, True), pick(total, False), pick(turn, False))


def detection_size(width: Column, height: Column, most: int, least: int) -> Column:
    """scale, width, height of an image as it goes to detection."""
    long, short = F.greatest(width, height), F.least(width, height)
    scale = F.when((long <= most) & (short <= least), F.lit(1.0)).otherwise(F.lit(float(most)) / long)
    return F.struct(scale.alias("scale"), (width * scale).cast("int").alias("width"), (height * scale).cast("int").alias("height"))


def hybrid_vote(printed: Column, printed_conf: Column, marked: Column, marked_conf: Column) -> Column:
    """text, conf of two recognisers: one for print and codes, one for Vietnamese with marks."""
    a, b = strip(printed), strip(marked)
    pa, pb = F.coalesce(printed_conf, F.lit(0.0)), F.coalesce(marked_conf, F.lit(0.0))
    first, second = F.struct(a.alias("text"), pa.alias("conf")), F.struct(b.alias("text"), pb.alias("conf"))
    code = F.regexp_replace(a, " ", "").rlike(r"^[\p{L}\p{N}]+$") & (diacritics(b) == 0) & (pa >= pb - 0.10)
    return (
        F.when((a != "") & (b == ""), first)
        .when((a == "") & (b != ""), second)
        .when((a == "") & (b == ""), F.struct(F.lit("").alias("text"), F.lit(0.0).alias("conf")))
        .when((diacritics(b) > 0) & (diacritics(b) >= diacritics(a)) & (pb >= 0.65), second)
        .when(code, first)
        .when(pb >= pa, second)
        .otherwise(first)
    )


def recognized(text: Column, conf: Column, least: float = 0.40) -> Column:
    return (conf >= least) & (strip(text) != "")
