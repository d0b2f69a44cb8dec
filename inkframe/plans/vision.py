"""Models as pluggable steps: bytes in, polygons and texts out. What surrounds them is column arithmetic."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from ..functions import pixels
from ..functions.spatial import hybrid_vote, polygon_box, recognized, rescale_polygon, usable_polygon
from ..functions.text import clean_text, extract_entities, unsigned_of_clean


class FrameReader(Protocol):
    """Finds text in an image. One instance serves a Python worker for as long as it lives.

    A reader may also have read_batch(images) -> list of what read gives, for models that are faster on many at a time.
    """

    def read(self, image: bytes) -> dict:
        """width, height, scale, and lines: polygon, printed, printed_conf, marked, marked_conf of each. Raises ValueError if the
        bytes are no image."""


LINES = "path string, width int, height int, scale double, ord bigint, polygon array<array<int>>, printed string, printed_conf double, marked string, marked_conf double, error string"
EMPTY = "the image is empty or cannot be read"
_READERS: dict[str, FrameReader] = {}


def _found(reader: FrameReader, images: list[bytes]) -> list[dict]:
    """What a reader finds in each image; images that it refuses have an error."""
    if hasattr(reader, "read_batch"):
        try:
            return reader.read_batch(images)
        except ValueError:  # one of them is no image
            pass
    out = []
    for image in images:
        try:
            out.append(reader.read(image))
        except ValueError as e:
            out.append({"error": str(e) or EMPTY})
    return out


def first_that_works(*choices: Callable[[], FrameReader]) -> Callable[[], FrameReader]:
    """A make for read_images: the first choice that can be made on a worker, such as one on its device before one without. The last one's error counts."""

    def make() -> FrameReader:
        for choice in choices[:-1]:
            try:
                return choice()
            except Exception as e:
                warnings.warn(f"{getattr(choice, '__name__', choice)}: {e!r}; the next choice is taken", stacklevel=2)
        return choices[-1]()

    return make


def device_profile(device: str = "gpu", a_task: float = 1.0, an_executor: int = 1, cores: int = 4, script: str = "") -> ResourceProfile:
    """What the stage of a model asks of the cluster: executors with devices, and the part of one that a task has."""
    executor = ExecutorResourceRequests().cores(cores).resource(device, an_executor, script)
    return ResourceProfileBuilder().require(executor).require(TaskResourceRequests().cpus(1).resource(device, a_task)).build


def read_images(images: DataFrame, make: Callable[[], FrameReader], key: str, batch_size: int = 16, profile: ResourceProfile | None = None) -> DataFrame:
    """images (path, content) -> a row per text line, and one with an error for each image that is missing, empty or unreadable.

    make() runs once per worker; a failing model fails the task. Up to batch_size images are read at a time.
    With a profile (device_profile) the stage is scheduled by it, where the cluster manager can.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _READERS:
            _READERS[key] = make()
        for batch in batches:
            rows = [(path, *[None] * 9, EMPTY) for path, content in zip(batch["path"], batch["content"], strict=True) if not content]
            full = [(path, content) for path, content in zip(batch["path"], batch["content"], strict=True) if content]
            for k in range(0, len(full), batch_size):
                some = full[k : k + batch_size]
                for (path, _), found in zip(some, _found(_READERS[key], [c for _, c in some]), strict=True):
                    if "error" in found:
                        rows.append((path, *[None] * 9, found["error"]))
                        continue
                    for i, line in enumerate(found["lines"]):
                        rows.append((path, found["width"], found["height"], found.get("scale", 1.0), i, line["polygon"], line.get("printed"), line.get("printed_conf"), line.get("marked"), line.get("marked_conf"), None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in LINES.split(", ")]).astype({"width": "Int32", "height": "Int32", "ord": "Int64", "scale": "Float64", "printed_conf": "Float64", "marked_conf": "Float64"})

    return images.select("path", "content").mapInPandas(run, LINES, profile=profile)


PREPARED = "path string, pixels binary, width int, height int, channels int, scale double, blur_score double, is_blurry boolean, error string"
CROPS = "path string, ord int, pixels binary, width int, height int, channels int, error string"


def _decoded(content: bytes | None, decode: Callable[[bytes], np.ndarray]) -> tuple[np.ndarray | None, str | None]:
    if not content:
        return None, EMPTY
    try:
        return decode(content), None
    except ValueError as e:
        return None, str(e) or EMPTY


def _flat(image: np.ndarray) -> tuple[bytes, int, int, int]:
    return image.tobytes(), image.shape[1], image.shape[0], 1 if image.ndim == 2 else image.shape[2]


def _batched(rows: Iterator[tuple], columns: list[str], pixels_at: int, most_bytes: int = 1 << 23, most_rows: int = 1000) -> Iterator[pd.DataFrame]:
    """Rows as frames of about so many bytes of pixels, and no more than so many rows."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[pixels_at] or b"")
        if size >= most_bytes or len(some) >= most_rows:
            yield pd.DataFrame(some, columns=columns, dtype=object)
            some, size = [], 0
    if some:
        yield pd.DataFrame(some, columns=columns, dtype=object)


def prepare_images(images: DataFrame, decode: Callable[[bytes], np.ndarray] = pixels.netpbm, **options) -> DataFrame:
    """images (path, content) -> a row each: the pixels that a detector takes (contrast, then size), row by row, their shape and scale, and the sharpness of
    the input; or an error. decode gives uint8 arrays, or raises ValueError. options are those of pixels.prepared. Prepared pixels leave by 8 MB.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                image, error = _decoded(content, decode)
                if image is None:
                    yield path, None, None, None, None, None, None, None, error
                else:
                    found = pixels.prepared(image, **options)
                    yield path, *_flat(found["image"]), found["scale"], found["blur_score"], bool(found["is_blurry"]), None

    run = lambda batches: _batched(rows(batches), [c.split()[0] for c in PREPARED.split(", ")], 1)
    return images.select("path", "content").mapInPandas(run, PREPARED)


def crop_lines(images: DataFrame, decode: Callable[[bytes], np.ndarray] = pixels.netpbm) -> DataFrame:
    """images (path, content, polygons: four corners each) -> a row per polygon: that part of the image as an upright rectangle. An image that cannot be
    read has one row, with an error; one without polygons none."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            for path, content, polygons in zip(batch["path"], batch["content"], batch["polygons"], strict=True):
                if polygons is None or not len(polygons):
                    continue
                image, error = _decoded(content, decode)
                if image is None:
                    yield path, None, None, None, None, None, error
                    continue
                for i, polygon in enumerate(polygons):
                    yield path, i, *_flat(pixels.rectified(image, np.array([list(p) for p in polygon]))), None

    run = lambda batches: _batched(rows(batches), [c.split()[0] for c in CROPS.split(", ")], 2)
    return images.select("path", "content", "polygons").mapInPandas(run, CROPS)


def detections(lines: DataFrame, min_area: float = 80.0, min_confidence: float = 0.40) -> DataFrame:
    """Lines -> cleaned detections: small polygons and unsure or blank texts go; boxes, search form and entities come."""
    lines = lines.where("error is null")
    vote = hybrid_vote(F.col("printed"), F.col("printed_conf"), F.col("marked"), F.col("marked_conf"))
    rows = lines.where(usable_polygon(F.col("polygon"), min_area)).withColumn("v", vote).where(recognized(F.col("v.text"), F.col("v.conf"), min_confidence))
    b = polygon_box(F.col("polygon"), F.col("width"), F.col("height"))
    rows = rows.withColumn("text", clean_text(F.col("v.text"))).withColumn("b", b)
    return rows.select("path", "ord", "text", unsigned_of_clean(F.col("text")).alias("text_unsigned"), F.bround("v.conf", 4).alias("confidence"), F.col("b.ymin").alias("bbox_ymin"), F.col("b.xmin").alias("bbox_xmin"), F.col("b.ymax").alias("bbox_ymax"), F.col("b.xmax").alias("bbox_xmax"), rescale_polygon(F.col("polygon"), F.col("scale")).alias("polygon"), extract_entities(F.col("text")).alias("entities"))


@pandas_udf(T.DoubleType())
def blur_score(raws: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Variance of the four-neighbour Laplacian of gray images (bytes, row by row); 0 for an empty image."""

    def one(raw: bytes | None, w: int, h: int) -> float:
        if not raw or not w or not h:
            return 0.0
        g = np.pad(np.frombuffer(raw, np.uint8).reshape(h, w).astype(np.float64), 1, mode="reflect" if min(w, h) > 1 else "edge")
        return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var())

    return pd.Series([one(p, w, h) for p, w, h in zip(raws, width, height, strict=True)], dtype="float64")


def is_blurry(score: Column, least: float = 40.0) -> Column:
    return score < least


def frame_errors(lines: DataFrame) -> DataFrame:
    """path and error of the images that gave none of their text."""
    return lines.where("error is not null").select("path", "error")


def paired(found: Column, results: Column) -> Column:
    """Structs of two arrays of structs, by position; the longer one's rest has nulls for the other."""
    return F.arrays_zip(found.alias("found"), results.alias("result"))
