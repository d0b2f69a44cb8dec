"""Temporal merging of detections into tracks.

greedy_tracks follows the sequential rule: frames in order, detections in the order given; a detection joins the
first open track whose last detection it resembles and that no detection of this frame has joined by then, else
it opens one. A track closes when a frame comes more than max_gap after its last. That rule depends on order, so a stretch
of frames is worked through in one place; but no track outlives a stretch without frames that is longer than max_gap,
so a video is first cut into sessions, which are independent and spread over the cluster.

exact_tracks is the case of equal texts, by windows alone.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.text import similar

#: Detections that a task has as Python objects at once, beside those of an open frame.
ROWS_AT_ONCE = 1000
BOX = ["bbox_ymin", "bbox_xmin", "bbox_ymax", "bbox_xmax"]
CARRIED = ["frame_id", "frame_idx", "timestamp", "timestamp_ms", "timestamp_str", "youtube_url", "text", "text_unsigned", *BOX, "polygon_json"]
DETECTION = "video_id string, frame_id string, frame_idx bigint, timestamp double, timestamp_ms bigint, timestamp_str string, youtube_url string, ord bigint, text string, text_unsigned string, confidence double, bbox_ymin double, bbox_xmin double, bbox_ymax double, bbox_xmax double, polygon_json string, entities array<string>"
RECORD = "frame_id string, video_id string, frame_idx bigint, timestamp double, timestamp_ms bigint, timestamp_str string, youtube_url string, frame_start bigint, frame_end bigint, occurrences bigint, text string, text_unsigned string, confidence double, bbox_ymin double, bbox_xmin double, bbox_ymax double, bbox_xmax double, polygon_json string, entities array<string>"


def near_boxes(a: dict, b: dict, least_iou: float = 0.25, most_distance: float = 0.25) -> bool:
    (t1, l1, b1, r1), (t2, l2, b2, r2) = ([d[c] or 0.0 for c in BOX] for d in (a, b))
    high, wide = min(b1, b2) - max(t1, t2), min(r1, r2) - max(l1, l2)
    if high > 0 and wide > 0:
        union = (b1 - t1) * (r1 - l1) + (b2 - t2) * (r2 - l2) - high * wide
        if union > 0 and high * wide / union >= least_iou:
            return True
    return math.hypot((t1 + b1 - t2 - b2) / 2, (l1 + r1 - l2 - r2) / 2) <= most_distance


def same_track(a: dict, b: dict, threshold: float) -> bool:
    if not near_boxes(a, b):
        return False
    return similar(a["text_unsigned"], b["text_unsigned"], threshold) or similar(a["text"], b["text"], threshold)


class Tracker:
    """Open tracks of one video; frames must come in order."""

    def __init__(self, threshold: float, max_gap: int, tracks: list[dict] | None = None):
        self.threshold, self.max_gap, self.open = threshold, max_gap, tracks or []

    def closed_before(self, frame_idx: int) -> list[dict]:
        done = [t for t in self.open if frame_idx - t["end"] > self.max_gap]
        self.open = [t for t in self.open if frame_idx - t["end"] <= self.max_gap]
        return done

    def frame(self, frame_idx: int, detections: list[dict]) -> list[dict]:
        """Take a frame's detections; returns the tracks that it closes."""
        done, taken = self.closed_before(frame_idx), set()
        for d in detections:
            i = next((i for i, t in enumerate(self.open) if i not in taken and same_track(t["last"], d, self.threshold)), None)
            if i is None:
                self.open.append({"best": d, "last": d, "start": frame_idx, "end": frame_idx, "count": 1, "entities": list(d["entities"])})
                continue
            t = self.open[i]
            taken.add(i)
            t["end"], t["last"], t["count"] = frame_idx, d, t["count"] + 1
            if (d["confidence"] or 0.0) > (t["best"]["confidence"] or 0.0):
                t["best"] = d
            t["entities"] += [e for k, e in enumerate(d["entities"]) if e not in t["entities"] and e not in d["entities"][:k]]
        return done


def record(video_id: str, t: dict) -> dict:
    best = t["best"]
    return {c: best[c] for c in CARRIED} | {"video_id": video_id, "confidence": round(best["confidence"] or 0.0, 4), "frame_start": t["start"], "frame_end": t["end"], "occurrences": t["count"], "entities": t["entities"]}


def frames_of(rows: pd.DataFrame) -> Iterator[tuple[int, list[dict]]]:
    rows = rows.sort_values(["frame_idx", "ord"], kind="stable")
    found = rows.astype(object).where(rows.notna(), None).to_dict("records")
    for idx, part in itertools.groupby(found, key=lambda d: d["frame_idx"]):
        yield int(idx), [d | {"entities": list(d["entities"]) if d["entities"] is not None else []} for d in part]


def _sessions(detections: DataFrame, max_gap: int) -> DataFrame:
    order = Window.partitionBy("video_id").orderBy("frame_idx")
    frames = detections.select("video_id", "frame_idx").distinct()
    cut = F.coalesce((F.col("frame_idx") - F.lag("frame_idx").over(order) > max_gap).cast("int"), F.lit(0))
    frames = frames.withColumn("cut", cut).withColumn("session", F.sum("cut").over(order)).drop("cut")
    return detections.join(frames, ["video_id", "frame_idx"])


def greedy_tracks(detections: DataFrame, threshold: float = 0.85, max_gap: int = 120) -> DataFrame:
    """detections (schema DETECTION) -> records (schema RECORD)."""
    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def tracks(rows: Iterator[dict]) -> Iterator[dict]:
        for (video, _), session in itertools.groupby(rows, key=lambda d: (d["video_id"], d["session"])):
            tracker = Tracker(threshold, max_gap)
            for idx, frame in itertools.groupby(session, key=lambda d: d["frame_idx"]):
                yield from (record(video, t) for t in tracker.frame(idx, [d | {"entities": d["entities"] or []} for d in frame]))
            yield from (record(video, t) for t in tracker.open)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = tracks(d for batch in batches for k in range(0, len(batch), ROWS_AT_ONCE) for d in batch.slice(k, ROWS_AT_ONCE).to_pylist())
        while some := list(itertools.islice(found, ROWS_AT_ONCE)):
            yield pa.RecordBatch.from_pylist(some, schema)

    # sessions one after another, in the order of their frames: a task holds the open tracks of one, and no session costs a call of its own
    dealt = _sessions(detections, max_gap).withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("timestamp", "confidence", *BOX)})
    dealt = dealt.repartition("video_id", "session").sortWithinPartitions("video_id", "session", "frame_idx", F.asc_nulls_last("ord"))
    return dealt.mapInArrow(run, RECORD)


def untracked(detections: DataFrame) -> DataFrame:
    """Every detection as a record of its own (merging disabled)."""
    whole = detections.select("*", F.col("frame_idx").alias("frame_start"), F.col("frame_idx").alias("frame_end"), F.lit(1).cast("bigint").alias("occurrences"))
    return whole.select(*[c.split()[0] for c in RECORD.split(", ")])


def exact_tracks(rows: DataFrame, keys: list[str], at: str, max_gap: int, best: str | None = None) -> DataFrame:
    """Runs of rows with equal keys, split where `at` jumps by more than max_gap: first, last, occurrences, and the first
    position that has the greatest `best`."""
    order = Window.partitionBy(*keys).orderBy(at)
    cut = F.coalesce((F.col(at) - F.lag(at).over(order) > max_gap).cast("int"), F.lit(0))
    runs = rows.withColumn("_cut", cut).withColumn("track", F.sum("_cut").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    more = [] if best is None else [F.max(best).alias("best"), (-F.max(F.struct(F.col(best), -F.col(at)))[f"col2"]).alias("best_at")]
    return runs.groupBy(*keys, "track").agg(F.min(at).alias("frame_start"), F.max(at).alias("frame_end"), F.count("*").alias("occurrences"), *more)
