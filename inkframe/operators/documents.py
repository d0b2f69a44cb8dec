"""Documents per frame and what tools read from the record table. Ordered joins of texts sort inside the aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.spatial import box, center_in


def _ordered(value: Column, *by: Column) -> Column:
    """Values of a group as an array, in an order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*[b.alias(f"o{i}") for i, b in enumerate(by)], value.alias("v")))), lambda s: s.v)


def _joined(texts: Column, separator: str) -> Column:
    return F.array_join(F.filter(F.transform(texts, lambda t: F.trim(F.coalesce(t, F.lit("")))), lambda t: t != ""), separator)


def frame_documents(records: DataFrame, order: str = "id", separator: str = " | ") -> DataFrame:
    """One row per frame: the first record's attributes, all texts joined, and the entities (array<struct>) of all records: the
    first record's as they are, of the others those that are new."""
    first = {c: F.min_by(c, order).alias(c) for c in ("video_id", "frame_idx", "timestamp", "youtube_url")}
    grouped = records.groupBy("frame_id").agg(*first.values(), _ordered(F.col("text"), F.col(order)).alias("texts"), _ordered(F.col("entities"), F.col(order)).alias("found"), F.min(order).alias(order))
    head = F.coalesce(F.try_element_at("found", F.lit(1)), F.array().cast(records.schema["entities"].dataType))
    rest = F.array_except(F.array_distinct(F.flatten(F.filter("found", lambda e: e.isNotNull()))), head)
    return grouped.select("frame_id", _joined(F.col("texts"), separator).alias("ocr_text"), *first, F.concat(head, rest).alias("entities"), order)


def bulk_lines(records: DataFrame, order: str = "id", index: str = "frames_ocr") -> DataFrame:
    """Action and document lines for a bulk load; `part` 0 is the action, which alone names the frame's id."""
    docs = frame_documents(records, order, " ")
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col("frame_id").alias("_id")).alias("index")))
    body = F.to_json(F.struct("ocr_text", F.coalesce("video_id", F.lit("")).alias("video_id"), F.coalesce("frame_idx", F.lit(0)).alias("frame_idx"), F.coalesce("timestamp", F.lit(0.0)).alias("timestamp")))
    return docs.select("frame_id", "video_id", F.posexplode(F.array(action, body)).alias("part", "line"))


def read_frames(records: DataFrame, separator: str = " | ") -> DataFrame:
    """Per (video, frame): all texts in reading order, how many detections, and their entities."""
    order = (F.col("bbox_ymin"), F.col("bbox_xmin"), F.col("id"))
    grouped = records.groupBy("video_id", "frame_idx").agg(_ordered(F.col("text"), *order).alias("texts"), F.count("*").alias("total"), F.flatten(F.filter(_ordered(F.col("entities"), *order), lambda e: e.isNotNull())).alias("entities"))
    return grouped.select("video_id", "frame_idx", _joined(F.col("texts"), separator).alias("text"), "total", "entities")


def frame_detections(records: DataFrame, video_id: str, frame_idx: int) -> DataFrame:
    return records.where((F.col("video_id") == video_id) & (F.col("frame_idx") == frame_idx)).orderBy("bbox_ymin", "bbox_xmin", "id")


def roi_text(records: DataFrame, roi: Column) -> DataFrame:
    """Per (video, frame): the texts whose box has its centre in the region, in reading order."""
    inside = records.where(center_in(box("bbox_ymin", "bbox_xmin", "bbox_ymax", "bbox_xmax"), roi))
    order = (F.col("bbox_ymin"), F.col("bbox_xmin"), F.col("id"))
    return inside.groupBy("video_id", "frame_idx").agg(_joined(_ordered(F.col("text"), *order), " ").alias("text"), F.count("*").alias("total"))


def detection_struct(records: DataFrame) -> Column:
    """What tools tell of a detection; columns that records lack are left out."""
    have = [c for c in ("id", "frame_idx", "timestamp_str", "text", "confidence", "entities") if c in records.columns]
    return F.struct(*have, bbox_norm().alias("bbox_norm"))


def bbox_norm() -> Column:
    return F.array("bbox_ymin", "bbox_xmin", "bbox_ymax", "bbox_xmax")


def frame_answers(records: DataFrame) -> DataFrame:
    """Per (video, frame), in reading order: total_detections, full_transcription, detections, extracted_entities."""
    order = (F.col("bbox_ymin"), F.col("bbox_xmin"), F.col("id"))
    grouped = records.groupBy("video_id", "frame_idx").agg(F.count("*").alias("total_detections"), _ordered(F.coalesce("text", F.lit("")), *order).alias("texts"), _ordered(detection_struct(records), *order).alias("detections"), F.flatten(F.filter(_ordered(F.col("entities"), *order), lambda e: e.isNotNull())).alias("extracted_entities"))
    return grouped.select("video_id", "frame_idx", "total_detections", F.array_join("texts", " | ").alias("full_transcription"), "detections", "extracted_entities")


def roi_answers(records: DataFrame, roi: Column) -> DataFrame:
    """Per (video, frame) with a detection whose centre is in the region: matched_text and detections, in reading order."""
    inside = records.where(center_in(box("bbox_ymin", "bbox_xmin", "bbox_ymax", "bbox_xmax"), roi))
    order = (F.col("bbox_ymin"), F.col("bbox_xmin"), F.col("id"))
    return inside.groupBy("video_id", "frame_idx").agg(F.array_join(_ordered(F.coalesce("text", F.lit("")), *order), " ").alias("matched_text"), _ordered(detection_struct(records), *order).alias("detections"))


def entity_answers(records: DataFrame, entity_type: str | None = None) -> DataFrame:
    """One row per entity of the records, with the text and the box of its detection; optionally of one type, whatever its case."""
    rows = records.select("video_id", "frame_idx", "timestamp_str", "id", F.col("text").alias("raw_text"), bbox_norm().alias("bbox_norm"), F.posexplode("entities").alias("pos", "e"))
    rows = rows.select("video_id", "frame_idx", "timestamp_str", "id", "pos", "raw_text", F.col("e.type").alias("entity_type"), F.col("e.value").alias("entity_value"), "bbox_norm")
    return rows if entity_type is None else rows.where(F.upper("entity_type") == entity_type.upper())


def video_entities(records: DataFrame, entity_type: str | None = None) -> DataFrame:
    """One row per entity of the records, optionally of one type, whatever its case."""
    rows = records.select("video_id", "frame_idx", "timestamp_str", "id", F.posexplode("entities").alias("pos", "e"))
    rows = rows.select("video_id", "frame_idx", "timestamp_str", "id", "pos", F.col("e.type").alias("type"), F.col("e.value").alias("value"))
    return rows if entity_type is None else rows.where(F.upper("type") == entity_type.upper())


def entity_counts(records: DataFrame) -> DataFrame:
    return video_entities(records).groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_values"))


def run_summary(frames: DataFrame, records: DataFrame) -> DataFrame:
    """Videos, frames, records, and the share of index entries that merging saved."""
    a = frames.agg(F.count_distinct("video_id").alias("videos"), F.count("*").alias("frames"))
    b = records.agg(F.count("*").alias("records"), F.sum("occurrences").alias("detections"))
    return a.crossJoin(b)  # one row each


#: Names of tools, their parameters and the types of entities.
TOOL_SCHEMAS = [
    {
        "name": "search_ocr_text",
        "description": "Find moments of videos by the words, signs or numbers that they show.",
        "parameters": {
            "type": "object",
            "properties": {
                "query_text": {"type": "string", "description": "Words to look for, with or without Vietnamese marks."},
                "top_k": {"type": "integer", "description": "How many results at most (20 if not given)."},
                "entity_type": {"type": "string", "enum": ["PRICE", "LICENSE_PLATE", "PHONE_NUMBER", "NUMBER", "TIME"], "description": "Only texts that hold an entity of this type."},
            },
            "required": ["query_text"],
        },
    },
    {
        "name": "read_frame_text",
        "description": "All text of one frame of a video, in reading order.",
        "parameters": {
            "type": "object",
            "properties": {"video_id": {"type": "string", "description": "The video, such as L01_V001."}, "frame_idx": {"type": "integer", "description": "The frame's index in the video."}},
            "required": ["video_id", "frame_idx"],
        },
    },
    {
        "name": "inspect_roi_text",
        "description": "The text inside a region of one frame.",
        "parameters": {
            "type": "object",
            "properties": {
                "video_id": {"type": "string", "description": "The video."},
                "frame_idx": {"type": "integer", "description": "The frame's index."},
                "roi": {"type": "array", "items": {"type": "number"}, "description": "ymin, xmin, ymax, xmax as parts of the image, from 0 to 1."},
            },
            "required": ["video_id", "frame_idx", "roi"],
        },
    },
]


def quality_ratios(records: DataFrame) -> DataFrame:
    """Shares of records with Vietnamese letters, with a frame id, and with a time stamp that fits the frame index."""
    from ..functions.text import is_vietnamese

    one = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    good_time = (F.col("timestamp") >= 0) & ((F.col("frame_idx") == 0) | (F.col("timestamp") > 0))
    return records.agg(F.count("*").alias("records"), one(is_vietnamese(F.col("text"))).alias("vietnamese"), one(F.coalesce(F.col("frame_id"), F.lit("")) != "").alias("with_id"), one(good_time).alias("with_time"))
