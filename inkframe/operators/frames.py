"""Frame metadata: from a catalogue of image paths to time stamps, ids and deep links, by joins with small dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_FPS = 25.0


def stem(name: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", "")


def frame_index(name: Column) -> Column:
    """The first run of digits of the file name without its extension, or 0."""
    return F.coalesce(F.regexp_extract(stem(name), r"([0-9]+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def clock(ms: Column, hours: bool = True) -> Column:
    """MM:SS.mmm, or HH:MM:SS.mmm from an hour on; without hours, minutes go on counting."""
    s = F.floor(ms / 1000)
    short = F.format_string("%02d:%02d.%03d", F.floor(s / 60), s % 60, ms % 1000)
    if not hours:
        return short
    return F.when(s >= 3600, F.format_string("%02d:%02d:%02d.%03d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60, ms % 1000)).otherwise(short)


def deep_link(url: Column, seconds: Column) -> Column:
    at = F.concat(F.floor(seconds).cast("string"), F.lit("s"))
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("")).when(url.contains("?"), F.concat(url, F.lit("&t="), at)).otherwise(F.concat(url, F.lit("?t="), at))


def index_entries(index: DataFrame) -> DataFrame:
    """index (frame_id, rel_path, optionally ord) -> one frame_id for each (video_id, frame_idx), the last of its order."""
    parts = F.split(F.regexp_replace("rel_path", r"\\", "/"), "/")
    order = F.col("ord") if "ord" in index.columns else F.col("frame_id")
    rows = index.withColumn("p", parts).where(F.size("p") >= 2).select(F.element_at("p", -2).alias("video_id"), frame_index(F.element_at("p", -1)).alias("frame_idx"), "frame_id", order.alias("o"))
    return rows.groupBy("video_id", "frame_idx").agg(F.max_by("frame_id", "o").alias("frame_id"))


def catalogue(index: DataFrame) -> DataFrame:
    """Frames of an index with the video each is listed under: the first part of its path, or `unknown`."""
    path = F.regexp_replace("rel_path", r"\\", "/")
    parts = F.split(path, "/")
    return index.select("frame_id", F.when(F.size(parts) > 1, parts[0]).otherwise("unknown").alias("video_id"), path.alias("path"))


def frame_info(frames: DataFrame, fps: DataFrame, index: DataFrame, urls: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """frames (video_id, image_name) -> frame_id, video_id, frame_idx, timestamp, timestamp_ms, timestamp_str, youtube_url, fps.

    metadata (video_id, fps, frames map<name, struct<frame_idx, timestamp_ms, timestamp_str>>) overrides what the name
    says. Dimensions are joined by their keys; Spark broadcasts them where their size allows.
    """
    out = frames.join(fps.select("video_id", F.col("fps").cast("double").alias("listed_fps")), "video_id", "left")
    told = F.lit(None)
    if metadata is not None:
        out = out.join(metadata.select("video_id", F.col("fps").alias("meta_fps"), "frames"), "video_id", "left")
        told = F.try_element_at("frames", F.element_at(F.split("image_name", "/"), -1))
        out = out.withColumn("told", F.coalesce(told, F.try_element_at("frames", stem(F.col("image_name")))))
        rate = F.coalesce("listed_fps", F.col("meta_fps").try_cast("double"), F.lit(DEFAULT_FPS))
    else:
        out = out.withColumn("told", F.lit(None).cast("struct<frame_idx: bigint, timestamp_ms: bigint, timestamp_str: string>"))
        rate = F.coalesce("listed_fps", F.lit(DEFAULT_FPS))
    out = out.withColumn("fps", rate).withColumn("frame_idx", F.coalesce("told.frame_idx", frame_index(F.col("image_name"))))
    seconds = F.when(F.col("fps") > 0, F.bround(F.col("frame_idx") / F.col("fps"), 3)).otherwise(0.0)
    seconds = F.when(F.col("told").isNotNull(), F.bround(F.col("told.timestamp_ms") / 1000, 3)).otherwise(seconds)
    out = out.withColumn("timestamp", seconds)
    ms = F.coalesce("told.timestamp_ms", F.floor(F.col("timestamp") * 1000.0).cast("bigint"))
    out = out.withColumn("timestamp_ms", ms)
    text = F.when(F.col("told").isNotNull(), F.coalesce("told.timestamp_str", clock(F.col("timestamp_ms"), hours=False))).otherwise(clock(F.col("timestamp_ms")))
    out = out.join(index_entries(index), ["video_id", "frame_idx"], "left").join(urls, "video_id", "left")
    name = F.coalesce("frame_id", F.concat_ws("_", "video_id", F.col("frame_idx").cast("string")))
    return out.select(name.alias("frame_id"), "video_id", "frame_idx", "timestamp", "timestamp_ms", text.alias("timestamp_str"), deep_link(F.col("watch_url"), F.col("timestamp")).alias("youtube_url"), "fps")


def pending(videos: DataFrame, done: DataFrame) -> DataFrame:
    """Videos that no earlier run has finished."""
    return videos.join(done.select("video_id").distinct(), "video_id", "left_anti")


def frames_between(frames: DataFrame, start_s: float, end_s: float, pad: int = 200) -> DataFrame:
    """Frames (with fps) of a stretch of time, and pad frames on both sides."""
    return frames.where(F.col("frame_idx").between(F.floor(F.lit(start_s) * F.col("fps")) - pad, F.floor(F.lit(end_s) * F.col("fps")) + pad))


#: Names under which a frame's image may be stored.
IMAGE_NAMES = ["%d.jpg", "%d.webp", "%d.png", "%03d.jpg", "%04d.jpg", "%05d.jpg", "%06d.jpg", "keyframe_%d.webp", "keyframe_%d.jpg", "frame_%d.jpg", "frame_%04d.jpg"]


def image_paths(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """wanted (frame_id, video_id, frame_idx), known (frame_id, video_id, path) -> wanted with path: by id, else by frame, else by name."""
    files = known.withColumn("idx", frame_index(F.col("path"))).withColumn("name", F.element_at(F.split("path", "/"), -1))
    by_id = known.groupBy("frame_id").agg(F.min("path").alias("p1"))
    by_frame = files.groupBy("video_id", F.col("idx").alias("frame_idx")).agg(F.min("path").alias("p2"))
    names = wanted.select("video_id", "frame_idx").distinct().select("*", F.posexplode(F.array(*[F.format_string(n, "frame_idx") for n in IMAGE_NAMES])).alias("o", "name"))
    by_name = names.join(files.select("video_id", "name", "path"), ["video_id", "name"]).groupBy("video_id", "frame_idx").agg(F.min_by("path", "o").alias("p3"))
    out = wanted.join(by_id, "frame_id", "left").join(by_frame, ["video_id", "frame_idx"], "left").join(by_name, ["video_id", "frame_idx"], "left")
    return out.select(*wanted.columns, F.coalesce("p1", "p2", "p3").alias("path"))


def first_videos(frames: DataFrame, most: int) -> DataFrame:
    """Frames of the first videos in the order of their ids."""
    ids = frames.select("video_id").distinct().orderBy("video_id").limit(most)
    return frames.join(F.broadcast(ids), "video_id", "left_semi")
