"""From images to the record table and its sinks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.frames import catalogue, first_videos, frame_index, frame_info, pending
from ..operators.tracks import DETECTION, greedy_tracks, untracked
from ..sources import readers, sinks
from .vision import EMPTY, FrameReader, detections, frame_errors, read_images


def index_images(images: DataFrame, make: Callable[[], FrameReader], key: str, fps: DataFrame, index: DataFrame, urls: DataFrame, metadata: DataFrame | None = None, done: DataFrame | None = None, threshold: float = 0.85, max_gap: int = 120, merge: bool = True) -> DataFrame:
    """images (path, video_id, image_name, content) -> records. Videos in done are skipped."""
    if done is not None:
        images = pending(images, done)
    rows = detected(images, make, key, fps, index, urls, metadata)
    return greedy_tracks(rows, threshold, max_gap) if merge else untracked(rows)


def detected(images: DataFrame, make: Callable[[], FrameReader], key: str, fps: DataFrame, index: DataFrame, urls: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """images -> detections (schema DETECTION) with what is known of their frames."""
    lines = detections(read_images(images, make, key))
    info = frame_info(images.select("video_id", "image_name").distinct(), fps, index, urls, metadata)
    named = images.select("path", "video_id", "image_name")
    rows = lines.join(named.withColumn("frame_idx", frame_index(F.col("image_name"))), "path").join(info.drop("fps"), ["video_id", "frame_idx"])
    rows = rows.withColumn("entities", F.transform("entities", lambda e: F.to_json(e))).withColumn("polygon_json", F.to_json("polygon"))
    return rows.select(*[c.split()[0] for c in DETECTION.split(", ")])


def process_single_frame(spark: SparkSession, path: str, make: Callable[[], FrameReader], key: str, video_id: str = "sample_video", dims: dict | None = None) -> dict:
    """One image: its frame's metadata and detections, or an error if there is no such image or it cannot be read."""
    name = path.replace("\\", "/").rsplit("/", 1)[-1]
    if not sinks.exists(spark, path):
        return {"error": f"no such file: {path}"}
    images = spark.read.format("binaryFile").load(path).select("path", "content")
    lines = read_images(images, make, key).cache()
    try:
        if not images.limit(1).count():  # Spark's reader leaves out files of no bytes
            return {"error": EMPTY}
        wrong = frame_errors(lines).first()
        if wrong is not None:
            return {"error": wrong["error"]}
        found = [r.asDict(True) for r in detections(lines).orderBy("ord").drop("path", "ord").collect()]
    finally:
        lines.unpersist()
    frames = spark.createDataFrame([(video_id, name)], "video_id string, image_name string")
    info = frame_info(frames, **dimensions(spark, **(dims or {}))).first().asDict()
    info.pop("fps")
    return info | {"image_name": name, "detections": found}


def dimensions(spark: SparkSession, fps_file: str | None = None, index_file: str | None = None, urls_file: str | None = None, metadata_root: str | None = None) -> dict[str, DataFrame | None]:
    """The dimensions of frame_info from their files; those not given are empty."""
    return {
        "fps": readers.fps_map(spark, fps_file) if fps_file else spark.createDataFrame([], "video_id string, fps double"),
        "index": readers.index_map(spark, index_file) if index_file else spark.createDataFrame([], "frame_id string, rel_path string, ord int"),
        "urls": readers.url_map(spark, urls_file) if urls_file else spark.createDataFrame([], "video_id string, watch_url string"),
        "metadata": readers.video_metadata(spark, metadata_root) if metadata_root else None,
    }


def _resumed(spark: SparkSession, images: DataFrame, make: Callable[[], FrameReader], key: str, output: str, dims: dict, checkpoint: bool, **options) -> dict:
    """Read the videos that no earlier run has finished, add them to the log and the list, and export all records."""
    began, log, listed = time.time(), f"{output}/checkpoint/records", f"{output}/checkpoint/done"
    done = spark.read.parquet(listed) if checkpoint and sinks.exists(spark, listed) else None
    videos = images.select("video_id").distinct()
    left = videos if done is None else pending(videos, done)
    frames = images if done is None else pending(images, done)
    records = index_images(images, make, key, dims["fps"], dims["index"], dims["urls"], dims["metadata"], done, **options)
    records = records.withColumn("entities_json", F.concat(F.lit("["), F.array_join("entities", ","), F.lit("]"))).drop("entities")
    n_frames = frames.count()
    if n_frames:
        # a run that broke off after its records and before its list leaves rows that the next run must not keep twice
        records.withColumn("run", F.lit(uuid.uuid4().hex)).write.mode("append" if checkpoint else "overwrite").parquet(log)
        sinks.append_done(left, listed) if checkpoint else None
    table = spark.createDataFrame([], records.schema)
    if sinks.exists(spark, log):
        told = spark.read.parquet(log)
        last = told.groupBy("video_id").agg(F.max_by("run", F.col("_metadata.file_modification_time")).alias("run"))
        table = told.join(last, ["video_id", "run"]).drop("run")
    written = export(spark, table, output)
    seconds = time.time() - began
    totals = written.agg(F.count("*").alias("n")).first()
    n_videos = videos.count()
    return {"total_videos": n_videos, "processed_videos": n_videos if not checkpoint else spark.read.parquet(listed).distinct().count() if sinks.exists(spark, listed) else 0, "total_frames": n_frames, "total_ocr_records": totals["n"], "total_time_sec": round(seconds, 2), "avg_fps": round(n_frames / seconds, 2), "records_path": f"{output}/records", "index_path": f"{output}/index", "documents_path": f"{output}/ocr.json", "bulk_path": f"{output}/bulk"}


def process_from_index_json(spark: SparkSession, index_json: str, keyframes_root: str, make: Callable[[], FrameReader], key: str, output: str, fps_file: str | None = None, urls_file: str | None = None, checkpoint: bool = True, **options) -> dict:
    """Index the images that a catalogue lists, of the videos that are not done yet; returns totals and where the results are.

    A listed image that does not exist has no detections, like one that cannot be read.
    """
    listed = catalogue(readers.index_map(spark, index_json)).select("video_id", F.element_at(F.split("path", "/"), -1).alias("image_name"), F.concat(F.lit(keyframes_root.rstrip("/") + "/"), "path").alias("at"))
    there = readers.keyframes(spark, keyframes_root).select("path", "content")
    plain = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    images = listed.withColumn("at", plain(F.col("at"))).join(there.withColumn("at", plain(F.col("path"))), "at", "left")
    images = images.select(F.coalesce("path", "at").alias("path"), "video_id", "image_name", "content")
    return _resumed(spark, images, make, key, output, dimensions(spark, fps_file, index_json, urls_file), checkpoint, **options)


def process_dataset(spark: SparkSession, keyframes_root: str, make: Callable[[], FrameReader], key: str, output: str, metadata_root: str | None = None, fps_file: str | None = None, index_file: str | None = None, urls_file: str | None = None, checkpoint: bool = True, videos: int | None = None, **options) -> dict:
    """Index all images in folders below a root, a folder being a video, or those of the first `videos` of them."""
    images = readers.keyframes(spark, keyframes_root).unionByName(readers.empty_images(spark, keyframes_root))
    images = images if videos is None else first_videos(images, videos)
    return _resumed(spark, images, make, key, output, dimensions(spark, fps_file, index_file, urls_file, metadata_root), checkpoint, **options)


def process_stream(spark: SparkSession, keyframes_root: str, make: Callable[[], FrameReader], key: str, output: str, dims: dict | None = None, files_a_batch: int = 1000, **options) -> None:
    """Index the images below a root that no earlier call has seen, as a stream; see streaming.indexing. Files of no bytes are no images."""
    from ..streaming.indexing import image_stream, index_stream

    known = dimensions(spark, **(dims or {}))
    detect = lambda rows: detected(rows, make, key, known["fps"], known["index"], known["urls"], known["metadata"])
    index_stream(image_stream(spark, keyframes_root, files_a_batch), output, detect, **options).awaitTermination()


def process_video_keyframes(images: DataFrame, video_id: str, make: Callable[[], FrameReader], key: str, dims: dict, **options) -> DataFrame:
    """The records of one video's images."""
    return index_images(images.where(F.col("video_id") == video_id), make, key, dims["fps"], dims["index"], dims["urls"], dims["metadata"], **options)


def export(spark: SparkSession, records: DataFrame, folder: str) -> DataFrame:
    """All sinks from one computation of the records: the table is written first, and the others read it."""
    if "entities" in records.columns:
        records = records.withColumn("entities_json", F.concat(F.lit("["), F.array_join("entities", ","), F.lit("]"))).drop("entities")
    sinks.write_records(records, f"{folder}/records")
    table = spark.read.parquet(f"{folder}/records").withColumn("id", F.xxhash64("video_id", "frame_idx", "text", "frame_start", "frame_end"))
    typed = table.withColumn("entities", F.from_json("entities_json", "array<struct<type: string, value: string, span: struct<start: int, end: int>>>"))
    sinks.write_index(typed, f"{folder}/index")
    sinks.write_frame_documents(typed, f"{folder}/frames")
    sinks.write_keyed_documents(typed, f"{folder}/ocr.json")
    sinks.write_bulk(typed, f"{folder}/bulk")
    return table
