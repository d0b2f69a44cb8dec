"""Indexing as a stream: new images, or new detections, become records batch by batch.

A micro-batch writes its detections under its number, which a repeated batch overwrites. A video's home is the batch that first brought it, and every sink has a
partition for each home, so that there are as many partitions as batches, however many videos. A batch works out the records of the homes of its videos anew from
all their detections, and replaces these partitions. So a batch that broke off anywhere and runs again leaves the tables that one undisturbed run would have
left, and videos may be spread over batches. Of batches that share no video with those homes only the video ids are read, and none of their partitions is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.tracks import DETECTION, greedy_tracks, untracked
from ..sources import sinks
from ..sources.readers import IMAGES

IMAGE = "path string, modificationTime timestamp, length bigint, content binary"


def image_stream(spark: SparkSession, root: str, files_a_batch: int = 1000) -> DataFrame:
    """The images below root as they come: path, video_id, image_name, content."""
    rows = spark.readStream.schema(IMAGE).format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", IMAGES).option("maxFilesPerTrigger", files_a_batch).load(root)
    parts = F.split("path", "/")
    return rows.select("path", F.element_at(parts, -2).alias("video_id"), F.element_at(parts, -1).alias("image_name"), "content")


def records_of(detections: DataFrame, threshold: float = 0.85, max_gap: int = 120, merge: bool = True) -> DataFrame:
    rows = detections.select(*[c.split()[0] for c in DETECTION.split(", ")])
    records = greedy_tracks(rows, threshold, max_gap) if merge else untracked(rows)
    return sinks.with_id(records.withColumn("entities_json", F.concat(F.lit("["), F.array_join("entities", ","), F.lit("]"))).drop("entities"))


def index_batch(rows: DataFrame, batch: int, output: str, detect: Callable[[DataFrame], DataFrame], **options) -> None:
    """Take a batch of rows (with video_id), which detect turns into detections (schema DETECTION), into the tables below output."""
    spark = rows.sparkSession
    sinks.replace_partitions(detect(rows).withColumn("batch", F.lit(batch)), f"{output}/detections", ["batch"], ["video_id", "frame_idx", "ord"])
    kept = sinks.read_partitions(spark, f"{output}/detections", f"{DETECTION}, batch bigint")
    homes = kept.groupBy("video_id").agg(F.min("batch").alias("home"), (F.max("batch") == batch).alias("touched"), F.collect_set("batch").alias("batches"))
    stale = [r["home"] for r in homes.where("touched").select("home").distinct().collect()]  # of batches, a number each
    again = homes.where(F.col("home").isin(stale)).persist(StorageLevel.DISK_ONLY)
    needed = [r["batch"] for r in again.select(F.explode("batches").alias("batch")).distinct().collect()]
    again_home = again.select("video_id", "home")
    records = records_of(kept.where(F.col("batch").isin(needed)).join(again_home, "video_id", "left_semi"), **options).join(again_home, "video_id").persist(StorageLevel.DISK_ONLY)
    sinks.replace_videos(records, output, "home")
    records.unpersist(), again.unpersist()


def index_stream(stream: DataFrame, output: str, detect: Callable[[DataFrame], DataFrame], **options) -> StreamingQuery:
    """Start to take all that a stream has into the tables below output: detections, records, frames (JSON documents) and bulk (lines).

    Started again on the same output it goes on where it stopped, and repeats the batch in which it broke off.
    options: threshold, max_gap, merge.
    """
    take = lambda rows, batch: index_batch(rows, batch, output, detect, **options)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{output}/checkpoint").trigger(availableNow=True).start()
