"""Sinks of the record table. Spark's commit protocol makes each whole or absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.documents import bulk_lines, frame_documents
from ..operators.search import postings
from .readers import checkpoint_records
from .single_file import write_single_file


def flat_records(records: DataFrame, *more: str) -> DataFrame:
    """The 19 columns of the record table, with defaults for what is missing, and more columns as they are. Boxes may be bbox_norm or four columns."""
    have = set(records.columns)

    def col(name: str, kind: str, default) -> F.Column:
        value = F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)
        return F.coalesce(value, default.cast(kind)).alias(name)

    def edge(name: str, i: int):
        value = F.col(name) if name in have else F.get("bbox_norm", F.lit(i)) if "bbox_norm" in have else F.lit(None)
        return F.coalesce(value.cast("double"), F.lit(0.0)).alias(name)

    def text_of(name: str):
        flat = f"{name}_json"
        value = F.col(flat) if flat in have else F.to_json(name) if name in have and records.schema[name].dataType.typeName() == "array" else F.lit(None)
        return F.coalesce(value.cast("string"), F.lit("[]")).alias(flat)

    at, ms = F.col("frame_idx"), F.col("timestamp_ms") if "timestamp_ms" in have else F.lit(0)
    return records.select(
        col("frame_id", "string", F.concat_ws("_", "video_id", at.cast("string"))), col("video_id", "string", F.lit("")), col("frame_idx", "bigint", F.lit(0)),
        col("timestamp", "double", F.bround(F.coalesce(ms, F.lit(0)) / 1000, 3)), col("timestamp_ms", "bigint", F.lit(0)), col("timestamp_str", "string", F.lit("00:00:00.000")), col("youtube_url", "string", F.lit("")),
        col("frame_start", "bigint", at), col("frame_end", "bigint", at), col("occurrences", "bigint", F.lit(1)), col("text", "string", F.lit("")), col("text_unsigned", "string", F.lit("")), col("confidence", "double", F.lit(0.0)),
        edge("bbox_ymin", 0), edge("bbox_xmin", 1), edge("bbox_ymax", 2), edge("bbox_xmax", 3), text_of("polygon"), text_of("entities"), *more,
    )


RECORDS = "frame_id string, video_id string, frame_idx bigint, timestamp double, timestamp_ms bigint, timestamp_str string, youtube_url string, frame_start bigint, frame_end bigint, occurrences bigint, text string, text_unsigned string, confidence double, bbox_ymin double, bbox_xmin double, bbox_ymax double, bbox_xmax double, polygon_json string, entities_json string"
ENTITIES = "array<struct<type: string, value: string, span: struct<start: int, end: int>>>"


def with_id(records: DataFrame) -> DataFrame:
    return records.withColumn("id", F.xxhash64("video_id", "frame_idx", "text", "frame_start", "frame_end"))


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    """Dealt out by ranges of the order, so that a long video is several files, each in order."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def write_records(records: DataFrame, path: str, by_video: bool = False, mode: str = "overwrite") -> None:
    """The record table in the order of video and first frame."""
    writer = _in_order(flat_records(records), "video_id", "frame_start", "frame_idx").write.mode(mode).option("compression", "snappy")
    (writer.partitionBy("video_id") if by_video else writer).parquet(path)


def replace_partitions(rows: DataFrame, path: str, keys: list[str], order: list[str], kind: str = "parquet") -> None:
    """Write rows under the values of keys; partitions that rows have are replaced, all others stay."""
    dealt = _in_order(rows, *keys, *order)
    dealt = dealt.select("line", *keys) if kind == "text" else dealt
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).format(kind).save(path)


def read_partitions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What replace_partitions has written, the keys as the schema says; a key that was empty comes back as an empty string."""
    rows = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) if c == "video_id" else F.col(c) for c in names])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The record table by video, with id and typed entities, as searches and documents take it."""
    return typed_records(read_partitions(spark, path, RECORDS))


def typed_records(rows: DataFrame) -> DataFrame:
    return with_id(rows).withColumn("entities", F.from_json("entities_json", ENTITIES))


def replace_videos(records: DataFrame, folder: str, group: str = "video_id") -> None:
    """Replace the videos of records, and no others, in the record table, the frame documents and the bulk lines below a folder.

    Documents and lines are made from the table as written. A video without records keeps what it had. group: another column of records (bigint) with few values,
    which then are the partitions; records must have all videos of a group that they have any of.
    """
    spark = records.sparkSession
    if group == "video_id":
        replace_partitions(flat_records(records), f"{folder}/records", ["video_id"], ["frame_start", "frame_idx"])
        table = read_records(spark, f"{folder}/records").join(records.select("video_id").distinct(), "video_id", "left_semi")
        grouped = lambda rows: rows
    else:
        groups = [r[group] for r in records.select(group).distinct().collect()]
        replace_partitions(flat_records(records, group), f"{folder}/records", [group], ["video_id", "frame_start", "frame_idx"])
        table = typed_records(read_partitions(spark, f"{folder}/records", f"{RECORDS}, {group} bigint").where(F.col(group).isin(groups)))
        of_video = table.select("video_id", group).distinct()
        grouped = lambda rows: rows.join(of_video, "video_id")
    replace_partitions(grouped(frame_documents(table).drop("id")), f"{folder}/frames", [group], ["frame_id"], "json")
    replace_partitions(grouped(bulk_lines(table)), f"{folder}/bulk", [group], ["frame_id", "part"], "text")


def write_index(records: DataFrame, path: str) -> None:
    """records (with id) and postings, the latter sorted by term so that a scan for a term or prefix skips row groups."""
    records.write.mode("overwrite").parquet(f"{path}/records")
    postings(records).repartitionByRange("term").sortWithinPartitions("term", "id", "col", "pos").write.mode("overwrite").parquet(f"{path}/postings")
    written = records.sparkSession.read.parquet(f"{path}/postings")
    written.groupBy("id").agg(F.count("*").alias("d")).write.mode("overwrite").parquet(f"{path}/sizes")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """records, postings and sizes of a written index."""
    return tuple(spark.read.parquet(f"{path}/{t}") for t in ("records", "postings", "sizes"))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def open_index(spark: SparkSession, folders: list[str], logs: list[str]) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The first written index among folders; else one built, beside it, from the first log of records that has any; else None."""
    for folder in folders:
        if exists(spark, f"{folder}/sizes/_SUCCESS"):
            return read_index(spark, folder)
    for log in logs:
        if exists(spark, log):
            rows = checkpoint_records(spark, log)
            if rows.limit(1).count():
                at = f"{log.rstrip('/')}.index"
                rows = rows.withColumn("id", F.xxhash64("video_id", "frame_idx", "text", "frame_start", "frame_end")).withColumn("entities", F.transform("entities", lambda e: F.struct(e["type"].alias("type"), e["value"].alias("value"))))
                edges = [F.get("bbox_norm", F.lit(i)).alias(n) for i, n in enumerate(("bbox_ymin", "bbox_xmin", "bbox_ymax", "bbox_xmax"))]
                write_index(rows.dropDuplicates(["id"]).select("*", *edges).drop("bbox_norm", "polygon"), at)
                return read_index(spark, at)
    return None


def write_frame_documents(records: DataFrame, path: str) -> None:
    """JSON lines, one document per frame."""
    frame_documents(records).drop("id").write.mode("overwrite").json(path)


def keyed_documents(records: DataFrame) -> DataFrame:
    """frame_id and the document that it is the key of in a JSON object: text, video, frame, time, link, entities."""
    body = F.struct("ocr_text", F.coalesce("video_id", F.lit("")).alias("video_id"), F.coalesce("frame_idx", F.lit(0)).alias("frame_idx"), F.coalesce("timestamp", F.lit(0.0)).alias("timestamp"), F.coalesce("youtube_url", F.lit("")).alias("youtube_url"), "entities")
    return frame_documents(records).select("id", "frame_id", F.to_json(body).alias("document"))


def write_keyed_documents(records: DataFrame, path: str) -> None:
    """One JSON object of all frame documents by frame_id, in the order of their first records. Tasks write parts and the commit joins them."""
    key = F.to_json(F.array(F.coalesce("frame_id", F.lit(""))))
    entry = F.concat(F.substring(key, F.lit(2), F.char_length(key) - 2), F.lit(": "), "document")
    write_single_file(keyed_documents(records).select("id", entry.alias("text")), path, ["id"], head="{\n", between=",\n", tail="\n}", empty="{}")


def write_bulk(records: DataFrame, path: str, index: str = "frames_ocr") -> None:
    """Action and document lines; the two lines of a frame stay together."""
    bulk_lines(records, index=index).repartition("frame_id").sortWithinPartitions("frame_id", "part").select("line").write.mode("overwrite").text(path)


def append_checkpoint(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def append_done(videos: DataFrame, path: str) -> None:
    """Add to the list of finished videos; what a run that broke off has appended without this is not counted."""
    videos.select("video_id").distinct().write.mode("append").parquet(path)
