"""Sources as DataFrames. Nothing is read on the driver but settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip

IMAGES = "*.{webp,WEBP,jpg,JPG,png,PNG,jpeg,JPEG}"
RECORDS = "frame_id string, video_id string, frame_idx bigint, timestamp double, timestamp_ms bigint, timestamp_str string, youtube_url string, frame_start bigint, frame_end bigint, occurrences bigint, text string, text_unsigned string, confidence double, bbox_norm array<double>, polygon array<array<int>>, entities array<struct<type: string, value: string, span: array<int>>>"
METADATA = "fps string, frames map<string, struct<frame_idx: bigint, timestamp_ms: bigint, timestamp_str: string>>"


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")


def keyframes(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """path, video_id (the folder's name), image_name, and the image's bytes, of all images below root."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", IMAGES).load(root).dropDuplicates(["path"]) if not content else spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", IMAGES).load(root)
    parts = F.split("path", "/")
    return rows.select("path", F.element_at(parts, -2).alias("video_id"), F.element_at(parts, -1).alias("image_name"), *(["content"] if content else []))


def empty_images(spark: SparkSession, root: str) -> DataFrame:
    """The images of no bytes below root, which Spark's reader leaves out, in the columns of keyframes with null content.

    Takes the list of files that the driver makes for every scan.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", IMAGES).load(root)
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    listed = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string")
    listed = listed.select(plain(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))).alias("path")).distinct()
    parts = F.split("path", "/")
    left = listed.join(found.select(plain(F.col("path")).alias("path")), "path", "left_anti")
    return left.select("path", F.element_at(parts, -2).alias("video_id"), F.element_at(parts, -1).alias("image_name"), F.lit(None).cast("binary").alias("content"))


def videos(spark: SparkSession, root: str) -> DataFrame:
    return keyframes(spark, root, content=False).select("video_id").distinct()


def index_map(spark: SparkSession, path: str) -> DataFrame:
    """frame_id, rel_path, ord of a JSON object; entries keep their order."""
    entries = F.map_entries(F.from_json("value", "map<string, string>"))
    return _whole(spark, path).select(F.posexplode(entries).alias("ord", "e")).select(F.col("e.key").alias("frame_id"), F.col("e.value").alias("rel_path"), "ord")


def fps_map(spark: SparkSession, path: str) -> DataFrame:
    """video_id, fps of a JSON object; what is not a number is left out."""
    rows = _whole(spark, path).select(F.explode(F.from_json("value", "map<string, string>")).alias("video_id", "f"))
    return rows.select("video_id", F.col("f").try_cast("double").alias("fps")).where("fps is not null")


def url_map(spark: SparkSession, path: str) -> DataFrame:
    """video_id, watch_url of a JSON list of objects or of a JSON object."""
    rows = _whole(spark, path)
    listed = rows.where(F.ltrim("value").startswith("[")).select(F.explode(F.from_json("value", "array<struct<video_id: string, watch_url: string>>")).alias("e")).select("e.video_id", "e.watch_url")
    mapped = rows.where(F.ltrim("value").startswith("{")).select(F.explode(F.from_json("value", "map<string, string>")).alias("video_id", "watch_url"))
    return listed.unionByName(mapped).where("video_id is not null and watch_url is not null")


def video_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """video_id (the file's stem), fps, frames of per-video JSON files; unreadable ones have nulls."""
    rows = _whole(spark, f"{folder.rstrip('/')}/*.json")
    stem = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.json$", "")
    return rows.select(stem.alias("video_id"), F.from_json("value", METADATA).alias("m")).select("video_id", "m.fps", "m.frames")


def checkpoint_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-lines log; blank lines are skipped."""
    return spark.read.schema(RECORDS).json(path)


def query_files(spark: SparkSession, folder: str) -> DataFrame:
    """qid (the file's stem), query of text files."""
    rows = _whole(spark, f"{folder.rstrip('/')}/*.txt")
    return rows.select(F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.txt$", "").alias("qid"), strip(F.col("value")).alias("query"))


def answer_csvs(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.text(f"{folder.rstrip('/')}/*.csv")
    return rows.select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.csv$", "").alias("name"), F.col("value").alias("line"))


#: The built-in benchmark; F8 of the fixtures.
BENCHMARK = [("Q01_KIS", "KIS", "ba ghien", "L01_V001", 140, 160, ""), ("Q02_QA_PRICE", "QA", "pho thin", "L01_V001", 490, 510, "60k"), ("Q03_KIS_PLATE", "KIS", "59-x3", "L02_V005", 870, 895, ""), ("Q04_QA_STORE", "QA", "circle k", "L03_V010", 2440, 2460, "Circle K")]


def benchmark_queries(spark: SparkSession, path: str | None = None) -> DataFrame:
    """qid, type, query, video, start, end, answer."""
    schema = "qid string, type string, query string, video string, start bigint, end bigint, answer string"
    if path is None:
        return spark.createDataFrame(BENCHMARK, schema)
    rows = spark.read.schema("query_id string, type string, query_text string, ground_truth struct<video_id: string, frame_range: array<bigint>, answer: string>").json(path, multiLine=True)
    return rows.select(F.col("query_id").alias("qid"), "type", F.col("query_text").alias("query"), F.col("ground_truth.video_id").alias("video"), F.col("ground_truth.frame_range")[0].alias("start"), F.col("ground_truth.frame_range")[1].alias("end"), F.coalesce("ground_truth.answer", F.lit("")).alias("answer"))


def settings(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
