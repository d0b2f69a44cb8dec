"""python -m inkframe.cli index|smoke|search|evaluate|package|bulk|demo ...

index and smoke read images, with a reader named as module:callable (see plans/vision.py); the others read a table of records
written by inkframe.sources.sinks.
"""

from __future__ import annotations

import argparse
import importlib
import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from .operators import evaluate as E, packaging as K, search as Q
from .sources import readers, sinks


def records(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    if "id" not in rows.columns:
        rows = rows.withColumn("id", F.xxhash64("video_id", "frame_idx", "text", "frame_start", "frame_end"))
    if "entities" not in rows.columns:
        rows = rows.withColumn("entities", F.from_json("entities_json", "array<struct<type: string, value: string>>"))
    return rows


def indexed(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Totals of a run, and for a smoke test also the records' quality ratios."""
    from .operators.documents import quality_ratios
    from .plans.indexing import process_dataset, process_from_index_json

    module, _, name = a.reader.partition(":")
    make, smoke = getattr(importlib.import_module(module), name), a.command == "smoke"
    if a.index and not smoke and a.videos is None:
        return process_from_index_json(spark, a.index, a.keyframes, make, a.reader, a.out, a.fps, a.urls)
    out = process_dataset(spark, a.keyframes, make, a.reader, a.out, a.metadata, a.fps, a.index, a.urls, checkpoint=not smoke, videos=a.videos)
    return out | quality_ratios(records(spark, out["records_path"])).first().asDict() if smoke else out


def demo(table: DataFrame, query: str) -> dict:
    from .operators.tools import SceneTextTools

    tools = SceneTextTools(table)
    hits = tools.tool_search_ocr(query, 5)
    out: dict = {"search": hits}
    if hits:
        video, frame = hits[0]["video_id"], hits[0]["frame_idx"]
        out |= {"frame": tools.tool_read_frame_text(video, frame), "left half": tools.tool_inspect_roi(video, frame, [0.0, 0.0, 1.0, 0.5]), "entities": tools.tool_extract_entities_in_video(video)}
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="inkframe")
    sub = parser.add_subparsers(dest="command", required=True)
    s = sub.add_parser("search", help="one query; `--video` and `--entity` may also stand in the query")
    s.add_argument("records"), s.add_argument("query"), s.add_argument("--top-k", type=int, default=50), s.add_argument("--video"), s.add_argument("--entity")
    e = sub.add_parser("evaluate", help="R@k of a benchmark file, or of the built-in one")
    e.add_argument("records"), e.add_argument("--benchmark")
    p = sub.add_parser("package", help="answers to a folder of query files as an archive")
    p.add_argument("records"), p.add_argument("queries"), p.add_argument("out")
    i = sub.add_parser("index", help="images to records, index, documents and bulk lines; goes on where an earlier run ended")
    m = sub.add_parser("smoke", help="the same for a few videos, anew, with what the records are like")
    for x in (i, m):
        x.add_argument("keyframes"), x.add_argument("out"), x.add_argument("--reader", required=True), x.add_argument("--fps"), x.add_argument("--index"), x.add_argument("--urls"), x.add_argument("--metadata"), x.add_argument("--videos", type=int, default=None if x is i else 2)
    b = sub.add_parser("bulk", help="frame documents of records as lines for a bulk load")
    b.add_argument("records"), b.add_argument("out"), b.add_argument("--index-name", default="frames_ocr")
    d = sub.add_parser("demo", help="the tools' answers about one frame and its video")
    d.add_argument("records"), d.add_argument("query")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("inkframe").getOrCreate()
    from .ship import ensure_shipped

    ensure_shipped(spark)
    if a.command in ("index", "smoke"):
        print(json.dumps(indexed(spark, a), indent=2))
        return
    table = records(spark, a.records)
    if a.command == "bulk":
        sinks.write_bulk(table, a.out, a.index_name)
    elif a.command == "demo":
        print(json.dumps(demo(table, a.query), indent=2, ensure_ascii=False, default=str))
    elif a.command == "search":
        asked = Q.parse_query(a.query)
        query = spark.createDataFrame([("q", asked["query"])], "qid string, query string")
        hits = Q.payloads(Q.search(table, query, a.top_k, a.video or asked["video_id"], a.entity or asked["entity_type"])).cache()
        Q.result_table(hits).orderBy("rank").show(20, truncate=False)
        hits.where("rank <= 5").orderBy("rank").select("submission_kis", "submission_qa").show(5, truncate=False)
    elif a.command == "evaluate":
        truth = readers.benchmark_queries(spark, a.benchmark)
        began = time.time()
        scores = E.evaluate(Q.search(table, truth.select("qid", "query"), 100), truth).cache()
        scores.count()
        took = time.time() - began
        scores.orderBy("qid").show(100, truncate=False)
        E.benchmark_means(scores, took).show(truncate=False)
    else:
        asked = readers.query_files(spark, a.queries)
        rows = K.answer_rows(Q.search(table, asked, 100), asked.select("qid", F.col("qid").alias("name")))
        print(K.validate(K.package_hits(rows, a.out)))


if __name__ == "__main__":
    main()
