import json

import pytest
from pyspark.sql import functions as F

from inkframe.functions import spatial as G
from inkframe.operators import documents as D, packaging as K
from inkframe.sources import readers, sinks
from inkframe.sources.single_file import write_single_file

E = "array<struct<type: string, value: string>>"
KIND = f"id long, frame_id string, video_id string, frame_idx long, timestamp double, timestamp_str string, youtube_url string, text string, bbox_ymin double, bbox_xmin double, bbox_ymax double, bbox_xmax double, entities {E}, occurrences long"


def records(spark):
    price = [("PRICE", "60k")]
    return spark.createDataFrame([(1, "500", "V", 500, 1.0, "a", "u", "QUÁN PHỞ THÌN 60k", 0.1, 0.1, 0.3, 0.6, price + price, 1), (2, "500", "V", 500, 2.0, "a", "w", "  ", 0.0, 0.1, 0.1, 0.2, price + [("NUMBER", "5")], 1), (3, "500", "V", 500, 2.0, "a", "w", "top", 0.0, 0.0, 0.1, 0.2, None, 1), (4, "7", "W", 7, 2.0, "a", "w", None, 0.0, 0.0, 0.1, 0.2, [], 1)], KIND)


def test_frame_documents(spark):
    got = {r["frame_id"]: r for r in D.frame_documents(records(spark)).collect()}
    assert got["500"]["ocr_text"] == "QUÁN PHỞ THÌN 60k | top" and got["500"]["timestamp"] == 1.0
    assert [e["value"] for e in got["500"]["entities"]] == ["60k", "60k", "5"] and got["7"]["ocr_text"] == ""
    lines = D.bulk_lines(records(spark)).where("frame_id = '500'").orderBy("part").collect()
    assert json.loads(lines[0]["line"]) == {"index": {"_index": "frames_ocr", "_id": "500"}}
    assert json.loads(lines[1]["line"]) == {"ocr_text": "QUÁN PHỞ THÌN 60k top", "video_id": "V", "frame_idx": 500, "timestamp": 1.0}


def test_reads(spark):
    r = {x["video_id"]: x for x in D.read_frames(records(spark)).collect()}
    assert r["V"]["text"] == "top | QUÁN PHỞ THÌN 60k" and r["V"]["total"] == 3
    roi = lambda *b: [x["text"] for x in D.roi_text(records(spark).where("video_id = 'V'"), G.box(*map(F.lit, b))).collect()]
    assert roi(0.15, 0.0, 0.5, 0.8) == ["QUÁN PHỞ THÌN 60k"] and roi(0.7, 0.7, 0.9, 0.9) == []
    assert D.video_entities(records(spark), "price").count() == 3 and len(D.TOOL_SCHEMAS) == 3 and D.TOOL_SCHEMAS[0]["name"] == "search_ocr_text"
    assert [x["id"] for x in D.frame_detections(records(spark), "V", 500).collect()] == [3, 2, 1]
    assert D.run_summary(records(spark).select("video_id", "frame_idx").distinct(), records(spark)).first()["records"] == 4


def test_flat_records(spark):
    rows = spark.createDataFrame([("V", 3, "t", [0.1, 0.2, 0.3, 0.4])], "video_id string, frame_idx long, text string, bbox_norm array<double>")
    r = sinks.flat_records(rows).first()
    assert len(r) == 19 and r["frame_id"] == "V_3" and r["frame_end"] == 3 and r["bbox_ymax"] == 0.3 and r["entities_json"] == "[]" and r["timestamp_str"] == "00:00:00.000"
    assert len(sinks.flat_records(rows.limit(0)).columns) == 19


def test_packaging(spark, tmp_path):
    rows = spark.createDataFrame([("L10_V001.mp4", ["1200", "1850"], 'a, "b"')], "v string, f array<string>, a string")
    r = rows.select(K.trake_row(F.col("v"), F.col("f")).alias("t"), K.csv_line(K.qa_row(F.col("v"), F.lit("25 300"), F.col("a"))).alias("q")).first()
    assert r["t"] == ["L10_V001", "1200", "1850"] and r["q"] == 'L10_V001,25300,"a, ""b"""'
    assert K.csv_text([["a, b", 'q"', 1]]) == '"a, b","q""",1\n'
    path = K.package({"one": [["V", 1]] * 150, "two": str(tmp_path / "absent.csv")}, str(tmp_path / "x/s.zip"))
    assert K.validate(path) == (True, [])
    K.save_csv([["a"]], str(tmp_path / "long.csv"))
    (tmp_path / "long.csv").write_text("a\n" * 101)
    assert not K.validate(K.package({"l": str(tmp_path / "long.csv")}, str(tmp_path / "y.zip")))[0]
    (tmp_path / "no.zip").write_text("x")
    assert not K.validate(str(tmp_path / "no.zip"))[0]
    hits = spark.createDataFrame([("q", 1, "V.mp4", 5, "sign text", [("PRICE", "9k")]), ("k", 1, "V", 6, "t", [])], f"qid string, rank int, video_id string, frame_idx long, text string, entities {E}")
    names = spark.createDataFrame([("q", "x_QA_trake"), ("k", "kis1")], "qid string, name string")
    assert sorted((r["name"], r["fields"]) for r in K.answer_rows(hits, names).collect()) == [("kis1", ["V", "6"]), ("x_QA_trake", ["V", "5", "9k"])]
    assert K.validate(K.package_hits(K.answer_rows(hits, names), str(tmp_path / "z.zip"))) == (True, [])


def test_readers(spark, tmp_path):
    (tmp_path / "q").mkdir()
    (tmp_path / "q/a.txt").write_text("  find it \n")
    assert [tuple(r) for r in readers.query_files(spark, str(tmp_path / "q")).collect()] == [("a", "find it")]
    (tmp_path / "log.jsonl").write_text('{"video_id": "V", "frame_idx": 3}\n\n{"video_id": "W"}\n')
    assert readers.checkpoint_records(spark, str(tmp_path / "log.jsonl")).count() == 2
    assert readers.benchmark_queries(spark).count() == 4
    (tmp_path / "bench.json").write_text(json.dumps([{"query_id": "x", "type": "QA", "query_text": "pho", "ground_truth": {"video_id": "V", "frame_range": [3, 9], "answer": "60k"}}, {"query_id": "y", "type": "KIS", "query_text": "com", "ground_truth": {"video_id": "W", "frame_range": [0, 1]}}]))
    assert sorted(map(tuple, readers.benchmark_queries(spark, str(tmp_path / "bench.json")).collect())) == [("x", "QA", "pho", "V", 3, 9, "60k"), ("y", "KIS", "com", "W", 0, 1, "")]
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers/one.csv").write_text("V,1\nW,2\n")
    assert sorted(map(tuple, readers.answer_csvs(spark, str(tmp_path / "answers")).collect())) == [("one", "V,1"), ("one", "W,2")]


def test_settings(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("deduplicator:\n  max_frame_gap: 15\n")
    (tmp_path / "b.yaml").write_text("")
    assert readers.settings(str(tmp_path / "a.yaml")) == {"deduplicator": {"max_frame_gap": 15}} and readers.settings(str(tmp_path / "b.yaml")) == {}


def test_documents_in_one_object(spark, tmp_path):
    sinks.write_keyed_documents(records(spark), str(tmp_path / "ocr.json"))
    got = json.loads((tmp_path / "ocr.json").read_text(encoding="utf-8"))
    assert list(got) == ["500", "7"] and got["7"] == {"ocr_text": "", "video_id": "W", "frame_idx": 7, "timestamp": 2.0, "youtube_url": "w", "entities": []}
    assert got["500"]["ocr_text"] == "QUÁN PHỞ THÌN 60k | top" and [e["value"] for e in got["500"]["entities"]] == ["60k", "60k", "5"]
    sinks.write_keyed_documents(records(spark).limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == {}


def test_single_file_of_many_tasks(spark, tmp_path):
    at = tmp_path / "whole.txt"
    rows = spark.range(5000).select("id", F.concat(F.lit("é"), F.col("id").cast("string")).alias("text"))
    write_single_file(rows.repartition(7), str(at), ["id"], head="[", between=",", tail="]")
    assert at.read_text(encoding="utf-8") == "[" + ",".join(f"é{i}" for i in range(5000)) + "]"
    fails = rows.withColumn("text", F.when(F.col("id") == 4321, F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken"):
        write_single_file(fails, str(at), ["id"])
    assert [p.name for p in tmp_path.iterdir()] == ["whole.txt"] and at.stat().st_size > 5000  # no parts, and the older file is whole
    write_single_file(rows.limit(0), f"file://{at}", ["id"], empty="none")
    assert at.read_text() == "none"


def test_open_index(spark, tmp_path):
    from inkframe.operators import search as Q

    log = tmp_path / "log.jsonl"
    assert sinks.open_index(spark, [str(tmp_path / "no")], [str(log)]) is None
    rows = [{"frame_id": "1", "video_id": "V", "frame_idx": 5, "text": "CƠM TẤM 45k", "text_unsigned": "com tam 45k", "confidence": 0.9, "frame_start": 5, "frame_end": 5, "bbox_norm": [0.1, 0.2, 0.3, 0.4], "entities": [{"type": "PRICE", "value": "45k", "span": [8, 11]}]}]
    log.write_text("\n".join(map(json.dumps, rows + rows)) + "\n")
    found, index, sizes = sinks.open_index(spark, [str(tmp_path / "no")], [str(log)])
    ask = spark.createDataFrame([("q", "com tam")], "qid string, query string")
    assert [tuple(r) for r in Q.search(found, ask, index=index, sizes=sizes).select("video_id", "frame_idx").collect()] == [("V", 5)]
    again = sinks.open_index(spark, [str(log) + ".index"], [])
    assert again[0].count() == 1 and again[2].first()["d"] == 6
    assert sorted(map(tuple, Q.match_counts(index, ["cơm tấm", "tam com", "45k", "-"]).collect())) == [("-", 0), ("45k", 1), ("cơm tấm", 1), ("tam com", 0)]
    like = lambda text: Q.like_search(found, spark.createDataFrame([("q", text)], "qid string, query string")).count()
    assert like("TẤM") == 1 and like("x") == 0
    assert Q.result_table(Q.search(found, ask), width=3).first()["text"] == "CƠM..."


def test_command_line(spark, tmp_path, capsys):
    from inkframe import cli

    rows = records(spark).withColumn("confidence", F.lit(0.9)).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_unsigned", F.lower("text"))
    rows.write.parquet(str(tmp_path / "r"))
    cli.main(["bulk", str(tmp_path / "r"), str(tmp_path / "bulk"), "--index-name", "i"])
    assert spark.read.text(str(tmp_path / "bulk")).where("value like '%\"_index\":\"i\"%'").count() == 2
    cli.main(["demo", str(tmp_path / "r"), "top"])
    told = capsys.readouterr().out
    assert json.loads(told[told.index("{") :])["frame"]["total_detections"] == 3
    cli.main(["search", str(tmp_path / "r"), "top --video V"])
    cli.main(["evaluate", str(tmp_path / "r")])
    assert "latency_ms" in capsys.readouterr().out


def test_tools(spark):
    from inkframe.functions import text as X
    from inkframe.operators import search as Q
    from inkframe.operators.tools import SceneTextTools

    rows = records(spark).withColumn("confidence", F.lit(0.9)).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_unsigned", X.to_unsigned(F.col("text")))
    tools = SceneTextTools(rows)
    hit = tools.tool_search_ocr("pho thin")[0]
    assert list(hit) == ["video_id", "frame_idx", "timestamp_str", "detected_text", "confidence", "bbox_norm", "entities", "submission_kis", "submission_qa"]
    assert hit["video_id"] == "V" and hit["submission_kis"] == "V, 500" and hit["submission_qa"] == "V, 500, 60k" and hit["detected_text"] == "QUÁN PHỞ THÌN 60k" and hit["bbox_norm"] == [0.1, 0.1, 0.3, 0.6]
    frame = tools.tool_read_frame_text("V", 500)
    assert list(frame) == ["video_id", "frame_idx", "total_detections", "full_transcription", "detections", "extracted_entities"]
    assert frame["total_detections"] == 3 and frame["full_transcription"] == "top |    | QUÁN PHỞ THÌN 60k" and [d["id"] for d in frame["detections"]] == [3, 2, 1] and len(frame["extracted_entities"]) == 4
    assert tools.tool_read_frame_text("V", 1) == {"video_id": "V", "frame_idx": 1, "total_detections": 0, "full_transcription": "", "detections": [], "extracted_entities": []}
    roi = tools.tool_inspect_roi("V", 500, [0, 0, 0.5, 0.8])
    assert roi["matched_text"].endswith("60k") and roi["roi"] == [0, 0, 0.5, 0.8] and len(roi["detections"]) == 3
    assert tools.tool_inspect_roi("V", 500, [0.7, 0.7, 0.9, 0.9])["matched_text"] == ""
    found = tools.tool_extract_entities_in_video("V", "price")
    assert len(found) == 3 and found[0] == {"video_id": "V", "frame_idx": 500, "timestamp_str": "a", "raw_text": "QUÁN PHỞ THÌN 60k", "entity_type": "PRICE", "entity_value": "60k", "bbox_norm": [0.1, 0.1, 0.3, 0.6]}
    schemas = tools.get_tool_schemas()
    assert [s["name"] for s in schemas] == ["search_ocr_text", "read_frame_text", "inspect_roi_text"] and schemas[0]["parameters"]["properties"]["entity_type"]["enum"][0] == "PRICE"
    assert Q.parse_query("com tam --video V1 --entity PRICE") == {"query": "com tam", "video_id": "V1", "entity_type": "PRICE"}
