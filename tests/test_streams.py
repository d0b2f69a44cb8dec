"""Indexing as a stream, tracks with timers, and sinks that replace single videos."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from inkframe.operators import tracks as R
from inkframe.plans import indexing
from inkframe.sources import sinks
from inkframe.streaming import indexing as S
from inkframe.streaming.tracks import ROCKSDB, timed_tracks

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import it
BOX = (0.1, 0.2, 0.3, 0.8)
KEYS = ["video_id", "frame_start", "frame_end", "occurrences", "text"]


def detections(spark, rows):
    """rows (video, frame, text)."""
    whole = [(v, f"{v}_{f}", f, f / 25, f * 40, "", "", k, t, t, 0.5, *BOX, "[]", ['{"type": "E", "value": "' + (t or "") + '"}']) for k, (v, f, t) in enumerate(rows)]
    return spark.createDataFrame(whole, R.DETECTION)


def told(df):
    return sorted(map(str, df.select(*KEYS).collect()))


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


ROWS = [(v, f, t) for v in ("1", "L2", "") for f in range(0, 1000, 50) for t in ("phở bò", "bún chả")[: 1 + f % 100 // 50]] + [("L2", 1200, "phở bò"), ("L2", 1250, "phở  bò!")]


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_a_stream_of_batches_that_break_off(spark, tmp_path, monkeypatch):
    """Videos are spread over batches; one breaks off after its detections, one after the records, and is run again."""
    whole = detections(spark, ROWS)
    want = told(S.records_of(whole))
    for k, part in enumerate((whole.where("frame_idx < 330"), whole.where("frame_idx between 330 and 800"), whole.where("frame_idx > 800"))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    out, steps = str(tmp_path / "out"), []
    real, docs = sinks.replace_videos, sinks.bulk_lines

    def breaks(*a, **b):
        steps.append("x")
        if steps.count("x") == 2:
            raise RuntimeError("lost")
        return real(*a, **b)

    def later(*a, **b):
        steps.append("y")
        if steps.count("y") == 2:
            raise RuntimeError("lost")
        return docs(*a, **b)

    monkeypatch.setattr(sinks, "replace_videos", breaks)
    monkeypatch.setattr(sinks, "bulk_lines", later)
    run = lambda: S.index_stream(stream_of(spark, tmp_path / "in", whole.schema), out, lambda rows: rows).awaitTermination()
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    run()
    table = sinks.read_records(spark, f"{out}/records")
    assert told(table) == want and {r["video_id"] for r in table.select("video_id").distinct().collect()} == {"1", "L2", ""}
    assert sinks.read_partitions(spark, f"{out}/detections", f"{R.DETECTION}, batch bigint").count() == len(ROWS)
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{out}/bulk").select("value").collect()]
    frames = table.select("frame_id").distinct().count()
    assert len(lines) == 2 * frames and spark.read.json(f"{out}/frames").count() == frames


def test_one_video_is_replaced(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.replace_videos(S.records_of(detections(spark, ROWS)), out)
    before = files_of(out)
    sinks.replace_videos(S.records_of(detections(spark, [("L2", 0, "new")])), out)
    after = files_of(out)
    assert {p for p in before if after.get(p) != before[p]} == {p for p in before if "video_id=L2" in p} and all("video_id=L2" in p for p in set(after) - set(before))
    assert told(sinks.read_records(spark, f"{out}/records").where("video_id = 'L2'")) == told(S.records_of(detections(spark, [("L2", 0, "new")])))


def test_records_are_written_in_order(spark, tmp_path):
    records = S.records_of(detections(spark, [(f"V{k % 3}", 500 * k, f"t{k}") for k in range(40)])).repartition(5)
    sinks.write_records(records, str(tmp_path / "r"))
    for name in sorted(files_of(tmp_path / "r")):
        rows = [(r["video_id"], r["frame_start"]) for r in spark.read.parquet(name).collect()]
        assert rows == sorted(rows)


class Reader:
    def read(self, image):
        text = image.decode()
        return {"width": 640, "height": 480, "scale": 1.0, "lines": [{"polygon": [[10, 10], [110, 10], [110, 30], [10, 30]], "printed": text, "printed_conf": 0.9, "marked": "", "marked_conf": 0.0}]}


def test_images_as_a_stream(spark, tmp_path):
    def image(video, frame, text):
        (tmp_path / f"k/{video}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"k/{video}/keyframe_{frame}.jpg").write_bytes(text.encode())

    out = str(tmp_path / "out")
    for v, f, s in (("V1", 0, "PHO"), ("V1", 75, "PHO"), ("V2", 0, "BUN")):
        image(v, f, s)
    indexing.process_stream(spark, str(tmp_path / "k"), Reader, "stream", out, files_a_batch=2)
    image("V1", 150, "PHO"), image("V3", 0, "CHA")
    indexing.process_stream(spark, str(tmp_path / "k"), Reader, "stream", out, files_a_batch=2)
    got = {(r["video_id"], r["text"], r["frame_start"], r["frame_end"], r["occurrences"]) for r in sinks.read_records(spark, f"{out}/records").collect()}
    assert got == {("V1", "PHO", 0, 150, 3), ("V2", "BUN", 0, 0, 1), ("V3", "CHA", 0, 0, 1)}


def test_timers_close_tracks(spark, tmp_path):
    """Records are those of the batch operator; when the watermark has passed all tracks, no state is left."""
    rows = [(v, f, t) for v in ("A", "B") for f in range(0, 400, 25) for t in ("phở bò", "bún chả")] + [("A", 600, "phở bò"), ("B", 640, "chè"), ("A", 2000, "cơm")]
    whole = detections(spark, rows).withColumn("at", F.timestamp_millis(F.col("timestamp_ms") + 1_700_000_000_000))
    beat = detections(spark, [("~", 100_000, None)]).withColumn("at", F.timestamp_millis(F.col("timestamp_ms") + 1_700_000_000_000))
    for k, part in enumerate((whole.where("frame_idx < 180"), whole.where("frame_idx between 180 and 1000"), whole.where("frame_idx > 1000"), beat, beat.withColumn("at", F.expr("at + interval 1 day")))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        tracks = timed_tracks(stream_of(spark, tmp_path / "in", whole.schema), "at", "1 second", 0.85, 120, 4800)
        q = tracks.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "o")).trigger(availableNow=True).start()
        q.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert told(spark.read.parquet(str(tmp_path / "o"))) == told(R.greedy_tracks(whole.drop("at"), 0.85, 120))
    assert max(held) > 0 and held[-1] == 0
