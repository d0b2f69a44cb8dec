"""Frame metadata, spatial columns, tracks in batch and stream, and the model interface."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from inkframe.functions import spatial as G
from inkframe.operators import frames as P, tracks as R
from inkframe.plans import vision
from inkframe.sources import readers


def test_frame_info(spark, tmp_path):
    (tmp_path / "fps.json").write_text(json.dumps({"L21_V001": 30.0, "L21_V002": 25.0, "bad": "x"}))
    (tmp_path / "index.json").write_text(json.dumps({"0": "L21_V001/keyframe_0.webp", "1": "L21_V001\\keyframe_75.webp", "2": "L21_V002/keyframe_100.webp"}))
    (tmp_path / "url.json").write_text(json.dumps([{"video_id": "L21_V001", "watch_url": "https://y/watch?v=T1"}, {"video_id": "x"}]))
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta/L9.json").write_text(json.dumps({"fps": "50", "frames": {"keyframe_7": {"frame_idx": 70, "timestamp_ms": 4000000}}}))
    (tmp_path / "meta/broken.json").write_text("{")
    at = lambda n: str(tmp_path / n)
    frames = spark.createDataFrame([("L21_V001", "keyframe_75.webp"), ("L21_V001", "keyframe_0.webp"), ("L21_V002", "keyframe_201.webp"), ("L9", "keyframe_7.jpg"), ("L8", "cover.jpg")], "video_id string, image_name string")
    info = P.frame_info(frames, readers.fps_map(spark, at("fps.json")), readers.index_map(spark, at("index.json")), readers.url_map(spark, at("url.json")), readers.video_metadata(spark, at("meta")))
    got = {(r["video_id"], r["frame_idx"]): r for r in info.collect()}
    r = got["L21_V001", 75]
    assert (r["frame_id"], r["timestamp"], r["timestamp_ms"], r["timestamp_str"], r["youtube_url"]) == ("1", 2.5, 2500, "00:02.500", "https://y/watch?v=T1&t=2s")
    assert got["L21_V001", 0]["frame_id"] == "0" and got["L21_V002", 201]["timestamp_ms"] == 8039
    assert got["L9", 70]["timestamp_str"] == "66:40.000" and got["L9", 70]["fps"] == 50 and got["L8", 0]["fps"] == 25
    assert readers.fps_map(spark, at("fps.json")).count() == 2 and readers.url_map(spark, at("url.json")).count() == 1


def test_spatial(spark):
    a, b = G.box(F.lit(0.1), F.lit(0.2), F.lit(0.3), F.lit(0.8)), G.box(F.lit(0.1), F.lit(0.2), F.lit(0.3), F.lit(0.8))
    poly = F.expr("array(array(9, 1), array(1, 1), array(1, 9), array(9, 9))")
    r = spark.range(1).select(G.iou(a, b).alias("same"), G.center_distance(a, b).alias("d"), G.polygon_area(poly).alias("area"), G.corners(poly).alias("c"), G.detection_size(F.lit(2000), F.lit(1000), 1000, 2000).alias("s")).first()
    assert r["same"] == pytest.approx(1) and r["d"] == 0 and r["area"] == 64 and r["c"] == [[1, 1], [9, 1], [9, 9], [1, 9]] and r["s"]["scale"] == 0.5


def detections(spark, rows):
    full = [(v, str(f), f, f / 25, f * 40, "", "", i, t, u, c, *box, "[]", e) for i, (v, f, t, u, c, box, e) in enumerate(rows)]
    return spark.createDataFrame(full, R.DETECTION)


BOX, FAR = (0.1, 0.2, 0.3, 0.8), (0.8, 0.8, 0.9, 0.9)


def test_greedy_tracks(spark):
    com, ghien = "CƠM TẤM BA GHIỀN", "com tam ba ghien"
    rows = [("A", 100, com, ghien, 0.88, BOX, ["x"]), ("A", 105, com, ghien, 0.96, (0.11, 0.21, 0.31, 0.81), ["y", "x"]), ("A", 110, "COM TAM BA GHIEN", ghien, 0.85, (0.12, 0.22, 0.32, 0.82), [])]
    rows += [("B", 0, "q", "q", 0.9, BOX, []), ("B", 10, "q", "q", 0.9, BOX, []), ("B", 21, "q", "q", 0.9, BOX, []), ("B", 21, "q", "q", 0.9, FAR, [])]
    rows += [("C", 5, "z", "z", 0.5, BOX, []), ("C", 5, "z", "z", 0.6, BOX, []), ("C", 5, "z", "z", 0.7, BOX, [])]
    got = R.greedy_tracks(detections(spark, rows), threshold=0.80, max_gap=10).orderBy("video_id", "frame_start").collect()
    a = got[0]
    assert (a["frame_id"], a["confidence"], a["frame_start"], a["frame_end"], a["occurrences"], a["entities"]) == ("105", 0.96, 100, 110, 3, ["x", "y"])
    assert sorted((r["frame_start"], r["frame_end"], r["occurrences"]) for r in got if r["video_id"] == "B") == [(0, 10, 2), (21, 21, 1), (21, 21, 1)]
    assert sorted((r["occurrences"], r["confidence"]) for r in got if r["video_id"] == "C") == [(1, 0.7), (2, 0.6)]
    assert sum(r["occurrences"] for r in got) == len(rows)
    assert R.untracked(detections(spark, rows)).count() == len(rows)


def test_stream_equals_batch(spark, tmp_path):
    from inkframe.streaming.tracks import greedy_track_stream

    rows = [("A", f, t, t, 0.5, BOX, ["e"]) for f in range(0, 60, 5) for t in ("phở bò", "bún chả")] + [("A", 200, "phở bò", "phở bò", 0.9, BOX, [])]
    whole = detections(spark, rows)
    want = sorted((r["text"], r["frame_start"], r["frame_end"], r["occurrences"]) for r in R.greedy_tracks(whole, 0.85, 20).collect())
    for k, part in enumerate((whole.where("frame_idx < 30"), whole.where("frame_idx between 30 and 100"), whole.where("frame_idx > 100"), detections(spark, [("A", 999, None, None, 0.0, BOX, [])]))):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    q = greedy_track_stream(stream, 0.85, 20).writeStream.format("memory").queryName("tracks").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["text"], r["frame_start"], r["frame_end"], r["occurrences"]) for r in spark.table("tracks").collect()) == want


class Reader:
    def read(self, image):
        p = [[10, 10], [110, 10], [110, 30], [10, 30]]
        return {"width": 640, "height": 480, "scale": 0.5, "lines": [{"polygon": p, "printed": "59-X3", "printed_conf": 0.9, "marked": "", "marked_conf": 0.0}, {"polygon": p[:3], "printed": "no", "printed_conf": 0.9}, {"polygon": p, "printed": "low", "printed_conf": 0.1}]}


def test_indexing_and_sinks(spark, tmp_path):
    from inkframe.plans.indexing import export, index_images

    import sys

    from pyspark import cloudpickle as cp

    cp.register_pickle_by_value(sys.modules[__name__])
    for i in (1, 2, 3):
        (tmp_path / "v/VID").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"v/VID/{i:04d}.jpg").write_bytes(b"x")
    images = readers.keyframes(spark, str(tmp_path / "v"))
    empty = lambda s: spark.createDataFrame([], s)
    records = index_images(images, Reader, "test", empty("video_id string, fps double"), empty("frame_id string, rel_path string"), empty("video_id string, watch_url string"))
    table = export(spark, records, str(tmp_path / "out")).collect()
    assert len(table) == 1 and table[0]["occurrences"] == 3 and table[0]["text"] == "59-X3" and json.loads(table[0]["polygon_json"])[0] == [20, 20]
    assert spark.read.json(str(tmp_path / "out/frames")).first()["ocr_text"] == "59-X3" and spark.read.text(str(tmp_path / "out/bulk")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out/index/postings")).count() == 4
    assert index_images(images, Reader, "test", empty("video_id string, fps double"), empty("frame_id string, rel_path string"), empty("video_id string, watch_url string"), done=spark.createDataFrame([("VID",)], "video_id string")).count() == 0


def test_blur(spark):
    flat, edge = bytes(16), bytes([0, 0, 255, 255] * 4)
    rows = spark.createDataFrame([(flat, 4, 4), (edge, 4, 4), (None, 0, 0)], "p binary, w int, h int").select(vision.blur_score("p", "w", "h").alias("b")).collect()
    assert rows[0]["b"] == 0 and rows[1]["b"] > 40 and rows[2]["b"] == 0


def test_similar_is_the_ratio():
    import random

    from inkframe.functions.text import similar, similarity

    rng = random.Random(3)
    texts = [None, "", " ", "Phở", " phở "] + ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    for a in texts:
        for b in texts:
            for t in (0.0, 0.5, 0.8, 1.0):
                assert similar(a, b, t) == (similarity(a, b) >= t), (a, b, t)


def test_common_letters_and_long_texts():
    """The longest common subsequence against the table of all prefixes; texts beyond 200 letters, where the ratio skips frequent ones."""
    import random

    from inkframe.functions.text import common_letters, similar, similarity

    rng = random.Random(5)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcữ") for _ in range(rng.randrange(0, 90))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            before, row = row, [0]
            for j, y in enumerate(b):
                row.append(before[j] + 1 if x == y else max(row[j], before[j + 1]))
        assert common_letters(a, b) == row[-1], (a, b)
    for _ in range(60):
        a = [rng.choice("abcdefghijklmnopqrstuvwxyzéữ ") for _ in range(rng.randrange(190, 400))]
        b = [x for x in a if rng.random() > 0.05]
        for _ in range(rng.randrange(0, 60)):
            b[rng.randrange(len(b))] = rng.choice("xyzé")
        a, b = "".join(a), "".join(b)
        assert all(similar(a, b, t) == (similarity(a, b) >= t) for t in (0.5, 0.7, 0.85, 0.95))


def test_few_sequences_are_matched(spark, monkeypatch):
    """Of the comparisons that the plain rule makes on all conversations, one in a thousand at most reaches the matcher; tracks stay those of the rule."""
    import difflib
    import os

    from inkframe import queries
    from inkframe.functions import text as X

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    asked, matched = [], []
    similar = R.similar
    monkeypatch.setattr(R, "similar", lambda a, b, t: asked.append(1) or similar(a, b, t))
    monkeypatch.setattr(X, "SequenceMatcher", lambda *a: matched.append(1) or difflib.SequenceMatcher(*a))
    videos = {}
    for r in queries._detections(lambda name: spark.read.parquet(f"{sf}/{name}.parquet")).collect():
        videos.setdefault(r["video_id"], {}).setdefault(r["frame_idx"], []).append(r.asDict())
    got, done = {}, {}
    for v, frames in videos.items():
        tracker = R.Tracker(0.85, 120)
        got[v] = [t for f in sorted(frames) for t in tracker.frame(f, sorted(frames[f], key=lambda d: d["ord"]))] + tracker.open
        done[v] = sorted((t["start"], t["end"], t["count"], round(t["best"]["confidence"], 4)) for t in got[v])
    assert asked and len(matched) * 1000 <= len(asked), (len(asked), len(matched))
    monkeypatch.undo()
    some = list(videos)[:20]  # the plain rule is slow
    assert {v: done[v] for v in some} == {v: naive_tracks([d for f in videos[v].values() for d in f], 0.85, 120) for v in some}


def naive_tracks(rows, threshold, max_gap):
    """The sequential rule over a whole video, without sessions: (start, end, count, best confidence) of each track."""
    from inkframe.functions.text import similarity

    tracks, done = [], []
    for frame in sorted({r["frame_idx"] for r in rows}):
        done += [t for t in tracks if frame - t["end"] > max_gap]
        tracks = [t for t in tracks if frame - t["end"] <= max_gap]
        joined = []
        for d in sorted((r for r in rows if r["frame_idx"] == frame), key=lambda r: r["ord"]):
            fit = [t for t in tracks if not any(t is j for j in joined) and R.near_boxes(t["last"], d) and max(similarity(t["last"]["text_unsigned"], d["text_unsigned"]), similarity(t["last"]["text"], d["text"])) >= threshold]
            if fit:
                joined.append(fit[0])
                fit[0].update(last=d, end=frame, n=fit[0]["n"] + 1, best=max(fit[0]["best"], d["confidence"]))
            else:
                tracks.append({"last": d, "start": frame, "end": frame, "n": 1, "best": d["confidence"]})
    return sorted((t["start"], t["end"], t["n"], round(t["best"], 4)) for t in done + tracks)


def test_greedy_tracks_of_a_table(spark):
    """All conversations as videos, row by row against the rule as it reads."""
    import os

    from inkframe import queries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    rows = queries._detections(lambda name: spark.read.parquet(f"{sf}/{name}.parquet"))
    videos = {}
    for r in rows.collect():
        videos.setdefault(r["video_id"], []).append(r.asDict())
    got = {}
    for r in R.greedy_tracks(rows, 0.5, 120).collect():
        got.setdefault(r["video_id"], []).append((r["frame_start"], r["frame_end"], r["occurrences"], r["confidence"]))
    assert {v: sorted(t) for v, t in got.items()} == {v: naive_tracks(d, 0.5, 120) for v, d in videos.items()}
