"""Pixel operations, the catalogue, and runs from images to sinks that can be broken off and gone on with."""

import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from inkframe.functions import pixels as X
from inkframe.operators import frames as P
from inkframe.plans import indexing, vision
from inkframe.sources import sinks
from inkframe.streaming.tracks import session_tracks


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import it


def test_colours_and_contrast():
    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, (40, 50, 3)).astype(np.uint8)
    assert np.abs(X.from_lab(X.to_lab(image)).astype(int) - image).mean() < 2.5  # bytes of L, a, b round
    assert X.to_lab(np.array([[[255, 255, 255], [0, 0, 0], [255, 0, 0]]], np.uint8)).tolist() == [[[255, 128, 128], [0, 128, 128], [136, 208, 195]]]
    flat = np.full((64, 64), 100, np.uint8)
    dim = (100 + rng.integers(0, 20, (64, 64))).astype(np.uint8)
    assert np.ptp(X.equalized(flat)) == 0 and X.equalized(dim, clip=40.0).std() > 2 * dim.std()
    assert X.equalized(dim, clip=1.0).std() < X.equalized(dim, clip=40.0).std()
    assert X.equalized(dim[:13, :17]).shape == (13, 17) and X.contrasted(image).shape == image.shape


def test_sharpness():
    assert X.laplacian_variance(np.zeros((0, 0, 3), np.uint8)) == 0 and X.laplacian_variance(np.full((9, 9, 3), 7, np.uint8)) == 0
    edge = np.tile(np.array([0, 0, 255, 255], np.uint8), (4, 1))
    assert X.laplacian_variance(edge) > 40


def test_sizes():
    image = np.arange(8 * 12, dtype=np.uint8).reshape(8, 12)
    assert X.resized(image, 6, 4).tolist() == np.round(image.reshape(4, 2, 6, 2).mean((1, 3))).astype(int).tolist()
    assert X.resized(image, 24, 16).shape == (16, 24) and X.resized(image, 12, 8).tolist() == image.tolist()
    assert X.sized_for_detection(np.zeros((700, 1000, 3), np.uint8))[1] == 1.0
    small, scale = X.sized_for_detection(np.zeros((200, 400, 3), np.uint8), 800, 640)
    assert small.shape == (400, 800, 3) and scale == 2.0
    done = X.prepared(np.zeros((100, 200, 3), np.uint8), 400, 50)
    assert done["is_blurry"] and done["scale"] == 1.0 and done["blur_score"] == 0


def test_rectified():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (40, 60, 3)).astype(np.uint8)
    box = np.array([[30, 25], [10, 5], [30, 5], [10, 25]])
    assert X.ordered_corners(box).tolist() == [[10, 5], [30, 5], [30, 25], [10, 25]]
    got = X.rectified(image, box)
    assert got.shape == (20, 20, 3) and np.abs(got[0, 0].astype(int) - image[5, 10]).max() <= 1 and np.abs(got[-1, -1].astype(int) - image[25, 30]).max() <= 1
    assert X.rectified(image[..., 0], np.array([[1, 1], [3, 1], [3, 2], [1, 2]])).shape == (8, 8)


def test_catalogue(spark):
    rows = spark.createDataFrame([("0", "V1/a.webp"), ("1", "V2\\\\b.webp"), ("2", "c.webp")], "frame_id string, rel_path string")
    assert [r["video_id"] for r in P.catalogue(rows).orderBy("frame_id").collect()] == ["V1", "V2", "unknown"]
    frames = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "video_id string, k int")
    assert sorted(r["k"] for r in P.first_videos(frames, 2).collect()) == [1, 2]


class Reader:
    """Bytes `width,height:text` stand for an image with that text; `bad` is none."""

    def read(self, image: bytes) -> dict:
        if image == b"bad":
            raise ValueError("no image")
        size, _, text = image.decode().partition(":")
        w, h = map(int, size.split(","))
        return {"width": w, "height": h, "lines": [{"polygon": [[0, 0], [50, 0], [50, 20], [0, 20]], "printed": text, "printed_conf": 0.9}] if text else []}


class BatchReader(Reader):
    def read_batch(self, images: list[bytes]) -> list[dict]:
        return [self.read(i) for i in images]


def keyframes(at, videos):
    for v, frames in videos.items():
        (at / v).mkdir(parents=True, exist_ok=True)
        for name, content in frames.items():
            (at / v / name).write_bytes(content)
    return str(at)


SIGN = b"100,100:PHO THIN 60k"


def test_images_without_text_and_errors(spark, tmp_path):
    root = keyframes(tmp_path / "k", {"V1": {"keyframe_0.jpg": SIGN, "keyframe_75.jpg": b"", "keyframe_150.jpg": b"bad", "keyframe_225.jpg": b"9,9:"}})
    from inkframe.sources import readers

    images = readers.keyframes(spark, root).unionByName(readers.empty_images(spark, root)).unionByName(spark.createDataFrame([("gone", "V1", "x.jpg", None)], "path string, video_id string, image_name string, content binary"))
    for make in (Reader, BatchReader):
        lines = vision.read_images(images, make, make.__name__, batch_size=2).cache()
        assert sorted((r["path"].rsplit("/")[-1], r["error"]) for r in vision.frame_errors(lines).collect()) == [("gone", vision.EMPTY), ("keyframe_150.jpg", "no image"), ("keyframe_75.jpg", vision.EMPTY)]
        assert [r["text"] for r in vision.detections(lines).collect()] == ["PHO THIN 60k"]
    one = indexing.process_single_frame(spark, f"{root}/V1/keyframe_0.jpg", Reader, "one", "V1")
    assert one["frame_id"] == "V1_0" and one["timestamp"] == 0.0 and one["detections"][0]["text"] == "PHO THIN 60k"
    assert "error" in indexing.process_single_frame(spark, f"{root}/V1/keyframe_75.jpg", Reader, "one") and "error" in indexing.process_single_frame(spark, f"{root}/V1/none.jpg", Reader, "one")


def test_positional_pairs(spark):
    r = spark.sql("select array(named_struct('p', 1), named_struct('p', 2)) a, array(named_struct('t', 'x')) b").select(vision.paired(F.col("a"), F.col("b")).alias("z")).first()["z"]
    assert [(p["found"]["p"], p["result"]["t"] if p["result"] else None) for p in r] == [(1, "x"), (2, None)]


def test_runs_go_on(spark, tmp_path):
    root = keyframes(tmp_path / "k", {"V1": {"keyframe_0.jpg": SIGN, "keyframe_75.jpg": SIGN}, "V2": {"keyframe_0.jpg": b"9,9:"}})
    out = str(tmp_path / "out")
    first = indexing.process_dataset(spark, root, Reader, "runs", out, max_gap=120)
    assert (first["total_videos"], first["processed_videos"], first["total_frames"], first["total_ocr_records"]) == (2, 2, 3, 1)
    keyframes(tmp_path / "k", {"V3": {"keyframe_0.jpg": SIGN}})
    second = indexing.process_dataset(spark, root, Reader, "runs", out, max_gap=120)
    assert (second["total_videos"], second["processed_videos"], second["total_frames"], second["total_ocr_records"]) == (3, 3, 1, 2)
    assert json.loads((tmp_path / "out/ocr.json").read_text())["V1_0"]["ocr_text"] == "PHO THIN 60k"
    third = indexing.process_dataset(spark, root, Reader, "runs", out, max_gap=120)
    assert third["total_frames"] == 0 and third["total_ocr_records"] == 2
    # records without an entry in the list, as of a run that broke off, are not kept twice
    done = spark.read.parquet(f"{out}/checkpoint/done").where("video_id <> 'V3'").collect()
    spark.createDataFrame(done, "video_id string").write.mode("overwrite").parquet(f"{out}/checkpoint/done")
    fourth = indexing.process_dataset(spark, root, Reader, "runs", out, max_gap=120)
    assert fourth["total_frames"] == 1 and fourth["total_ocr_records"] == 2
    few = indexing.process_dataset(spark, root, Reader, "runs", str(tmp_path / "few"), checkpoint=False, videos=1)
    assert few["total_videos"] == 1 and few["total_frames"] == 2


def test_from_a_catalogue(spark, tmp_path):
    root = keyframes(tmp_path / "k", {"V1": {"keyframe_0.jpg": SIGN, "keyframe_75.jpg": b"100,100:else"}})
    (tmp_path / "index.json").write_text(json.dumps({"10": "V1/keyframe_0.jpg", "11": "V1/keyframe_75.jpg", "12": "V9/keyframe_0.jpg"}))
    (tmp_path / "fps.json").write_text(json.dumps({"V1": 30}))
    got = indexing.process_from_index_json(spark, str(tmp_path / "index.json"), root, Reader, "cat", str(tmp_path / "out"), fps_file=str(tmp_path / "fps.json"), max_gap=10)
    assert got["total_videos"] == 2 and got["total_frames"] == 3 and got["total_ocr_records"] == 2
    assert {(r["frame_id"], r["timestamp"]) for r in spark.read.parquet(got["records_path"]).collect()} == {("10", 0.0), ("11", 2.5)}
    assert sinks.exists(spark, got["index_path"]) and not sinks.exists(spark, str(tmp_path / "nothing"))


def test_blurry_flag(spark):
    assert [r["b"] for r in spark.createDataFrame([(39.9,), (40.0,)], "s double").select(vision.is_blurry(F.col("s")).alias("b")).collect()] == [True, False]


def test_late_events_are_dropped(spark, tmp_path):
    """Beyond the watermark an event joins no session."""
    at = lambda s: f"2024-01-01 {s}"
    for k, rows in enumerate([[("a", at("00:00:00"))], [("a", at("05:00:00"))], [("a", at("06:00:00"))], [("a", at("00:00:30"))], [("a", at("09:00:00"))]]):
        spark.createDataFrame(rows, "k string, s string").select("k", F.col("s").cast("timestamp").alias("at"), F.lit(1.0).alias("value")).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema("k string, at timestamp, value double").option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in/*"))
    q = session_tracks(stream, ["k"], "at", "1 minute", "10 minutes").writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    found = spark.table("late").collect()
    assert sorted(r["occurrences"] for r in found) == [1] * len(found) and len(found) >= 2


def test_prepared_images_equal_plain_loop(spark):
    rng = np.random.default_rng(3)
    images = {f"g{i}": rng.integers(0, 256, (20 + 7 * i, 33)).astype(np.uint8) for i in range(4)} | {"c": rng.integers(0, 256, (70, 21, 3)).astype(np.uint8)}
    encode = lambda x: f"P{5 if x.ndim == 2 else 6} {x.shape[1]} {x.shape[0]} 255\n".encode() + x.tobytes()
    rows = [(k, bytearray(encode(v))) for k, v in images.items()] + [("none", None), ("empty", bytearray()), ("short", bytearray(b"P5 4 4 255\nabc")), ("text", bytearray(b"abc"))]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {r["path"]: r for r in vision.prepare_images(df, most=48, least=24).collect()}
    for k, v in images.items():
        want = X.prepared(v, most=48, least=24)
        assert (bytes(got[k]["pixels"]), got[k]["height"], got[k]["width"]) == (want["image"].tobytes(), *want["image"].shape[:2])
        assert (got[k]["scale"], got[k]["blur_score"], got[k]["is_blurry"], got[k]["error"]) == (want["scale"], want["blur_score"], want["is_blurry"], None)
    assert all(got[k]["error"] and got[k]["pixels"] is None for k in ("none", "empty", "short", "text"))

    at = [[[3, 2], [14, 2], [14, 12], [3, 12]], [[0, 0], [10, 3], [9, 14], [1, 11]]]
    crops = vision.crop_lines(df.where("path <> 'text'").withColumn("polygons", F.when(F.col("path") == "g0", F.array().cast("array<array<array<int>>>")).otherwise(F.lit(at)))).collect()
    found = {(r["path"], r["ord"]): r for r in crops}
    assert len(crops) == 2 * 4 + 3 and found["short", None]["error"]
    for k in ("g1", "g2", "g3", "c"):
        for i, polygon in enumerate(at):
            want = X.rectified(images[k], np.array(polygon))
            assert (bytes(found[k, i]["pixels"]), found[k, i]["height"], found[k, i]["width"]) == (want.tobytes(), *want.shape[:2])


def test_first_model_that_works(spark, tmp_path):
    tried = str(tmp_path / "tried")

    def broken():
        with open(tried, "a") as f:
            f.write("x")
        raise RuntimeError("no device")

    class Fixed:
        def read(self, image):
            return {"width": 1, "height": 1, "lines": [{"polygon": [[0, 0]], "printed": image.decode(), "printed_conf": 1.0}]}

    images = spark.createDataFrame([(str(i), bytearray(b"a")) for i in range(40)], "path string, content binary").coalesce(1)
    lines = vision.read_images(images, vision.first_that_works(broken, Fixed), "fallback", batch_size=4)
    assert lines.count() == 40 and len(open(tried).read()) == 1
    with pytest.raises(Exception, match="no device"):
        vision.read_images(images, vision.first_that_works(broken, broken), "no fallback").count()


def test_profile_reaches_the_stage(spark):
    images = spark.createDataFrame([("a", bytearray(b"a"))], "path string, content binary")
    profile = vision.device_profile("gpu", 0.5, 2)
    plan = vision.read_images(images, lambda: None, "profile", profile=profile)._jdf.queryExecution().logical()
    assert plan.profile().isDefined() and profile.taskResources["gpu"].amount == 0.5 and profile.executorResources["gpu"].amount == 2
