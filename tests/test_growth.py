"""What a step holds and moves as tables grow."""

import os
import pickle
import random
import re
import tracemalloc
import unicodedata

from pyspark.sql import functions as F

import corpus_pipeline
from inkframe.functions import text as X
from inkframe.llm import jaccard_join as J
from inkframe.llm.license_scan import scan
from inkframe.llm.scratch import Scratch
from inkframe.llm.toxicity import train_toxicity
from inkframe.operators import search as Q, tracks as R
from inkframe.sources import segments as G, sinks
from inkframe.streaming import indexing as S

BOX = (0.1, 0.2, 0.3, 0.8)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def detections(spark, rows):
    whole = [(v, f"{v}_{f}", f, f / 25, f * 40, "", "", k, t, t, c, *BOX, "[]", None) for k, (v, f, t, c) in enumerate(rows)]
    return spark.createDataFrame(whole, R.DETECTION)


def test_a_stream_has_a_partition_a_batch(spark, tmp_path):
    """Of fifty videos in two batches; those of both batches are whole, and the sinks equal those of one run."""
    out, rows = str(tmp_path), [(f"V{v}", f, "phở", 0.5) for v in range(50) for f in (0, 100) if v < 30 or f]
    whole = detections(spark, rows)
    S.index_batch(whole.where("frame_idx = 0"), 0, out, lambda d: d)
    S.index_batch(whole.where("frame_idx = 100"), 1, out, lambda d: d)
    for _ in range(2):
        got = sinks.read_records(spark, f"{out}/records")
        assert sorted(map(str, got.drop("id", "entities").collect())) == sorted(map(str, sinks.flat_records(S.records_of(whole)).collect()))
        assert spark.read.json(f"{out}/frames").count() == 50 and spark.read.text(f"{out}/bulk").count() == 100
        for table in ("detections", "records", "frames", "bulk"):
            assert len([d for d in os.listdir(f"{out}/{table}") if "=" in d]) == 2
        S.index_batch(whole.where("frame_idx = 100"), 1, out, lambda d: d)


def test_occurrences_are_gathered_before_they_move(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("phở bò bún the a 45k".split()) for _ in range(rng.choice([0, 1, 40])))) for i in range(1300)]
    records = spark.createDataFrame([*rows, (9999, None)], "id long, text string").withColumn("text_unsigned", X.to_unsigned(F.col("text")))
    want = Q.postings(records).groupBy("term", "col", "id").agg(F.array_sort(F.collect_list("pos")).alias("positions"), F.count("*").alias("tf"))
    found = G._postings(records)
    assert "Exchange" not in plan(found) and "Aggregate" not in plan(found)
    assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    sizes = {r["id"]: r["d"] for r in found.select("id", "d").distinct().collect()}
    assert sizes == {r["id"]: r["n"] for r in Q.postings(records).groupBy("id").agg(F.count("*").alias("n")).collect()}


def test_postings_of_a_frequent_term_stay_where_they_are(spark):
    """A batch's terms are brought to postings that no index holds; an exchange by term would bring a frequent one's to one task."""
    rows = [(i, "the cat the dog" if i % 3 else "them the", "") for i in range(60)]
    index = Q.postings(spark.createDataFrame(rows, "id long, text string, text_unsigned string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = Q.match_counts(index, ["the", "the dog", "dog the", "zzz"])
        tree = plan(Q._occurrences(spark.createDataFrame([("a", 0, ["the", "do"], 2), ("b", -1, ["the"], 1)], "qid string, tok int, terms array<string>, size int"), index))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert {r["text"]: r["n"] for r in counts.collect()} == {"the": 60, "the dog": 40, "dog the": 0, "zzz": 0}
    assert "SortMergeJoin" not in tree and "ShuffledHashJoin" not in tree


def test_texts_in_normal_form_are_not_sent_to_python(spark):
    settled = [chr(c) for a, b in ((0, 0x300), (0x1EA0, 0x1EFA), (0x2002, 0x20D0)) for c in range(a, b)]
    assert all(unicodedata.normalize("NFC", c) == c and not unicodedata.combining(c) for c in settled)
    pairs = [unicodedata.decomposition(chr(c)).split() for c in range(0x110000) if 0xD800 > c or c > 0xDFFF]
    assert not {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")} & set(settled)
    rng = random.Random(5)
    texts = ["".join(rng.choice("aươ̂́é가Å–ẹ ") for _ in range(rng.randrange(12))) for _ in range(400)] + [None, "", "Phở – é"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    X.register(spark)
    df.createOrReplaceTempView("growth_texts")
    in_sql = spark.sql("SELECT s, vn_normal(s) AS n FROM growth_texts")
    for got in (df.select("s", X.normalize_nfc(F.col("s")).alias("n")), in_sql):
        assert all(r["n"] == unicodedata.normalize("NFC", (r["s"] or "").strip()) for r in got.collect())
        assert "CASE WHEN" in next(line for line in plan(got).split("\n") if "ArrowEvalPython" in line) + plan(got) and "RLIKE" in plan(got)
    assert df.where(F.col("s").rlike(X.UNSETTLED)).where("s = 'Phở – é'").count() == 0


def test_sessions_follow_each_other_in_a_task(spark):
    """No call a session; places without an order, null and NaN as the sequential rule has them."""
    rng = random.Random(2)
    rows = [(f"V{rng.randrange(40)}", rng.randrange(60) * 50, rng.choice(["phở bò", "phở  bò", "bún", None, ""]), rng.choice([0.1, 0.5, None, float("nan")])) for _ in range(1500)]
    whole = detections(spark, rows)
    found = R.greedy_tracks(whole)
    assert "FlatMapGroups" not in plan(found) and "MapInArrow" in plan(found)
    want = []
    for (video, _), part in R._sessions(whole, 120).toPandas().groupby(["video_id", "session"]):
        tracker = R.Tracker(0.85, 120)
        want += [R.record(video, t) for idx, frame in R.frames_of(part) for t in tracker.frame(idx, frame)]
        want += [R.record(video, t) for t in tracker.open]
    assert sorted(str({k: r[k] for k in sorted(r)}) for r in want) == sorted(str({k: r[k] for k in sorted(found.columns)}) for r in found.collect())


def test_training_keeps_the_sample_off_the_driver(spark):
    """Of 400 texts of 1000 words the driver gets the different words, not those of each text, and the model is its weights."""
    text = F.expr("array_join(transform(sequence(1, 1000), j -> translate(cast(pmod(xxhash64(id, j), 8000) as string), '0123456789', 'abcdefghij')), ' ')")
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 8 == 0, F.concat(text, F.lit(" moron"))).otherwise(text).alias("text"))
    labels = rows.select("doc_id", (F.col("doc_id") % 8 == 0).cast("int").alias("toxic"))
    tracemalloc.start()
    model = train_toxicity(labels, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45e6 and len(pickle.dumps(model)) < 1e6
    score = model.scores(["ab cd moron", "ab cd", ""])
    assert score[0] > 0.5 > score[1] and score[1] >= score[2]


def test_licence_units_are_dealt_out_once(spark):
    """Lines and stretches of words move by their keys and not again by word, template or place; a file in two copies, with its notice far behind."""
    mit, prose = "Released under the MIT License.", "some words of prose that grant nothing at all " * 90
    rows = [("a/x.txt", f"{prose} granted {prose} released under\nthe MIT license {prose}")] * 2 + [("a/y.txt", mit), ("b/z.txt", prose)]
    files = spark.createDataFrame(rows, "path string, text string").select(F.struct(F.xxhash64("path", "text"), F.hash("path", "text")).alias("row"), "path", "text", F.lit(False).alias("is_file"))
    templates = [("MIT", mit), ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"), ("GPL-3.0", "GNU General Public License, version 3.")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = scan(files, templates, 0.6, Scratch(spark, "growth"))
        keys = {tuple(re.sub(r"#\d+", "", k).split(", ")[:-1]) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(found))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert keys and keys <= {("row", "at"), ("row", "stretch"), ("row",)}
    own = {r["row"]: (r["licence"], r["score"]) for r in found.collect()}
    assert sorted((r["path"], own.get(r["row"])) for r in files.distinct().collect()) == [("a/x.txt", ("MIT", 1.0)), ("a/y.txt", ("MIT", 1.0)), ("b/z.txt", None)]


def test_regions_are_dealt_out_once(spark, monkeypatch):
    """Rows of all regions meet by one exchange; only those of common shingles are counted, and large ones among them are told to all tasks."""
    for name, least in (("REGION_BLOCK", 3), ("ORDER_PART", 1), ("COMMON", 2)):
        monkeypatch.setattr(J, name, least)
    trees, large, write = {}, [], Scratch.write

    def watched(self, df, table):
        trees[table] = plan(df)
        out = write(self, df, table)
        large.extend(out.collect() if table == "hot" else [])
        return out

    monkeypatch.setattr(Scratch, "write", watched)
    rng = random.Random(7)
    base, other = ([f"{c}{i}" for i in range(60)] for c in "vu")
    rows = [(i, " ".join([*(base if i % 3 else other), *(f"z{i}-{j}" for j in range(rng.randrange(3)))])) for i in range(40)] + [(100 + i, " ".join(f"y{i}-{j}" for j in range(60))) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = J.jaccard_groups(docs, 3, (90, 100), count_links=True).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i if i >= 100 else 0 if i % 3 == 0 else 1 for i, _ in rows}
    assert {r["doc_id"]: r["n_links"] for r in got} == {i: 0 if i >= 100 else 13 if i % 3 == 0 else 25 for i, _ in rows}
    assert len([x for x in trees["met"].split("\n") if "Generate explode" in x and "regions" in x]) == 1
    assert large


def test_near_duplicates_deal_texts_out_once(spark):
    """Texts move by doc_id, and no second time to find what shares it; rows equal in both are one, also where the doc_id is null."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(None, a), (None, a), (None, b), (None, None), (5, c), (5, c), (5, b), (6, None), (6, None), (7, c), (9, f"{b} z")]
    docs = spark.createDataFrame([(t, i, "s") for i, t in rows], "text string, doc_id long, source string")
    found = corpus_pipeline.near_duplicates(spark, docs, "")
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\), ENSURE", plan(found))]
    assert keys.count("doc_id, text") <= 1 and not any("coalesce(doc_id" in k for k in keys)
    assert found.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str) == sorted({r for r in rows if r[0] not in (7, 9)}, key=str)
