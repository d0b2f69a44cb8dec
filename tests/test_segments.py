"""A search over segments against one over a single index and over postings in memory."""

import os
import random

from pyspark.sql import functions as F

from inkframe.functions import text as X
from inkframe.operators import search as Q
from inkframe.sources import segments as G

WORDS = ["phở", "bò", "bún", "chả", "the", "them", "theme", "cơm", "tấm", "a", "ab", "45k", "ñandú"]


def corpus(spark, n=90, seed=1):
    rng = random.Random(seed)
    rows = [(i, f"V{i % 4}", i // 2, " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 5, 30]))), 0.2 + i % 8 / 10) for i in range(n)] + [(n, "V0", 7, None, 0.9)]
    df = spark.createDataFrame(rows, "id long, video_id string, frame_idx long, text string, confidence double")
    return df.withColumn("text_unsigned", X.to_unsigned(F.col("text"))).withColumn("entities", X.entity_values(F.col("text")))


ASKED = [("q0", "phở bò"), ("q1", "the"), ("q2", "com tam 45"), ("q3", "a"), ("q4", "zzz"), ("q5", "  "), ("q6", "\"bun cha\" the th"), ("q7", "---")]


def scores(df):
    return sorted((r["qid"], r["id"], round(r["bm25"], 9)) for r in df.collect())


def test_segments_equal_one_index(spark, tmp_path):
    records = corpus(spark)
    asked = spark.createDataFrame(ASKED, "qid string, query string")
    want = scores(Q.bm25(records, asked))
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    G.add_segment(records, one)
    for k in range(3):
        G.add_segment(records.where(F.col("id") % 3 == k), many)
    assert scores(Q.bm25(records, asked, G.TermIndex(spark, one))) == want
    index = G.TermIndex(spark, many)
    assert len(index.segments) == 3 and scores(Q.bm25(records, asked, index)) == want
    hits = lambda i: sorted(map(str, Q.search(i.records(), asked, top_k=5, index=i).select("qid", "rank", "id", "score").collect()))
    first = hits(index)
    assert first == sorted(map(str, Q.search(records, asked, top_k=5).select("qid", "rank", "id", "score").collect()))
    # a segment that was not finished does not count
    G.add_segment(records.where("id < 3").withColumn("id", F.col("id") + 1000), many)
    broken = max((d for d in os.listdir(many) if d.startswith("seg-") and d not in {s.name for s in index.segments}))
    os.remove(f"{many}/{broken}/stats/_SUCCESS")
    assert len(G.TermIndex(spark, many).segments) == 3
    # merged, the old ones are replaced at once, and can be deleted
    assert index.compact(factor=4) is None
    merged = index.compact(factor=3)
    index = G.TermIndex(spark, many)
    assert [s.name for s in index.segments] == [merged.name] and len(index.replaced) == 3 and hits(index) == first
    index.vacuum()
    assert scores(Q.bm25(records, asked, G.TermIndex(spark, many))) == want
    words = {r["term"]: (r["df_text"], r["df_text_unsigned"]) for r in index.vocabulary().collect()}
    assert words["the"][0] == records.where(F.array_contains(Q.terms(F.col("text")), "the")).count()


def test_postings_are_not_exchanged(spark, tmp_path, monkeypatch):
    """Neither with terms that are broadcast nor with those that are brought to the buckets."""
    records, folder = corpus(spark), str(tmp_path / "i")
    G.add_segment(records, folder)
    asked = spark.createDataFrame(ASKED, "qid string, query string")
    want = scores(Q.bm25(records, asked))
    monkeypatch.setattr(G, "FEW_STEPS", 0)
    for most in (300_000, 20):
        monkeypatch.setattr(G, "MOST_WANTED", most)
        index = G.TermIndex(spark, folder)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if most == 20 else "10m")
        try:
            found = Q.bm25(records, asked, index)
            lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
            assert scores(found) == want
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        for i, line in enumerate(lines):
            if "inkframe_seg" in line:
                above, depth = [], line.index("FileScan")
                for up in reversed(lines[:i]):
                    at = len(up) - len(up.lstrip(" :+-"))
                    if at < depth:
                        above.append(up.strip(" :+-").split(" ")[0].split("(")[0])
                        depth = at
                join = next(k for k, name in enumerate(above) if "Join" in name)
                assert "Exchange" not in above[:join], above


def test_an_empty_index(spark, tmp_path):
    asked = spark.createDataFrame(ASKED, "qid string, query string")
    assert Q.bm25(corpus(spark), asked, G.TermIndex(spark, str(tmp_path / "none"))).count() == 0
    G.add_segment(corpus(spark).limit(0), str(tmp_path / "e"))
    assert Q.bm25(corpus(spark), asked, G.TermIndex(spark, str(tmp_path / "e"))).count() == 0
