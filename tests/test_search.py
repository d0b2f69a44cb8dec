"""Search against the full-text index of sqlite3, and evaluation."""

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from inkframe.functions import text as X
from inkframe.operators import evaluate as E, search as Q

TEXTS = ["Cơm Tấm Ba Ghiền 45k", "Xe Honda biển số 59-X3 123.45", "Cửa hàng tiện lợi Circle K", "Đường đỏ hoà bình", "cà phê"]


def corpus(spark, texts):
    rows = [(i + 1, f"V{i % 3}", i, t, 0.5 + i / 100) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, video_id string, frame_idx long, text string, confidence double")
    return df.withColumn("text_unsigned", X.to_unsigned(F.col("text"))).withColumn("entities", X.entity_values(F.col("text"))).cache()


def matches(records, queries):
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE f USING fts5(text, text_unsigned)")
    db.executemany("INSERT INTO f(rowid, text, text_unsigned) VALUES (?, ?, ?)", [(r["id"], r["text"], r["text_unsigned"]) for r in records.collect()])
    out = {}
    for qid, u, tokens in queries:
        q = [t.replace('"', "") for t in tokens]
        x = f'("{u}") OR ({" AND ".join(f"{chr(34)}{t}{chr(34)}*" for t in q)}) OR ({" OR ".join(f"{chr(34)}{t}{chr(34)}*" for t in q)})'
        for i, s in db.execute(f"SELECT rowid, bm25(f) FROM f WHERE f MATCH ?", (f"text_unsigned: ({x}) OR text: ({x})",)):
            out[qid, i] = s
    return out


def compare(spark, texts, asked):
    records = corpus(spark, texts)
    queries = spark.createDataFrame([(f"q{i}", q) for i, q in enumerate(asked)], "qid string, query string")
    got = {(r["qid"], r["id"]): r["bm25"] for r in Q.bm25(records, queries).collect()}
    forms = queries.select("qid", X.to_unsigned(X.clean_text(F.col("query"))).alias("u")).select("qid", "u", X.query_tokens(F.col("u")).alias("t")).collect()
    want = matches(records, [tuple(r) for r in forms])
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    return got


def test_known_scores(spark):
    got = compare(spark, TEXTS, ["ba ghien", "59-x3", "bien so", "45k", "loi", "c"])
    assert got["q0", 1] == pytest.approx(-6.591674, abs=1e-6) and got["q1", 2] == pytest.approx(-5.292585, abs=1e-6)
    assert got["q4", 3] == pytest.approx(-3.046572, abs=1e-6) and set(i for q, i in got if q == "q5") == {1, 3, 5}


def test_random_corpora(spark):
    rng = random.Random(1)
    words = ["cơm", "tấm", "phở", "bò", "a-b", "ñu", "số", "la", "x1", "đá", "com", "ph"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    compare(spark, texts, [" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(12)])


def test_ranked_search(spark):
    records = corpus(spark, TEXTS)
    ask = lambda q, **k: Q.payloads(Q.search(records, spark.createDataFrame([("q", q)], "qid string, query string"), **k)).orderBy("rank").collect()
    hit = ask("ba ghien")[0]
    assert hit["id"] == 1 and hit["submission_kis"] == "V0, 0" and hit["submission_qa"] == "V0, 0, 45k"
    assert ask("biển số")[0]["id"] == 2 and len(ask("45k", entity_type="price")) == 1 and ask("45k", entity_type="TIME") == []
    assert ask("ghien", video_id="V1") == [] and ask("ghien", min_confidence=0.9) == [] and ask("  ") == []
    assert hit["score"] == pytest.approx(0.7 / (1 + 6.591674) + 0.15 + 0.5, abs=1e-4)


def test_evaluation(spark):
    hits = spark.createDataFrame([("a", 1, "V", 9), ("a", 4, "V", 150), ("b", 1, "W", 5)], "qid string, rank int, video_id string, frame_idx long")
    truth = spark.createDataFrame([("a", "KIS", "V", 140, 160, ""), ("b", "KIS", "V", 0, 9, ""), ("c", "KIS", "V", 0, 9, "")], "qid string, type string, video string, start long, end long, answer string")
    got = {r["qid"]: r for r in E.evaluate(hits, truth).collect()}
    assert [got["a"][f"r_at_{k}"] for k in E.CUTS] == [0, 1, 1, 1, 1] and got["a"]["final_score"] == 0.8 and got["a"]["best_rank"] == 4
    assert got["b"]["final_score"] == got["c"]["final_score"] == 0 and got["c"]["best_rank"] is None
    assert E.benchmark_means(E.evaluate(hits, truth)).first()["final_score"] == pytest.approx(0.8 / 3)


def test_terms_of_every_letter(spark):
    """Between plain letters, as the index engine splits them from U+0080 to U+2FFF: letters, digits and the marks that vanish."""
    import unicodedata

    db = sqlite3.connect(":memory:")
    db.execute("create virtual table t using fts5(x)")
    db.execute("create virtual table v using fts5vocab(t, 'instance')")
    old = unicodedata.ucd_3_2_0
    codes = [c for c in range(0x80, 0x3000) if unicodedata.category(chr(c))[0] in "LNZPC" and old.category(chr(c)) != "Cn" or chr(c) in Q.FOLDED]
    db.executemany("insert into t(rowid, x) values (?, ?)", [(c, f"a{chr(c)}b") for c in codes])
    want = {}
    for term, doc in db.execute("select term, doc from v order by doc, offset"):
        want.setdefault(doc, []).append(term)
    rows = spark.createDataFrame([(c, f"a{chr(c)}b") for c in codes], "c int, s string")
    got = {r["c"]: r["t"] for r in rows.select("c", Q.terms(F.col("s")).alias("t")).collect()}
    wrong = [hex(c) for c in codes if got[c] != want[c] and not 0x13A0 <= c < 0x1400]
    assert len(wrong) <= 12, wrong


def test_substrings(spark):
    rows = [(1, "V1", 0, "Cơm Tấm", "com tam", 0.9, [("PRICE", "45k")]), (2, "V2", 75, "COM rang", "com rang", 0.2, []), (3, "V2", 75, "xôi", "xoi 100%", 0.8, [("TIME", "7h30")]), (4, "V2", 75, "xôi com", "xoi com", 0.7, []), (5, "V3", 0, None, None, 0.9, None)]
    records = spark.createDataFrame(rows, "id long, video_id string, frame_idx long, text string, text_unsigned string, confidence double, entities array<struct<type: string, value: string>>")

    def found(query, **more):
        asked = spark.createDataFrame([("q", query)], "qid string, query string")
        return [(r["id"], r["score"]) for r in Q.search(records, asked, substrings=True, **more).orderBy("rank").collect()]

    assert found("cơm") == [(1, 1.12), (4, 1.06)] and found("COM") == [(1, 1.12), (4, 1.06)]
    assert found("com", min_confidence=0.1, video_id="V2") == [(4, 1.06)]  # of one frame the surer record
    assert found("xôi") == [(3, 1.09)] and found("0%", entity_type="time") == [(3, 1.09)] and found("xôi", entity_type="PRICE") == []
    assert found("c_m") == [(1, 0.62), (4, 0.56)] and found(" \t") == [] and found("\\") == []
    assert Q.like_search(records, spark.createDataFrame([], "qid string, query string")).count() == 0


def test_marked_entities_answer(spark):
    hits = spark.createDataFrame([("a", 1, "V", 5, "xe", [("PRICE", "150 nghìn")]), ("b", 1, "V", 5, "xe", [("X", "150"), ("X", "nghin")]), ("c", 1, "V", 5, "đà lạt", None)], "qid string, rank int, video_id string, frame_idx long, text_unsigned string, entities array<struct<type: string, value: string>>")
    truth = spark.createDataFrame([(q, "QA", "V", 0, 9, "150 nghìn") for q in "ab"] + [("c", "QA", "V", 0, 9, ""), ("d", "QA", "V", 0, 9, "x")], "qid string, type string, video string, start long, end long, answer string")
    assert {r["qid"]: r["r_at_1"] for r in E.evaluate(hits, truth).collect()} == {"a": 1.0, "b": 0.0, "c": 1.0, "d": 0.0}
    with pytest.raises(Exception, match="need text_unsigned"):
        E.evaluate(hits.drop("entities"), truth).collect()
