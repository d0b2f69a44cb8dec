import random

from pyspark.sql import functions as F

from inkframe.functions import text as X


def col(spark, texts, f):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, s string").select("k", f(F.col("s")).alias("r")).orderBy("k")
    return [r["r"] for r in rows.collect()]


def test_letters():
    assert len(X.PLAIN_LETTER) == 134 and X.PLAIN_LETTER["Ợ"] == "O" and X.PLAIN_LETTER["đ"] == "d"


def test_unsigned(spark):
    texts = ["Cơm Tấm Ba Ghiền", "Phở Bò Tái Nạm 45k", "Đường Nguyễn Trãi Quận 5", "Hội thi AI Challenge TP.HCM 2026", None, " ñandú "]
    assert col(spark, texts, X.to_unsigned) == ["com tam ba ghien", "pho bo tai nam 45k", "duong nguyen trai quan 5", "hoi thi ai challenge tp.hcm 2026", "", "ñandu"]
    once = col(spark, texts, lambda c: X.to_unsigned(X.to_unsigned(c)))
    assert once == col(spark, texts, X.to_unsigned)


def test_clean(spark):
    assert col(spark, ["a\nb\tc  d", "  é  ", None, "x\x7fy"], X.clean_text) == ["abc d", "é", "", "xy"]


def test_entities(spark):
    texts = ["Quán cơm tấm 45k, trà đá 5.000đ, lẩu cá 150 nghìn", "Xe máy biển số 59-X3 123.45 và ô tô 51F-9999", "Liên hệ hotline: 0901234567 hoặc 02838354409", "7h30", ""]
    spans = col(spark, texts, X.extract_entities)
    plain = col(spark, texts, X.entity_values)
    assert [[(e["type"], e["value"]) for e in r] for r in spans] == [[(e["type"], e["value"]) for e in r] for r in plain]
    of = lambda i, k: [e["value"] for e in spans[i] if e["type"] == k]
    assert of(0, "PRICE") == ["45k", "5.000đ", "150 nghìn"] and of(1, "LICENSE_PLATE") == ["59-X3 123.45", "51F-9999"]
    assert of(2, "PHONE_NUMBER") == ["0901234567"] and of(3, "TIME") == ["7h30"] and spans[4] == []
    assert all(texts[i][e["span"]["start"] : e["span"]["end"]].upper() == e["value"].upper() for i, r in enumerate(spans) for e in r)


def test_entities_equal_plain_patterns(spark):
    """Native spans against Python's re, on random texts of what patterns and word edges are made of."""
    rng = random.Random(5)
    parts = ["4", "0912345678", "+84912345678", "51F", "-", " ", ".", ",", ":", "h", "k", "K", "đ", "Đ", "nghìn", "tr", "a", "_", "\u0301", "²", "٣", "𝟡", "é", "(", "59-X3 123.45", "7h30", "21:15:00", "12.5", "\u00a0", "😀"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)] + [None, "", "1 " * 5000, "9k " * 1300 + "x"]
    plain = [[r[1:] for r in X.plain_entities(t)] for t in texts]
    assert [[(e["type"], e["value"], e["span"]["start"], e["span"]["end"]) for e in r] for r in col(spark, texts, X.extract_entities)] == plain
    assert [[(e["type"], e["value"]) for e in r] for r in col(spark, texts, X.entity_values)] == [[e[:2] for e in r] for r in plain]


def test_sql_functions(spark):
    X.register(spark)
    texts = ["Cơm\tTấm  Ba", " ñandú\u00a0", None, "", "Quán 45k"]
    spark.createDataFrame(list(enumerate(texts)), "k int, s string").createOrReplaceTempView("signs_of_test")
    rows = spark.sql("SELECT k, vn_clean(s) AS c, vn_unsigned(s) AS u, vn_marks(s) AS m FROM signs_of_test ORDER BY k").collect()
    assert [r["c"] for r in rows] == col(spark, texts, X.clean_text) and [r["u"] for r in rows] == col(spark, texts, X.to_unsigned)
    assert [r["m"] for r in rows] == col(spark, texts, X.diacritics)
    found = spark.sql("SELECT k, e.* FROM signs_of_test, LATERAL text_entities(s) e ORDER BY k, pos").collect()
    assert [tuple(r) for r in found] == [(4, 0, "PRICE", "45k", 5, 8)]


def test_similarity(spark):
    assert X.similarity("CƠM TẤM BA GHIỀN", "COM TAM BA GHIEN") == 0.8125
    assert X.similarity("", "a") == 0 and X.similarity("  ", " ") == 1 and X.similarity(None, "a") == 0
    r = spark.createDataFrame([("abc", "abd")], "a string, b string").select(X.text_similarity("a", "b").alias("r")).first()["r"]
    assert abs(r - 2 / 3) < 1e-12


def test_fields(spark):
    assert col(spark, ["L01_V001.mp4", " a.MP4 ", None], X.clean_video_id) == ["L01_V001", "a", ""]
    assert col(spark, ["25 300", "x", None, "7"], X.clean_frame_idx) == [25300, 0, 0, 7]
    assert col(spark, ["A" * 150, " b "], X.clean_answer) == ["A" * 100, "b"]


def test_query_tokens(spark):
    assert col(spark, ["tim quan pho o dau", "la gi", ""], X.query_tokens) == [["quan", "pho"], ["la", "gi"], []]
