"""Registered queries against their SQL on the small tables, where those are present."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"fulltext_bm25", "fulltext_filtered", "batch_search_eval", "submission_rows"}


def plain(df):
    cols = sorted(df.columns)
    return sorted(tuple("-" if v is None or v != v else repr(round(float(v), 8)) if isinstance(v, (int, float)) else str(v) for v in row) for row in df[cols].astype(object).values.tolist())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(k for k in entry.base_queries.ORACLE if k not in SLOW))
def test_query_equals_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = entry.queries()[name](spark, SF).toPandas(), db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_rows_only(spark):
    assert entry.queries()["tracks_greedy"](spark, SF).count() > 0


def test_entities_of_documents_are_counted(spark, tmp_path):
    sf, signs = str(tmp_path / "with"), str(tmp_path / "without")
    spark.createDataFrame([(1, "Phở 45k và trà 5.000đ"), (2, "prose"), (3, None)], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{signs}/documents.parquet")
    found, alone = ({r["type"]: r["n"] for r in entry.queries()["entity_counts"](spark, at).collect()} for at in (sf, signs))
    assert found["PRICE"] == alone["PRICE"] + 2


def test_texts_as_images_are_prepared(spark, tmp_path):
    import hashlib

    import numpy as np

    from inkframe.functions import pixels

    texts = ["Phở 45k " * 40, "x", "", None, "quán " * 500, "a" * 64]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in entry.queries()["image_preparation"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        if not raw:
            assert got[k]["error"] and got[k]["width"] is None
            continue
        image = np.frombuffer(raw + bytes(-len(raw) % 64), np.uint8).reshape(-1, 64)
        want = pixels.prepared(image, most=96, least=24)
        assert (got[k]["pixels_sha256"], got[k]["height"], got[k]["width"], got[k]["channels"]) == (hashlib.sha256(want["image"].tobytes()).hexdigest(), *want["image"].shape, 1)
        assert (got[k]["scale"], got[k]["blur_score"], got[k]["is_blurry"]) == (want["scale"], want["blur_score"], want["is_blurry"])
