"""Order of hits whose scores are tiny, or equal but for the order of a sum, and rounding at halves, in queries and in their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from inkframe import queries as base
from inkframe.operators import search as Q


def test_scores_are_told_apart_by_ten_digits(spark):
    rows = [("a", 1, -4.0000001e-6, 0.3), ("a", 2, -4.0000002e-6, 0.1), ("b", 3, -0.1 - 0.2, 0.3), ("b", 4, -0.3, 0.9)]
    got = Q._best(spark.createDataFrame(rows, "qid string, id long, bm25 double, confidence double"), 5).orderBy("qid", "_c").collect()
    assert [r["id"] for r in got] == [2, 1, 4, 3]


@pytest.mark.parametrize("name", ["fulltext_search", "submission_rows"])
def test_tiny_scores_equal_sql(spark, tmp_path, name):
    """A term that most records hold scores a millionth, and lengths tell its records apart."""
    rows = [(i, "nation " + "word " * (100 + i * 7 % 120), f"src{i % 5}") for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    changed = entry.oracle_sql()[name].replace("'tion'", "'nation'")
    searches, base.SEARCHES[2] = base.SEARCHES[2], ("q2", "nation")
    try:
        got = [tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).collect()]
    finally:
        base.SEARCHES[2] = searches
    assert got and sorted(got) == sorted(db.execute(changed).fetchall())


def test_halves_are_rounded_up_in_sql():
    rounded = duckdb.sql(f"SELECT i, {base._half_up('i / 10000.0::DOUBLE', 3)} FROM range(5, 20000, 10) t(i)").fetchall()
    assert len(rounded) == 2000 and all(r == (i + 5) // 10 / 1000 for i, r in rounded)
