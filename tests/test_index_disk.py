"""What an index and a search over it write to disk."""

import os
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from inkframe.functions import text as X
from inkframe.operators import search as Q
from inkframe.sources import segments as G

WORDS = ["phở", "bò", "bún", "chả", "the", "them", "theme", "cơm", "tấm", "a", "ab", "45k", "ñandú"]


def corpus(spark, n, words, most, seed=1):
    rng = random.Random(seed)
    rows = [(i, f"V{i % 4}", i // 2, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, most // 2, most]))), 0.2 + i % 8 / 10) for i in range(n)]
    df = spark.createDataFrame([*rows, (n, "V0", 7, None, 0.9)], "id long, video_id string, frame_idx long, text string, confidence double")
    # some search forms do not follow from the text
    form = F.when(F.col("id") % 5 == 0, "the other form").when(F.col("id") % 5 == 1, F.lit(None)).otherwise(X.to_unsigned(F.col("text")))
    return df.withColumn("text_unsigned", form).withColumn("entities", X.entity_values(F.col("text")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def told(spark, segment):
    """What postings and blocks say, as occurrences."""
    met = segment.postings().where("term <> ''").join(segment.table("blocks"), "block").select("term", "col", "records", F.explode(F.arrays_zip("at", "positions")).alias("o"))
    col = F.explode(F.when(F.col("col") == G.BOTH, F.array(*map(F.lit, G.COLUMNS))).otherwise(F.array("col"))).alias("col")
    rows = met.select("term", col, F.get("records", F.col("o.at")).alias("r"), F.col("o.positions").alias("positions"))
    return rows.select("term", "col", "r.id", "r.d", F.explode("positions").alias("pos"))


def test_an_index_holds_every_occurrence(spark, tmp_path, monkeypatch):
    """In blocks of many records and in blocks of few, and after merging; records come back as they were."""
    records = corpus(spark, 300, WORDS, 30)
    want, kept = rows_of(Q.postings(records), "id", "col", "pos", "term"), rows_of(records, *records.columns)
    lengths = {r["id"]: r["n"] for r in Q.postings(records).groupBy("id").agg(F.count("*").alias("n")).collect()}
    for block in (2000, 7):
        monkeypatch.setattr(G, "BLOCK", block)
        folder = str(tmp_path / f"b{block}")
        for k in range(2):
            G.add_segment(records.where(F.col("id") % 2 == k), folder)
        index = G.TermIndex(spark, folder)
        for segments in (index.segments, [index.compact(factor=2)]):
            found = [r for s in segments for r in told(spark, s).collect()]
            assert sorted(str((r["id"], r["col"], r["pos"], r["term"])) for r in found) == sorted(str((r["id"], r["col"], r["pos"], r["term"])) for r in Q.postings(records).collect())
            assert len(found) == len(want) and all(lengths[r["id"]] == r["d"] for r in found)
            assert sorted(x for s in segments for x in rows_of(s.table("records"), *records.columns)) == kept
            assert sum(s.stats["n_rows"] for s in segments) == 301 and sum(s.stats["total"] for s in segments) == len(want)


def test_search_forms_with_the_terms_of_texts(spark):
    """Only where a letter stays different in index terms are both columns taken apart."""
    letters = [chr(c) for a, b in ((0x20, 0x250), (0x370, 0x400), (0x1E00, 0x2000)) for c in range(a, b)]
    rows = spark.createDataFrame([(c,) for c in letters], "c string").withColumn("u", X.unsigned_of_clean(F.col("c")))
    differ = {r["c"] for r in rows.where(Q.terms(F.col("c")) != Q.terms(F.col("u"))).collect()}
    assert differ and all(re.fullmatch(f"[{G.DIFFERENT}]", c) for c in differ)


def test_blocks_are_cut_where_they_end_and_where_texts_are_long(monkeypatch):
    monkeypatch.setattr(G, "TERMS_AT_ONCE", 6)
    texts = [["x", "y", "x"], ["y"], [], ["x"] * 20, ["z"], ["y", "z"]]
    batch = pa.RecordBatch.from_pydict({"part": pa.array([1] * 6, pa.int32()), "block": pa.array([5, 5, 5, 5, 8, 8]), "col": pa.array([G.BOTH] * 6), "at": pa.array([0, 1, 2, 3, 0, 1], pa.int32()), "ts": pa.array(texts, pa.list_(pa.string()))})
    rows = [r for b in G._blocked(iter([batch.slice(0, 0), batch])) for r in b.to_pylist()]
    told = [(r["block"], at, n) for r in rows if not r["term"] for at, (n,) in zip(r["at"], r["positions"], strict=True)]
    assert sorted(told) == [(5, 0, 3), (5, 1, 1), (5, 2, 0), (5, 3, 20), (8, 0, 1), (8, 1, 2)]
    assert sorted((r["block"], at, p, r["term"]) for r in rows if r["term"] for at, ps in zip(r["at"], r["positions"], strict=True) for p in ps) == sorted((b, at, p, t) for b, at, ts in zip([5, 5, 5, 5, 8, 8], [0, 1, 2, 3, 0, 1], texts, strict=True) for p, t in enumerate(ts))
    assert sorted((r["term"], r["at"]) for r in rows if r["term"] and r["block"] == 8) == [("y", [1]), ("z", [0, 1])]
    held = pa.Table.from_pylist(rows, G._by_block(batch).schema).append_column("home", pa.array([k % 3 for k in range(len(rows))], pa.int32()))
    folded = list(G._folded(100)(iter(held.to_batches(max_chunksize=1))))
    assert len(folded) > 1 and sorted(map(str, rows)) == sorted(str(r) for f in folded for b in G._unfolded(iter([f])) for r in b.to_pylist())


def test_an_index_is_small(spark, tmp_path):
    """Postings, vocabulary and records of prose take less than its texts do without compression, and postings are exchanged as compressed rows, few for a task."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    rows = [(i, " ".join(words[int(rng.random() ** 3 * 3000)] for _ in range(300))) for i in range(800)]
    records = spark.createDataFrame(rows, "id long, text string").withColumn("text_unsigned", X.to_unsigned(F.col("text"))).coalesce(1)
    segment = G.add_segment(records, str(tmp_path))
    disk = sum(os.path.getsize(f"{top}/{f}") for top, _, files in os.walk(tmp_path) for f in files if f.endswith(".parquet"))
    assert disk < sum(len(t) for _, t in rows)
    placed = G._placed(spark.read.parquet(f"{segment.at}/records"), segment.name)
    dealt = G._dealt(G._packed(placed), 4)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    homes = G._packed(placed).select(F.pmod(F.hash("term", "part"), F.lit(4)).alias("home"), "*").mapInArrow(G._folded(G.LEAST_FOLDED), "home int, folded binary")
    assert homes.count() <= 8


def test_texts_are_not_exchanged_for_hits(spark, tmp_path):
    """Candidates come to the records; a large batch may still exchange them."""
    records, folder = corpus(spark, 90, WORDS, 30), str(tmp_path)
    G.add_segment(records, folder)
    asked = spark.createDataFrame([("q0", "phở bò"), ("q1", "the")], "qid string, query string")
    index = G.TermIndex(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = re.findall(r"^[ :]*[+:]- .*", plan(Q.search(index.records(), asked, top_k=5, index=index)), re.M)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "[" in line and "text#" in line.split("Batched")[0]]
    assert scans
    for i in scans:
        above, depth = [], lines[i].index("FileScan")
        for up in reversed(lines[:i]):
            at = len(up) - len(up.lstrip(" :+-"))
            if at < depth:
                above.append(up.strip(" :+-").split(" ")[0].split("(")[0])
                depth = at
        join = next(k for k, name in enumerate(above) if "Join" in name)
        assert "Exchange" not in above[:join], above


def test_matches_are_dealt_out_by_block_once(spark, tmp_path):
    """Document frequencies and scores read one exchange of packed postings, in as many parts as the index has buckets."""
    G.add_segment(corpus(spark, 90, WORDS, 30), str(tmp_path))
    index = G.TermIndex(spark, str(tmp_path))
    found = Q.bm25(index.records(), spark.createDataFrame([("q0", "phở bò"), ("q1", "the")], "qid string, query string"), index)
    found.write.format("noop").mode("overwrite").save()
    tree = plan(found)
    dealt = [line for line in tree.split("\n") if "REPARTITION_BY_NUM" in line and " Exchange " in line]
    assert dealt and all(f", {index.segments[0].stats['buckets']})" in line for line in dealt) and all("block" in line for line in dealt)
    assert not any("hashpartitioning(id" in line for line in tree.split("\n"))
