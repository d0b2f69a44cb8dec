"""Copy-on-write upsert, filter audit and sharding against plain versions, with nulls, ties, repeats and odd columns."""

import hashlib
import itertools
import math
import os
import random
import zlib
from collections import Counter
from datetime import datetime

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from inkframe.llm.filter_audit import FILTERS, filter_audit
from inkframe.llm.sharding import shard_documents
from inkframe.llm.upsert import bloom, client_upsert, held, layout

CLIENT = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double, home int, rank string"
CHANGE = "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double, home string"


def crc(x):
    return zlib.crc32(str(x).encode())


def plain_upsert(clients, changes, columns):
    """The rules of the query, read row by row."""
    most = 1 + len(clients) // 1000
    known = sorted((c for c in clients if c["client_id"] is not None and crc(c["client_id"]) % 7 > 3), key=lambda c: c["client_id"])
    files = [known[i : i + most] for i in range(0, len(known), most)]
    if not files:
        return []
    firsts = [f[0]["client_id"] for f in files]
    last = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    for c in changes:
        if c["client_id"] is not None:
            key = (low(c["seq"]), low(c["change_id"]))
            if c["client_id"] not in last or key > last[c["client_id"]][0]:
                last[c["client_id"]] = key, c
    by_home = {}
    for k, (_, c) in last.items():
        home = max((i for i, f in enumerate(firsts) if f <= k), default=0)
        by_home.setdefault(home, []).append((k, c))
    out = []
    for home, rows in enumerate(files):
        h, now = crc(firsts[home]) % 16, {r["client_id"]: dict(r) for r in rows}
        for k, c in by_home.get(home, []) if h <= 7 else []:
            if c["op"] == "D" or (c["change_id"] is not None and crc(c["change_id"]) % 8 < h):
                now.pop(k, None)
            else:
                now[k] = now.get(k, dict.fromkeys(columns) | {"client_id": k}) | {x: c[x] for x in ("source", "segment", "city", "balance")}
        rows_now = [now[k] for k in sorted(now)]
        if rows_now == rows:
            out.append((False, rows))
            continue
        n, k = len(rows_now), math.ceil(len(rows_now) / most)
        at = 0
        for i in range(k):
            size = n // k + (i < n % k)
            piece, at = rows_now[at : at + size], at + size
            if out and out[-1][0] and len(out[-1][1]) + len(piece) <= most:
                out[-1] = (True, out[-1][1] + piece)
            else:
                out.append((True, piece))
    told = []
    for rewritten, rows in out:
        cents = sum(math.floor(100 * r["balance"] + 0.5) if r["balance"] is not None else 0 for r in rows)
        lines = sum(zlib.crc32("|".join(r[c] or "" for c in ("source", "segment", "city")).encode()) for r in rows)
        told.append((rows[0]["client_id"], len(rows), cents, lines, hashlib.sha256(",".join(str(r["client_id"]) for r in rows).encode()).hexdigest(), ",".join(columns), rewritten))
    return told


def same_upsert(spark, clients, changes):
    got = client_upsert(clients, changes).collect()
    want = plain_upsert([r.asDict() for r in clients.collect()], [r.asDict() for r in changes.collect()], clients.columns)
    assert sorted(tuple(r[:6]) + (r["rewritten"],) for r in got) == want
    for r in got[:20]:
        assert pq.read_metadata(r["path"].removeprefix("file://")).num_rows == r["n_rows"]
    if got:
        folder = os.path.dirname(got[0]["path"].removeprefix("file://"))
        assert {f for f in os.listdir(folder) if f.endswith(".parquet")} == {os.path.basename(r["path"]) for r in got}
    return got


def shop(spark, n, seed, ids=None):
    rng = random.Random(seed)
    some = lambda *xs: rng.choice([None, *xs])
    ids = ids or list(range(n))
    clients = [(i, i, some("a", "b"), datetime(2024, 1, 1), f"n{i}", None, some("c", "d"), 1, some("s", "t"), some(1.005, 2.5, -3.0), 1, "x") for i in ids]
    changes = []
    for c in range(4 * n):
        k = rng.choice([None, 7, 7, rng.randrange(n + 40), rng.randrange(n + 40), -3])
        changes.append((rng.choice([None, c, c, c - 1]), k, rng.choice([None, rng.randrange(20)]), rng.choice(["D", "U", "I", None]), None, some("a", "b"), some("s", "t"), some("c", "d"), some(1.005, 2.5), "y"))
    # rows that tie in seq and change_id are repeats
    seen = {}
    changes = [seen.setdefault((k, s, i), row) for row in changes for i, k, s in [row[:3]]]
    return spark.createDataFrame(clients, CLIENT), spark.createDataFrame(changes, CHANGE)


@pytest.mark.parametrize("n,seed", [(60, 1), (2300, 2)])
def test_upsert_equals_plain(spark, n, seed):
    got = same_upsert(spark, *shop(spark, n, seed))
    assert any(r["rewritten"] for r in got) and not all(r["rewritten"] for r in got)


def test_upsert_of_new_ids_past_the_end(spark):
    """Many ids come to the last file; it becomes many files."""
    clients, _ = shop(spark, 1200, 3)
    changes = spark.createDataFrame([(8 * i, 2000 + i, 1, "I", None, "a", "b", None, 1.0, "") for i in range(300)], CHANGE)
    same_upsert(spark, clients, changes)


def test_upsert_of_empty_tables(spark):
    clients, changes = shop(spark, 40, 4)
    assert client_upsert(clients.limit(0), changes).collect() == []
    same_upsert(spark, clients, changes.limit(0))
    gone = spark.createDataFrame([(1, i, 9, "D", None, None, None, None, None, "") for i in range(40)], CHANGE)
    same_upsert(spark, clients, gone)


def test_upsert_of_the_shop(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    same_upsert(spark, *(spark.read.parquet(f"{sf}/{t}.parquet") for t in ("clients", "client_changes")))


def test_upsert_of_odd_balances_and_repeated_ids(spark):
    clients, _ = shop(spark, 30, 5)
    twice = clients.unionByName(clients).withColumn("balance", F.when(F.col("client_id") % 2 == 0, float("nan")).otherwise(float("inf")))
    changes = spark.createDataFrame([(8 * i, i, 1, "U", None, "z", "z", "z", 1.0, "") for i in range(30)], CHANGE)
    got = client_upsert(twice, changes).collect()
    assert sum(r["n_rows"] for r in got) >= 2 * sum(crc(i) % 7 > 3 for i in range(30)) and all(r["cents"] >= 0 for r in got)


def test_filters_forget_no_key():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    bits = bloom(iter(np.array_split(keys, 7)), len(keys))
    assert held(bits, keys).all()
    assert held(bits, np.arange(20000)).mean() < 0.03


def test_layout():
    assert layout({0: 5, 1: 0, 2: 1, 4: 3}, 5, 2) == [0, 2, 4, 6, 8, 9]
    assert layout({0: 1, 1: 0, 2: 1, 3: 1}, 4, 3) == [0, 3]
    assert layout({0: 0}, 1, 3) == [0]


DOC = "doc_id long, text string, lang string, source string, n_chars long, th string, word int, fails string, part string, own int, key string, rid long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", 1, "y", "p", 3, "k", 5) for i, t, s in rows], DOC)


def plain_audit(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    by = {}
    for i, t, s in rows:
        t = t or ""
        words = [w for w in t.translate(str.maketrans({c: " " for c in "\t\n\v\f\r"})).split(" ") if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and t in least and i > least[t]}
        by.setdefault(s or "", []).append(({f for f in FILTERS if fails[f]}, i in good, i in toxic))
    out = []
    for part, docs in by.items():
        rows_of, shapley = [], Counter()
        for order in itertools.permutations(FILTERS):
            before = set()
            for step, f in enumerate(order, 1):
                here = [d for d in docs if f in d[0] and not d[0] & before]
                shapley[f] += len(here)
                rows_of.append((f, part, "".join(order), step, sum(not d[0] & (before | {f}) for d in docs), len(here), sum(f in d[0] and bool(d[0] & before) for d in docs), sum(d[0] == {f} for d in docs), sum(d[1] for d in here), sum(d[2] for d in here)))
                before.add(f)
        out += [r[1:] + (shapley[r[0]],) for r in rows_of]
    return sorted(out)


def test_audit_equals_plain(spark):
    rng = random.Random(3)
    words = ["a", "A", "bb", "é", "x#", "Ünï", "tab\tnew\nline", "nb\xa0sp", "𝔸Z"]
    rows = [(i, " ".join(rng.choice(words if rng.random() < 0.7 else [f"w{k}" for k in range(400)]) for _ in range(rng.choice([0, 1, 199, 200, 230]))), rng.choice(["s", "t", None, ""])) for i in range(60)]
    rows += [(i + 100, rows[i % 5][1], "s") for i in range(30)]
    rows += [(None, "lost", "t"), (None, "lost", "t"), (5, rows[5][1], "s"), (5, "another text of 5", "t"), (900, None, None), (901, "", "t"), (902, " \n lead and trail \t", "s"), (903, "long " * 30000, "s")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 130, 2)] + [(4, 1, 1), (None, 1, 1)]
    got = filter_audit(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert sorted(tuple(r) for r in got) == plain_audit(rows, labels)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in filter_audit(docs_of(spark, rows[:3]), none).collect()) == plain_audit(rows[:3], [])
    assert filter_audit(docs_of(spark, []), none).collect() == []


def test_audit_equals_sql(spark):
    import duckdb

    from inkframe.llm import queries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = sorted(db.execute(queries.ORACLE["op12_filter_audit"]).fetchall())
    got = queries.QUERIES["op12_filter_audit"](spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == want


def lawful(rows, shards):
    """Counts at most one apart and slots without gaps."""
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert {r["law"] for r in rows} <= {"rows"} and all(r["grown_shard"] is None for r in rows)


def parts_of(rows):
    at = {}
    for r in rows:
        at.setdefault((r["text_crc32"], r["size"]), Counter())[r["shard"]] += 1
    return at


def test_shards_keep_copies_together(spark):
    rows = [(i, f"text {i % 90} {'x' * (i % 17)}" if i % 3 else f"alone {i}", "s") for i in range(1500)]
    rows += [(None, "no id", "s"), (None, "no id", None), (7, None, "t"), (7, "", "t"), (8, "long " * 20000, "t"), (8, "long " * 20000, "t")]
    got = shard_documents(docs_of(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    lawful(got, 8)
    assert all(len(c) == 1 for c in parts_of(got).values())


def test_shards_of_a_group_beyond_any_room(spark):
    """Half of all rows have one text: it fills as few shards as hold it, and no other group is cut more than the last places need."""
    rows = [(i, "the same" if i % 2 else f"pair {i // 4}", "s") for i in range(4000)]
    got = shard_documents(docs_of(spark, rows)).collect()
    lawful(got, 8)
    cut = parts_of(got)
    large = cut.pop(max(cut, key=lambda k: sum(cut[k].values())))
    assert len(large) <= 5
    assert sum(len(c) > 1 for c in cut.values()) <= 8


def test_shards_of_few_rows(spark):
    for rows in ([], [(1, "a", "s")], [(i, "same", "s") for i in range(11)]):
        got = shard_documents(docs_of(spark, rows)).collect()
        assert len(got) == len(rows)
        lawful(got, 8)


def test_shards_by_another_link(spark):
    rows = [(i, f"t{i}", f"host{i % 40}" if i % 5 else None) for i in range(800)]
    got = shard_documents(docs_of(spark, rows), shards=4, link=F.col("source")).collect()
    lawful(got, 4)
    host = {i: s for i, _, s in rows}
    at = {}
    for r in got:
        if host[r["doc_id"]]:
            at.setdefault(host[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in at.values()) <= 3
