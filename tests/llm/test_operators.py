"""Operators against brute force, round trips and held-out accuracy, with nulls, ties, repeats and odd columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
KIND = "doc_id long, text string, lang string, source string, n_chars long, cls string, key string"


def docs_of(spark, rows):
    """Rows (doc_id, text) with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or ""), "x", "y") for k, (i, t) in enumerate(rows)], KIND)


WORDS = [f"w{i}" for i in range(60)]


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 1, 2, 6])):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 2, 5, 40, 120])))))
    return rows + [(900, None), (901, ""), (902, "  \n "), (903, "one"), (903, "one"), (904, "ONE"), (None, "lost words here now")]


def brute_groups(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            if rows[a][0] == rows[b][0] or den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                if rows[a][0] != rows[b][0] or sets[a] == sets[b]:
                    root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_jaccard_groups(spark, k, num):
    from inkframe.llm.jaccard_join import jaccard_groups

    rows = corpus(seed=k)
    got = jaccard_groups(docs_of(spark, rows), k, (num, 100)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == brute_groups(rows, k, num, 100)
    assert jaccard_groups(docs_of(spark, []), k, (num, 100)).count() == 0


@pytest.mark.parametrize("most", [1, 3])
def test_hot_regions_lose_no_link(spark, most, monkeypatch):
    """With regions of more than `most` rows taken for hot ones, groups are the same: near copies, equal texts, one size and many sizes."""
    from inkframe.llm import jaccard_join as J

    monkeypatch.setattr(J, "REGION_BLOCK", most)
    rng = random.Random(most)
    base = [f"v{i}" for i in range(90)]
    rows = [(1000 + i, " ".join(base[: 90 - i % 12])) for i in range(30)] + [(2000 + i, " ".join([*base[:45], *(f"z{i}-{j}" for j in range(rng.randrange(1, 60)))])) for i in range(20)]
    rows = corpus(seed=9, n=40) + rows + rows[:5]
    got = J.jaccard_groups(docs_of(spark, rows), 3, (90, 100), count_links=True).select("doc_id", "n_shingles", "component_id", "n_links").collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == brute_groups(rows, 3, 90, 100)
    links = brute_links([r for r in rows if r[0] is not None], 3, 90, 100)
    assert {r["doc_id"]: r["n_links"] for r in got if r["doc_id"] is not None} == links


def brute_links(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    return {d: sum(1 for j, b in enumerate(sets) if i != j and a and b and den * len(a & b) >= num * len(a | b)) for i, ((d, _), a) in enumerate(zip(rows, sets, strict=True))}


@pytest.mark.parametrize("num", [80, 90])
def test_large_clusters_keep_all_links(spark, num, monkeypatch):
    """Copies with edits of three texts, in clusters of many blocks, some links of them only across borders."""
    from inkframe.llm import jaccard_join as J

    rng = random.Random(num)
    base = [[rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n)] for n in (60, 90, 200)]
    rows = []
    for i in range(330):
        w = list(base[i % 3])
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    want, links = brute_groups(rows, 3, num, 100), brute_links(rows, 3, num, 100)
    counting = num == 90
    got = J.jaccard_groups(docs_of(spark, rows), 3, (num, 100), count_links=counting).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert not counting or {r.doc_id: r.n_links for r in got} == links


def test_metric_join_divides(monkeypatch):
    """Cells, windows and sure links against brute force, with and without counting."""
    from inkframe.llm import jaccard_join as J

    rng = np.random.default_rng(5)
    monkeypatch.setattr(J, "LEAF", 6)
    monkeypatch.setattr(J, "PIVOTS", 5)
    for turn in range(12):
        centres = [np.unique(rng.integers(0, 1 << 62, 40).astype(np.uint64)) for _ in range(6)]
        sets = []
        for i in range(70):
            c = centres[int(rng.integers(0, 6))]
            sets.append(np.unique(np.concatenate([c[rng.random(len(c)) > 0.08], rng.integers(0, 1 << 62, int(rng.integers(1, 4))).astype(np.uint64)])))
        side = np.full(70, -1) if turn % 2 else rng.integers(0, 2, 70)
        pairs = [(a, b) for a in range(70) for b in range(a) if (side[a] < 0 or side[a] != side[b]) and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
        for counting in (True, False):
            join = J.MetricJoin(sets, np.arange(70), side, np.arange(1, 71), 80, 100, counting)
            root = list(range(70))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for a, b in pairs:
                root[find(a)] = find(b)
            apart = {find(i): join.root[i] for i in range(70)}
            assert [apart[find(i)] for i in range(70)] == join.root.tolist() and len(set(apart.values())) == len(apart)
            if counting:
                n = np.zeros(70, int)
                for a, b in pairs:
                    n[a] += b + 1
                    n[b] += a + 1
                assert n.tolist() == join.n_links.tolist()


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_of_thue_morse_do_not_collide(spark):
    from inkframe.llm.jaccard_join import jaccard_groups

    rows = [(i, thue_morse(n, *p)) for i, (n, p) in enumerate((n, p) for n in (1024, 2048, 4096) for p in ("ab", "ba"))]
    got = jaccard_groups(docs_of(spark, rows), 3, (90, 100)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == [(i, 1, i) for i in range(6)]


def test_a_doc_id_with_several_texts(spark):
    from inkframe.llm.jaccard_join import jaccard_groups

    base = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join([*base, "x"])), (1, "quite another text of some words"), (1, "quite another text of some words"), (2, " ".join([*base, "y"]))]
    got = jaccard_groups(docs_of(spark, rows), 3, (90, 100)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 4, 1), (1, 4, 1), (1, 99, 1), (2, 99, 1)]


def test_jaccard_links_are_all_links(spark):
    from inkframe.llm.jaccard_join import jaccard_links

    rng = random.Random(4)
    base = [rng.choice(WORDS) + str(i) for i in range(100)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(14)] + [(50, " ".join([*base, "end3"])), (51, "else")]
    pairs = [tuple(r) for r in jaccard_links(docs_of(spark, rows), 3, (90, 100)).select("a", "b").collect()]
    assert sorted(pairs) == [(a, b) for a in range(14) for b in range(a + 1, 14)]


def test_null_ids_hide_no_link(spark):
    from inkframe.llm.jaccard_join import jaccard_groups

    base = [f"w{i}" for i in range(100)]
    one, two = " ".join([*base, "x"]), " ".join([*base, "y"])
    got = jaccard_groups(docs_of(spark, [(None, one), (1, one), (2, two)]).coalesce(1), 3, (90, 100)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1), (2, 1), (None, None)]


def test_windows_meet():
    from inkframe.llm.jaccard_join import _window

    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(5, 60))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.04], rng.integers(0, 1 << 62, 1).astype(np.uint64)]))
        if 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
            continue
        hot = rng.permutation(np.union1d(x, y))[: int(rng.integers(1, n))]
        by = np.argsort(hot)
        assert len(np.intersect1d(_window(x, hot[by], by, 80, 100), _window(y, hot[by], by, 80, 100))), (len(x), len(y))


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_components(spark, few, monkeypatch, tmp_path):
    from inkframe.llm import components as C
    from inkframe.llm.scratch import Scratch

    monkeypatch.setattr(C, "FEW", few)
    rng = random.Random(6)
    edges = [(rng.randrange(-50, 400), rng.randrange(-50, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000)] + [(7000, i) for i in range(7001, 7050)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = C.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), "t").collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in {x for a, b in edges if a != b for x in (a, b)})
    assert C.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test"), "u").count() == 0


def brute_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((d, len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_passages(rows, words):
    bags = [(t or "").encode().split() for _, t in rows]
    seen = {}
    for k, w in enumerate(bags):
        for i in range(len(w) - words + 1):
            seen.setdefault(tuple(w[i : i + words]), set()).add(k)
    out = []
    for (d, _), w in zip(rows, bags, strict=True):
        out.append((d, len({j for i in range(len(w) - words + 1) if len(seen[tuple(w[i : i + words])]) > 1 for j in range(i, i + words)})))
    return sorted(out, key=str)


def test_levels_of_the_family(spark):
    """Seventeen batches make five levels; what they mark is what one batch marks."""
    from inkframe.llm import suffix_dedup as S
    from inkframe.llm.scratch import Scratch

    rng = random.Random(9)
    shared = ["".join(rng.choice("abcd") for _ in range(50)) for _ in range(4)]
    rows = [(i, "".join(rng.choice("abcd") for _ in range(20)) + rng.choice(shared) + "".join(rng.choice("abcd") for _ in range(20))) for i in range(60)]
    texts = spark.createDataFrame(rows, "th long, text string").repartition(1)
    family = S.SuffixIndexFamily(Scratch(spark, "levels"), "t")
    entries = texts.mapInArrow(S._indexed(40, 24, False), "th long, pos long, l0 short, l1 short, gram long, span long").cache()
    for b in range(17):
        family.add(entries.where(F.pmod("th", F.lit(17)) == b))
    assert [level is not None for level in family.levels] == [True, False, False, False, True]
    want = S.SuffixIndexFamily.array(entries).where("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed"))
    assert sorted(map(tuple, family.repeated().collect())) == sorted(map(tuple, want.collect()))
    order = [r["gram"] for r in family.levels[4].collect()]
    assert sum(a > b for a, b in zip(order[:-1], order[1:], strict=True)) < 4  # sorted within partitions


def test_repeated_strings(spark):
    from inkframe.llm.suffix_dedup import repeated_strings

    rng = random.Random(4)
    shared = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (30, 55, 90)]
    rows = [(i, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(80))) + rng.choice(shared) + "".join(rng.choice("ab") for _ in range(rng.randrange(50)))) for i in range(40)]
    rows += [(50, rows[0][1]), (50, rows[0][1]), (51, "a" * 200), (52, "xy" * 70), (53, None), (54, ""), (None, shared[2]), (55, "short")]
    passage = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (9, 12, 20)]
    rows += [(60 + i, " ".join([rng.choice("xyz") * i, rng.choice(passage), rng.choice("xyz") * i, rng.choice(passage)])) for i in range(25)]
    rows += [(90, "p q r s t u v w x"), (91, "p q r s t u v w x"), (92, " ".join("klmno" * 6))]
    rows += [(95 + i, " ".join(["efgh"[i] * 3, *("klmno" * 4), "abc"[i % 3], *passage[1].split()[:11], *("klmno" * 3)])) for i in range(4)]
    got = repeated_strings(docs_of(spark, rows), 40, 24, 4, 9, 4).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "passage_words").collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_repeats(rows, 40)
    assert sorted(((r.doc_id, r.passage_words) for r in got), key=str) == brute_passages(rows, 9)
    assert repeated_strings(docs_of(spark, []), 40, 24, 2).count() == 0


def test_strings_of_thue_morse_are_not_repeated(spark):
    """Strings for which hashes that are sums of powers collide modulo 2**64."""
    from inkframe.llm.suffix_dedup import repeated_strings

    rows = [(1, thue_morse(2048) + "c"), (2, thue_morse(2048, "b", "a") + "d")]
    got = repeated_strings(docs_of(spark, rows), 1600, 1100, 1).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == brute_repeats(rows, 1600)


def test_segments_of_long_texts(monkeypatch):
    """Anchors and windows of a text do not depend on how it is cut."""
    from inkframe.llm import suffix_dedup as S

    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = S.anchors(S.Elements(data, np.array([0, 5000]), False), 40, 24)
    monkeypatch.setattr(S, "_SEGMENT", 200)
    parts = S.anchors(S.Elements(data, np.array([0, 5000]), False), 40, 24)
    covered = lambda found: {int(p - a) + i for p, a, b in zip(found[1], found[2], found[3], strict=True) for i in range(int(a - b) + 1)}
    assert covered(whole) == covered(parts) == set(range(5000 - 40 + 1))
    assert dict(zip(whole[1].tolist(), whole[4].tolist(), strict=True)) == dict(zip(parts[1].tolist(), parts[4].tolist(), strict=True))


ODD = ["", "   \n\t x", "a" * 3000, "<|endoftext|> hi <|startoftext|>x", "ΑΣΣ ΟΔΟΣ", "Ünïcødé ñandú İstanbul", "don't WE'LL 's ''s !'s x's's 'we're they'd'", "日本語 русский ١٢٣ ½", "\x1c a\x1fb\x85c\xa0d", "a×b÷c", "😀👍🏽", "x  y \n\n z\n", "'"]


def odd_texts():
    rng = random.Random(2)
    return ODD + ["".join(rng.choice(" \n\t'srevmldtaéZ9!.,ßñ") for _ in range(rng.randrange(60))) for _ in range(1500)]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    from inkframe.llm.token_counts import token_counts

    path, texts = public_tokenizers.path("word_bpe_49k.json"), odd_texts()
    library = Tokenizer.from_file(path)
    rows = list(enumerate(texts)) + [(None, "a b"), (7, None), (7, None)]
    got = token_counts(docs_of(spark, rows), path, limit=5).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    assert all(r["over_limit"] == (r["n_tokens"] > 5) for r in got)


def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer

    from inkframe.llm.token_store import token_store

    path, texts = public_tokenizers.path("byte_bpe_50k.json"), odd_texts()
    library = Tokenizer.from_file(path)
    rows = [(2 * i, t) for i, t in enumerate(texts)]
    random.Random(0).shuffle(rows)
    got = token_store(docs_of(spark, rows + [(9999, None)]), path, end_id=2).orderBy("doc_id").collect()
    start = 0
    for r, (d, t) in zip(got, sorted(rows) + [(9999, "")], strict=True):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, start, len(ids), zlib.crc32(ids.tobytes())), t
        start += len(ids)
    assert token_store(docs_of(spark, []), path).count() == 0


def test_other_tokenizers_are_refused():
    from inkframe.llm.token_counts import TokenCounter

    with pytest.raises(ValueError):
        TokenCounter(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())


def test_encoder_compares_bytes():
    """Pre-tokens that hash alike, those beyond the table's width, and a table that fills up."""
    from tokenizers import Tokenizer

    from inkframe.llm import token_store as T

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, rng = Tokenizer.from_file(path), random.Random(7)
    texts = [thue_morse(n, *p) + " " + thue_morse(n, *p[::-1]) for n in (1024, 2048) for p in ("ab", "ba")]
    texts += ["".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(60)] + ["x" * 23, "x" * 24, "x" * 25, "\x00", "\x00\x00", "a\x00", "a"]
    old = T.SLOTS, T.POOL
    try:
        T.SLOTS, T.POOL = 64, 3000
        encoder = T.Encoder(open(path, encoding="utf-8").read())
        for i in range(0, len(texts), 7):
            got = encoder.encode(pa.array(texts[i : i + 7]))
            assert [np.frombuffer(g, "<u4").tolist() for g in got] == [e.ids for e in library.encode_batch(texts[i : i + 7], add_special_tokens=False)]
    finally:
        T.SLOTS, T.POOL = old


def test_shard_file_blocks(tmp_path):
    from pyarrow import fs

    from inkframe.llm.token_store import BLOCK, ShardReader, ShardWriter

    local, rng = fs.LocalFileSystem(), np.random.default_rng(1)
    docs = [(i, rng.integers(0, 50_000, n).astype("<u4").tobytes()) for i, n in enumerate([0, 1, BLOCK, 3 * BLOCK + 5, 7])]
    w = ShardWriter(local.open_output_stream(str(tmp_path / "x"), compression=None))
    for d, ids in docs:
        w.add(d, ids)
    assert w.close()[0] == 5
    with local.open_input_file(str(tmp_path / "x")) as f:
        assert [(d, b"".join(p)) for d, p in ShardReader(f).documents()] == docs


def test_decontamination(spark, monkeypatch):
    from inkframe.llm import decontaminate as dc

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(WORDS[:9]) for _ in range(rng.randrange(60)))) for i in range(60)] + [(70, None), (71, ""), (None, "w1 w2"), (72, "W3,w4--É w5")]
    items = [(i, " ".join(rng.choice(WORDS[:9]) for _ in range(rng.randrange(8)))) for i in range(12)] + [(50, "w3 w4 É W5"), (51, None), (52, " "), (None, "w1"), (10, "w8 w8")]
    form = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    want = []
    for d, t in rows:
        w, hit, names = form(t), set(), set()
        for item, text in items:
            p = form(text)
            for j in range(len(p) - min(4, len(p)) + 1 if p and item is not None else 0):
                x = p[j : j + 4]
                for i in range(len(w) - len(x) + 1):
                    if w[i : i + len(x)] == x:
                        hit.update(range(i, i + len(x)))
                        names.add(str(item))
        want.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (dc.PASS_BYTES, 20):  # one pass, and several
        monkeypatch.setattr(dc, "PASS_BYTES", size)
        got = dc.contamination(docs_of(spark, rows), bench, 4).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert dc.contamination(docs_of(spark, rows), bench.limit(0), 4).where("contaminated").count() == 0


def test_knn_join(spark):
    from inkframe.llm.knn_join import knn_join

    rng = np.random.default_rng(2)
    x = rng.normal(0, 0.2, (300, 8)).astype(np.float32)
    x[40:60] = x[40]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(1000, None, 0), (1001, [1.0, None] * 4, 0), (1002, [float("nan")] * 8, 0), (None, [0.1] * 8, 0), (1050, [0.5] * 7, 0), (1060, [0.25] * 7, 0), (1061, [0.5] * 7, 0)]
    got = knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<float>, grp int"), every=10, k=5).collect()
    q = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    want = [(i, r + 1, j, -s) for i in range(0, 300, 10) for r, (s, j) in enumerate(sorted((-int(q[i] @ q[j]), j) for j in range(300) if j != i)[:5])]
    want += [(1050, 1, 1061, 128 * 128 * 7), (1050, 2, 1060, 128 * 64 * 7), (1060, 1, 1050, 64 * 128 * 7), (1060, 2, 1061, 64 * 128 * 7)]  # another length is a join of its own
    assert sorted(map(tuple, got)) == sorted(want)
    assert knn_join(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("scale", [1e5, 1e9, 1e14])
def test_knn_join_is_exact_at_any_size(spark, scale):
    """Products beyond 2**53, beyond 64 bits, and vectors of very different lengths."""
    from inkframe.llm.knn_join import LEAST, MOST, knn_join

    rng = np.random.default_rng(3)
    x = rng.normal(0, scale, (120, 6)) * rng.choice([1, 1e-3], (120, 1))
    got = knn_join(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), every=10, k=4).collect()
    q = np.floor(256 * x).astype(np.int64).astype(object)
    want = [(i, r + 1, j, min(max(-s, LEAST), MOST)) for i in range(0, 120, 10) for r, (s, j) in enumerate(sorted((-int(q[i] @ q[j]), j) for j in range(120) if j != i)[:4])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_language_id(spark):
    from inkframe.llm.language_id import language_id

    rng = random.Random(5)
    parts = {"aa": ["the", "ing", "er", "th", "on"], "bb": ["é", "eau", "que", "oui", "le"], "cc": ["sch", "ü", "ung", "ei", "ß"]}
    rows = [(i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.choice([3, 20, 300]))), lang) for i in range(300) for lang in [rng.choice(list(parts))]]
    rows += [(1000, None, "aa"), (1001, "123 --", "bb"), (1002, "", None), (None, "the thing", "aa")]
    found = {r["doc_id"]: r for r in language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most=200).collect()}
    assert len(found) == len(rows)
    held = [i for i, *_ in rows[:300] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i]["held_out"] for i in held) and sum(r["held_out"] for i, r in found.items() if i is not None and i < 300) == len(held)
    assert sum(found[i]["lang_pred"] == rows[i][2] for i in held) >= 0.95 * len(held)
    assert [found[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_scores_equal_plain_convolution():
    """Windows, maxima and softmax one by one; a text's scores do not depend on its neighbours."""
    from inkframe.llm import language_id as L

    rng = np.random.default_rng(4)
    net = L.ByteConvNet(["a", "b", "c"])
    net.params["bias"] = rng.normal(0, 0.1, net.filters).astype(np.float32)
    net.pack()
    texts = [bytes(rng.integers(1, 256, n).astype(np.uint8)) for n in (1, 2, L.WINDOW - 1, L.WINDOW, 0, L.WINDOW + 1, 3 * L.WINDOW + 5, 7)]
    reach, t = len(net.params["tables"]), net.params["tables"]

    def plain(text):
        probs = []
        padded = text + bytes(2 * reach)
        for at in range(0, len(text), L.WINDOW):
            places = range(at, min(at + L.WINDOW, len(text) + reach - 1))
            top = np.max([sum(t[k][padded[p + k]] for k in range(reach)) for p in places], axis=0) + net.params["bias"]
            z = np.exp(np.maximum(top, 0) @ net.params["out"] + net.params["out_bias"])
            probs.append(z / z.sum())
        return np.mean(probs, axis=0) if probs else np.zeros(3)

    together = net.scores(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])]))
    for text, got in zip(texts, together, strict=True):
        alone = net.scores(np.frombuffer(text, np.uint8), np.array([0, len(text)])) if text else np.zeros((1, 3))
        assert np.allclose(got, plain(text), atol=1e-5) and np.allclose(alone[0], got, atol=1e-6)


def plain_subsequences(word):
    """Every three letters of a word with their gaps, as the kernel is defined; length 1."""
    from inkframe.llm.toxicity import DECAY, SPAN

    found = {}
    for i in range(len(word)):
        for j in range(i + 1, len(word)):
            for k in range(j + 1, len(word)):
                if k - i < SPAN:
                    found[word[i], word[j], word[k]] = found.get((word[i], word[j], word[k]), 0.0) + DECAY ** (k - i + 1)
    length = sum(x * x for x in found.values()) ** 0.5
    return {s: x / length for s, x in found.items()}


def test_kernel_and_folded_weights():
    """Kernel values against the sum over all gapped triples, and folded margins against the machine over whitened landmarks."""
    from inkframe.llm import toxicity as T

    words = ["idiot", "id-iot", "xid1otx", "a", "aaaaaaaa", "banana", "été", "naïve", "w0rds", "longerwordthanthat", "tot", "ß"]
    coded = [T.codes(w) for w in words]
    marks = [T.codes(w) for w in ("idiot", "banana", "words", "oi")]
    plain = [plain_subsequences(w) for w in coded]
    want = np.array([[sum(x * m.get(s, 0.0) for s, x in p.items()) for m in map(plain_subsequences, marks)] for p in plain])
    model = T.ToxicityModel.__new__(T.ToxicityModel)
    model.landmarks = T.vectors(marks)
    assert np.allclose(T.kernel(coded, model.landmarks), want, atol=1e-6)
    values, basis = np.linalg.eigh(model.landmarks @ model.landmarks.T)
    model.whiten = basis / np.sqrt(values)
    w = np.random.default_rng(2).normal(size=len(marks) + 1)
    model._fold(w)
    assert np.allclose(model.margins(words), want @ model.whiten @ w[:-1] + w[-1], atol=1e-5)
    assert model.margins(["22", "--", ""]).tolist() == [-2.0] * 3  # 1, 3 and others stand for letters, 2 does not


def test_toxicity_of_odd_tables(spark):
    """No rows, no labels, labels of one kind, null and repeated doc_ids; columns of docs whose names clash with inner ones."""
    from inkframe.llm.toxicity import toxicity

    kind = "doc_id long, quality int, toxic int"
    rows = [(1, "plain words"), (1, "other words"), (None, "lost"), (2, None), (3, ""), (4, "word " * 50_000)]
    docs = docs_of(spark, rows).withColumns({"toxic": F.lit(1), "score": F.lit("z"), "words": F.lit(0), "held_out": F.lit(None).cast("int")})
    assert toxicity(docs.limit(0), spark.createDataFrame([(1, 1, 1)], kind)).count() == 0
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1), (4, 1, None)]):
        got = toxicity(docs, spark.createDataFrame(labels, kind)).collect()
        assert sorted((r["doc_id"] for r in got), key=str) == [1, 1, 2, 3, 4, None] and {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}


def test_language_of_odd_tables(spark):
    """No rows, no labels, null and repeated doc_ids, a very long text; columns of docs whose names clash with inner ones."""
    from inkframe.llm.language_id import language_id

    rows = [(1, "plain words"), (1, "other words"), (None, "lost"), (2, None), (3, ""), (4, "12 34"), (5, "word " * 50_000)]
    docs = docs_of(spark, rows).withColumns({"lang_pred": F.lit(1), "score": F.lit("z"), "held_out": F.lit(None).cast("int"), "h": F.lit("h")})
    assert language_id(docs.limit(0)).count() == 0
    unlabelled = language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert sorted((r["doc_id"] for r in unlabelled), key=str) == [1, 1, 2, 3, 4, 5, None] and {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in language_id(docs).collect()), key=str)
    assert got == sorted([(1, "en"), (1, "en"), (None, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "en")], key=str)


def test_toxicity(spark):
    from inkframe.llm.toxicity import toxicity

    rng = random.Random(6)
    plain = ["".join(rng.choice(["the", "er", "ing", "on", "an", "re"]) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    bad = ["idiot", "moron", "loweibar", "loweiung", "loweisch"]
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 5 == 1)
        w = [rng.choice(plain) for _ in range(rng.choice([6, 40]))]
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    rows += [(1000, None), (1001, ""), (1002, "the i d i o t here"), (1003, "the ingan onre"), (1004, "the loweifoo")]
    found = {r["doc_id"]: r for r in toxicity(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(found[i]["predicted"] == labels[i][2] for i in held) >= 0.97 * len(held)
    assert [found[i]["predicted"] for i in (1000, 1001, 1002, 1003, 1004)] == [0, 0, 1, 0, 1]
    assert all(found[i]["held_out"] for i in held)


def test_mixing(spark):
    from inkframe.llm.mixing import apply_mix, plan_mix

    rows = [(i, "a b c d " * 5, "en", "big" if i % 10 else f"small{i % 3}", 1, "x", "y") for i in range(400)] + [(900, None, "en", None, 0, "x", "y"), (901, "", "en", "big", 0, "x", "y")]
    docs = spark.createDataFrame(rows, KIND)
    plan = plan_mix(docs, entropy=1.0, repeats=3.0, keep_all=True, block_tokens=500).collect()
    assert len(plan) == len(rows) and min(r["copies"] for r in plan) >= 1
    by = {}
    for r in plan:
        by.setdefault(r["source"], []).append(r["copies"])
    big, small = np.mean(by["big"]), np.mean(by["small0"])
    assert big == 1 and 2.7 <= small <= 3.0
    budget = plan_mix(docs, entropy=1.0, budget_tokens=4000, block_tokens=500)
    used = budget.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("t")).collect()
    assert all(abs(r["t"] - 1000) <= 20 for r in used if r["source"] is not None)
    assert abs(sum(r["t"] for r in used) - 4000) <= 80
    kept = plan_mix(docs, entropy=0.0, block_tokens=500)
    assert {r["copies"] for r in kept.collect()} == {1}
    assert apply_mix(docs, plan_mix(docs, entropy=1.0, repeats=3.0, keep_all=True)).columns == docs.columns
    assert plan_mix(docs.limit(0), entropy=0.9, repeats=2.0).count() == 0


def test_license_scan(spark):
    from inkframe.llm.license_scan import TEMPLATES, license_scan

    rows = [("a/LICENSE", "x\n" + TEMPLATES["MIT"]), ("a/b/one.txt", "prose of the day"), ("a/b/c/LICENSE", TEMPLATES["GPL-3.0"]), ("a/b/c/d/two.txt", None), ("a/b/c/three.txt", "Licensed under the Apache License, Version 2.0\nmore"), ("z/four.txt", ""), (None, "All rights reserved."), ("z/four.txt", "")]
    rows += [(f"n/{i}.txt", f"word{i} the of and under license plate") for i in range(40)]
    got = license_scan(spark.createDataFrame([(p, t, 1, "mine") for p, t in rows], "path string, text string, row int, depth string"))
    found = {}
    for r in got.collect():
        found.setdefault(r["path"], []).append((r["own_license"], r["license"], r["inherited_from"], r["depth"]))
    assert found["a/b/one.txt"] == [(None, "MIT", "a", 1)]
    assert found["a/b/c/d/two.txt"] == [(None, "GPL-3.0", "a/b/c", 3)]
    assert found["a/b/c/three.txt"] == [("Apache-2.0", "Apache-2.0", None, None)]
    assert found["z/four.txt"] == [(None, None, None, None)] * 2
    assert found[None] == [("Proprietary", "Proprietary", None, None)]
    assert all(found[f"n/{i}.txt"] == [(None, None, None, None)] for i in range(40))
    assert license_scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_license_headers(spark):
    from inkframe.llm.license_scan import license_scan

    want = {
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including": "MIT",
        "// SPDX-License-Identifier: MIT": "MIT",
        "The MIT License (MIT)": "MIT",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.": "GPL-2.0",
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "LGPL-3.0",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this": "ISC",
        "Boost Software License - Version 1.0": "BSL-1.0",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under the Eclipse Public License, version 2.0.": "EPL-2.0",
        "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "Licensed under the Foo License, Version 2.0.": None,
        "Licensed under CC BY-SA 3.0.": None,
        "SPDX-License-Identifier: Foo-1.0": None,
        "License": None,
    }
    rows = [(f"x/{i}.txt", "some line\n" + t, t) for i, t in enumerate(want)] + [(f"n/{i}.txt", f"word{i} of the", "") for i in range(40)]
    got = {r["t"]: r["own_license"] for r in license_scan(spark.createDataFrame(rows, "path string, text string, t string")).collect() if r["t"]}
    assert got == want


def test_license_windows(spark):
    from inkframe.llm.license_scan import license_scan

    prose = "quite many other words stand in one long paragraph here and go on for a while, "
    rows = [
        ("a.txt", "Some project by Jane Doe. Released under the MIT License.", "MIT"),
        ("b.txt", prose * 20 + "Licensed under the Apache License, Version 2.0. " + prose * 20, "Apache-2.0"),
        ("c.txt", "Copyright (c) 2020 Foo Inc. All rights reserved.", "Proprietary"),
        ("d.py", "# x\n# This program is free software: you can redistribute it\n# and/or modify it under the terms of the GNU General Public License\n# as published by the Free Software Foundation, either version 3\n# of the License, or (at your option) any later version.\nx = 1", "GPL-3.0"),
        ("e.c", "/* Released under\n * the MIT\n * License. */ int x;", "MIT"),
        ("f.txt", "Copyright (c) 2020 Foo Inc. All rights reserved. " + prose + " Released under the MIT License.", "MIT"),
        ("g.txt", prose + "the table is reserved for the license of all rights", None),
        ("g.txt", prose + "the table is reserved for the license of all rights", None),
    ]
    rows += [(f"n/{i}.txt", f"word{i} of the", None) for i in range(40)]
    got = [(r["path"], r["own_license"]) for r in license_scan(spark.createDataFrame(rows, "path string, text string, t string")).collect()]
    assert sorted(got, key=str) == sorted([(p, t) for p, _, t in rows], key=str)


def test_license_at_the_root(spark):
    from inkframe.llm.license_scan import license_scan

    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("src/x.py", "x"), ("a/b/y.py", None), ("z.py", ""), ("sub/LICENSE", gpl), ("sub/z.py", ""), ("/abs/x.py", ""), ("/opt/LICENSE", gpl), ("/opt/y.py", "")]
    got = {r["path"]: (r["license"], r["inherited_from"], r["depth"]) for r in license_scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["src/x.py"] == got["a/b/y.py"] == got["z.py"] == ("MIT", "", 0)
    assert got["sub/z.py"] == ("GPL-3.0", "sub", 1)
    assert got["/abs/x.py"] == (None, None, None)
    assert got["/opt/y.py"] == ("GPL-3.0", "/opt", 2)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(8)
    text = lambda: " ".join(rng.choice(WORDS) + rng.choice(["ing", "the", "er"]) for _ in range(60))
    rows = [(i, text(), "en", f"s{i % 4}", 1) for i in range(60)]
    leak = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows += [(100, rows[0][1], "en", "s1", 1), (101, rows[1][1] + " extra", "en", "s1", 1), (102, text() + " " + leak, "en", "s2", 1), (103, None, "en", "s1", 0), (104, "12 34 --", "en", "s1", 0)]
    at = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    cols, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, at)
        out.write.parquet(f"{at}/out-{name}")
        docs = spark.read.parquet(f"{at}/out-{name}")
        seen[name] = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        assert name == "tokens" or docs.columns == cols
    assert set(seen["language"]) == {r[0] for r in rows} - {103, 104}
    assert seen["near_duplicates"] == [*range(60), 102]
    assert seen["leaks"] == [*range(60)]
    assert set(seen["mixing"]) == set(range(60)) and len(seen["tokens"]) == len(seen["mixing"])


@pytest.mark.parametrize("kind", ["none", "odd"])
def test_pipeline_of_odd_tables(spark, tmp_path, kind):
    """No documents, or null and repeated ids, null and empty texts, null sources; an empty benchmark."""
    import corpus_pipeline as cp

    rng = random.Random(11)
    a, b, c, d = (" ".join(rng.choice(WORDS) + rng.choice(["ing", "the", "er"]) for _ in range(40)) for _ in range(4))
    rows = [(None, a), (None, a), (None, b), (5, c), (5, c), (5, d), (6, None), (7, ""), (8, c)] if kind == "odd" else []
    at = str(tmp_path)
    spark.createDataFrame([(i, t, "en", None if i == 8 else "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{at}/documents.parquet"), {}
    for name, stage in cp.STAGES[:-1]:
        stage(spark, docs, at).write.parquet(f"{at}/out-{name}")
        docs = spark.read.parquet(f"{at}/out-{name}")
        seen[name] = sorted({(r["doc_id"], r["text"]) for r in docs.collect()}, key=str)
    want = sorted({r for r in rows if r[1]}, key=str)
    assert seen["language"] == want
    assert seen["near_duplicates"] == seen["leaks"] == seen["mixing"] == [r for r in want if r[0] != 8]
    tokens = cp.tokens(spark, docs, at).collect()
    assert len(tokens) == docs.count() and all(r["n_tokens"] > 1 for r in tokens)


def test_long_texts(spark):
    """Texts of some MB, alone in a slice and longer than a segment, through the operators that cut them."""
    from tokenizers import Tokenizer

    from inkframe.llm.suffix_dedup import repeated_strings
    from inkframe.llm.token_counts import token_counts
    from inkframe.llm.token_store import token_store

    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    long_one = " ".join(rng.choice(words) for _ in range(350_000))
    part = long_one[700_000:700_700]
    docs = docs_of(spark, [(1, long_one), (2, part)])
    got = {r["doc_id"]: r for r in repeated_strings(docs, batches=1).collect()}
    assert got[1]["n_removed"] == got[2]["n_removed"] == len(part) and got[1]["n_spans"] == 1 and got[1]["spans"] == [700_000, 700_700]
    for name, made in (("word_bpe_49k.json", token_counts), ("byte_bpe_50k.json", token_store)):
        path = public_tokenizers.path(name)
        n = len(Tokenizer.from_file(path).encode(long_one, add_special_tokens=False).ids)
        assert made(docs, path).where("doc_id = 1").first()["n_tokens"] == n + (made is token_store)
