"""Full-text search for a batch of queries in one job.

Texts are tokens by position. A query is a set of phrases: each content token (its last term a prefix) and the whole query
(exact). Phrases meet postings by equi-joins: exact terms by the term, prefixes by (length, leading characters). From the
matches come term frequencies, document frequencies and BM25 with a phrase counted as often as the expression
(whole) OR (all tokens) OR (any token) names it in each of the two columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import clean_text, let, query_tokens, to_unsigned

K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
#: Up to so many terms and prefixes of a batch of queries are filtered by name.
MOST_LISTED = 400
#: Up to so many terms and prefixes of a batch of queries are broadcast to postings that no written index holds.
MOST_BROADCAST = 20_000
#: Up to so many candidates of a batch of queries are broadcast to the records (some 40 MB); those of a larger batch meet them by an exchange of both.
MOST_CANDIDATES = 1_000_000


def _fold() -> tuple[str, str]:
    """What lower case still has to become in an index term, and what of it vanishes: letters of Latin scripts that are a plain letter with a single mark,
    letters whose case-folded form is another letter, and the marks themselves, which last as they have nothing to become."""
    import unicodedata

    marked, marks = {}, set()
    for code in [*range(0x80, 0x250), *range(0x370, 0x400), *range(0x1E00, 0x1F00)]:
        c = chr(code).lower()
        parts = unicodedata.normalize("NFD", c)
        if len(c) == 1 and len(parts) == 2 and parts[0].isascii() and parts[0].isalpha():
            marked[c] = parts[0]
            marks.add(parts[1])
        elif len(c.casefold()) == 1 and c.casefold() != c:
            marked[c] = c.casefold()
    return "".join(marked) + "".join(sorted(marks)), "".join(marked.values())


FOLDED, BASE = _fold()


def terms(c: Column) -> Column:
    """Lower-cased runs of letters and digits; letters with one mark lose it, and marks that such letters have vanish, also from other letters.

    As the index engine has it from U+0080 to U+2FFF, but for letters younger than its tables (Unicode 6.1, among them lower-case Cherokee) and
    characters that those tables do not know, which the engine takes for letters and this function for gaps.
    """
    # ASCII has nothing to fold
    folded = let(F.lower(F.coalesce(c, F.lit(""))), lambda low: F.when(F.octet_length(low) == F.char_length(low), low).otherwise(F.translate(low, FOLDED, BASE)))
    return F.filter(F.split(folded, r"[^\p{L}\p{N}\p{Co}]+"), lambda t: t != "")


def postings(records: DataFrame) -> DataFrame:
    """(id, col, pos, term) of the columns text and text_unsigned."""
    one = records.select("id", F.lit("text").alias("col"), F.posexplode(terms(F.col("text"))).alias("pos", "term"))
    two = records.select("id", F.lit("text_unsigned").alias("col"), F.posexplode(terms(F.col("text_unsigned"))).alias("pos", "term"))
    return one.unionByName(two)


def phrases(queries: DataFrame) -> DataFrame:
    """queries (qid, query) -> (qid, tok, terms, size): tok -1 is the whole query, others are content tokens."""
    q = queries.select("qid", to_unsigned(clean_text(F.col("query"))).alias("u"))
    whole = q.select("qid", F.lit(-1).alias("tok"), terms(F.col("u")).alias("terms"))
    parts = q.select("qid", F.posexplode(query_tokens(F.col("u"))).alias("tok", "t")).select("qid", "tok", terms(F.regexp_replace("t", '"', "")).alias("terms"))
    return whole.unionByName(parts).withColumn("size", F.size("terms"))


def _occurrences(p: DataFrame, index: DataFrame) -> DataFrame:
    """tf of each phrase in each (id, col)."""
    steps = p.where("size > 0").select("qid", "tok", "size", F.posexplode("terms").alias("k", "want"))
    steps = steps.withColumn("prefix", (F.col("tok") >= 0) & (F.col("k") == F.col("size") - 1))
    n_steps = {r["prefix"]: r["count"] for r in steps.groupBy("prefix").count().collect()}
    # the steps of a batch are brought to the postings, as a frequent term's postings would all come to one task
    few = sum(n_steps.values()) <= MOST_BROADCAST
    exact = steps.where("not prefix").withColumnRenamed("want", "term")
    found = [index.join(F.broadcast(exact) if few else exact, "term")]
    if n_steps.get(True):
        heads = steps.where("prefix").withColumn("length", F.length("want"))
        if few:
            lengths = F.array(*[F.lit(r["length"]) for r in heads.select("length").distinct().collect()])
            cut = index.withColumn("length", F.explode(F.filter(lengths, lambda n: n <= F.length("term")))).withColumn("want", F.expr("substr(term, 1, length)"))
            found.append(cut.join(F.broadcast(heads), ["length", "want"]))
        else:
            # the vocabulary is matched first, by its leading characters at the lengths that occur
            lengths = heads.select("length").distinct()
            vocabulary = index.select("term").distinct().join(F.broadcast(lengths), F.length("term") >= F.col("length")).withColumn("want", F.expr("substr(term, 1, length)"))
            found.append(index.join(vocabulary.join(heads, ["length", "want"]).drop("length", "want"), "term"))
    # a phrase of one term needs no places
    met = [f.select("qid", "tok", "size", "id", "col", F.when(F.col("size") > 1, F.col("pos") - F.col("k")).otherwise(-1).alias("at")) for f in found]
    met = met[0] if len(met) == 1 else met[0].unionByName(met[1])
    starts = met.groupBy("qid", "tok", "size", "id", "col", "at").agg(F.count("*").alias("n")).where("size = 1 or n = size")
    return starts.groupBy("qid", "tok", "id", "col").agg(F.sum(F.when(F.col("size") == 1, F.col("n")).otherwise(1)).alias("tf"))


def asked_postings(index: DataFrame, p: DataFrame) -> DataFrame:
    """The postings whose terms the phrases ask for. With few terms asked, as a filter that reaches the scan of a written
    index, which is sorted by term; else the joins have to find them."""
    steps = p.select("tok", "size", F.posexplode("terms").alias("k", "want"))
    asked = steps.select("want", ((F.col("tok") >= 0) & (F.col("k") == F.col("size") - 1)).alias("prefix")).distinct().limit(MOST_LISTED + 1).collect()
    if len(asked) > MOST_LISTED:
        return index
    exact, heads = ([r["want"] for r in asked if r["prefix"] == b] for b in (False, True))
    wanted = F.col("term").isin(exact)
    for h in heads:
        wanted = wanted | F.col("term").startswith(h)
    return index.where(wanted)


def _part(n_rows: Column, mean: Column) -> Column:
    """What a phrase adds to the score of a record, from the columns tf, df and d."""
    idf = F.log((n_rows - F.col("df") + 0.5) / (F.col("df") + 0.5))
    idf = F.when(idf <= 0, LEAST_IDF).otherwise(idf)
    return idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("d") / mean))


def _indexed_bm25(p: DataFrame, index) -> DataFrame:
    """bm25 over the segments of an index. The phrases of a batch come to the driver, which numbers them; matches are scored where their record is."""
    spark = p.sparkSession
    listed = [r.asDict() | {"ph": i} for i, r in enumerate(p.where("size > 0").collect())]
    tokens = {r["qid"]: r["n"] for r in p.where("tok >= 0").groupBy("qid").agg(F.count("*").alias("n")).collect()}
    asked = [(r["ph"], r["qid"], r["tok"] < 0, tokens[r["qid"]]) for r in listed if r["qid"] in tokens]
    kind = p.schema["qid"].dataType.simpleString()
    named = F.broadcast(spark.createDataFrame(asked, f"ph int, qid {kind}, entire boolean, n_tokens bigint"))  # a row a phrase of the batch
    if not asked or not index.segments:
        return spark.createDataFrame([], f"qid {kind}, id bigint, bm25 double")
    tf, (n_rows, mean) = index.matches(listed), index.sizes()
    df = F.broadcast(tf.groupBy("ph", "col").agg(F.count("*").alias("df")))  # two rows a phrase
    rows = tf.join(df, ["ph", "col"]).join(named, "ph").withColumn("part", _part(F.lit(n_rows), F.lit(float(mean))))
    score = F.lit(0.0)
    sums = []
    for c in ("text", "text_unsigned"):
        here, entire = F.col("col") == c, F.col("entire")
        sums += [F.sum(F.when(here & entire, F.col("part")).otherwise(0.0)).alias(f"whole_{c}"), F.sum(F.when(here & ~entire, F.col("part")).otherwise(0.0)).alias(f"any_{c}"), F.count_if(here & ~entire).alias(f"hit_{c}")]
        score = score + F.col(f"whole_{c}") + F.col(f"any_{c}") * F.when(F.col(f"hit_{c}") == F.col("n_tokens"), 2).otherwise(1)
    return rows.groupBy("block", "qid", "id", "n_tokens").agg(*sums).select("qid", "id", (-score).alias("bm25"))


def bm25(records: DataFrame, queries: DataFrame, index=None, sizes: DataFrame | None = None) -> DataFrame:
    """(qid, id, bm25) of every record that has a content token of the query; less is better, as the index engine has it.

    index holds the postings of records, sizes (id, d) their lengths; give the tables of a written index where many batches are asked, or better the
    segments of one (sources.segments.TermIndex).
    """
    p = phrases(queries)
    if hasattr(index, "matches"):
        return _indexed_bm25(p, index)
    index = postings(records) if index is None else index
    sizes = index.groupBy("id").agg(F.count("*").alias("d")) if sizes is None else sizes
    tf = _occurrences(p, asked_postings(index, p)).join(sizes, "id")
    told = records.select("id").join(sizes, "id", "left").agg(F.count("*").alias("n_rows"), (F.sum(F.coalesce("d", F.lit(0))) / F.count("*")).alias("mean")).first()
    stats = [F.lit(told["n_rows"]).alias("n_rows"), F.lit(float(told["mean"] or 0.0)).alias("mean")]
    tokens = p.where("tok >= 0").groupBy("qid").agg(F.count("*").alias("n_tokens"))
    df = tf.groupBy("qid", "tok", "col").agg(F.count("*").alias("df"))  # a row per phrase and column
    rows = tf.join(df, ["qid", "tok", "col"]).select("*", *stats).join(tokens, "qid")
    rows = rows.withColumn("part", _part(F.col("n_rows"), F.col("mean")))
    per = rows.groupBy("qid", "id", "col", "n_tokens").agg(F.count_if(F.col("tok") >= 0).alias("hit"), F.coalesce(F.sum(F.when(F.col("tok") >= 0, F.col("part"))), F.lit(0.0)).alias("any"), F.coalesce(F.sum(F.when(F.col("tok") < 0, F.col("part"))), F.lit(0.0)).alias("whole"))
    per = per.withColumn("score", F.col("whole") + F.col("any") * F.when(F.col("hit") == F.col("n_tokens"), 2).otherwise(1))
    return per.groupBy("qid", "id").agg((-F.sum("score")).alias("bm25"))


def relevance(bm25_score: Column, confidence: Column, contained: Column) -> Column:
    """0.7 / (1 + |bm25|) + 0.3 confidence, and 0.5 more for a record that holds the whole query."""
    return 0.7 / (1 + F.abs(bm25_score)) + 0.3 * confidence + F.when(contained, 0.5).otherwise(0.0)


def told_apart(score: Column) -> Column:
    """A score to ten significant digits: scores that differ only by the order in which their parts were added are equal, whatever their size."""
    return F.format_string("%.9e", score).cast("double")


def _best(found: DataFrame, top_k: int) -> DataFrame:
    """The best 2 top_k of each query's by bm25 (qid, id, bm25, confidence), with their places _c."""
    best = (told_apart(F.col("bm25")), F.col("confidence").desc(), F.col("id"))
    return found.withColumn("_c", F.row_number().over(Window.partitionBy("qid").orderBy(*best))).where(F.col("_c") <= 2 * top_k)


def _has(entity_type: str | None) -> Column:
    return F.lit(True) if entity_type is None else F.exists("entities", lambda e: F.upper(e.type) == entity_type.upper())


def _ranked(best: DataFrame, queries: DataFrame, top_k: int, entity_type: str | None) -> DataFrame:
    """Hits from the best candidates, with the columns of records: those with the entity type, the best of each frame, and the first top_k by relevance."""
    found = best.where(_has(entity_type))
    found = found.withColumn("_f", F.row_number().over(Window.partitionBy("qid", "video_id", "frame_idx").orderBy("_c"))).where("_f = 1")
    found = found.withColumn("_k", F.row_number().over(Window.partitionBy("qid").orderBy("_c"))).where(F.col("_k") <= top_k)
    wanted = queries.select("qid", to_unsigned(clean_text(F.col("query"))).alias("_u"))
    found = found.join(wanted, "qid").withColumn("score", F.round(relevance(F.col("bm25"), F.col("confidence"), F.col("text_unsigned").contains(F.col("_u"))), 4))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "_c")))
    return found.drop("_c", "_f", "_k", "_u")


def _asked_of(records: DataFrame, min_confidence: float, video_id: str | None) -> DataFrame:
    rows = records.where(F.col("confidence") >= min_confidence)
    return rows if video_id is None else rows.where(F.col("video_id") == video_id)


def search(records: DataFrame, queries: DataFrame, top_k: int = 100, video_id: str | None = None, entity_type: str | None = None, min_confidence: float = 0.30, entity_first: bool = False, index=None, sizes: DataFrame | None = None, substrings: bool = False) -> DataFrame:
    """Ranked hits of each query (qid, query) in records (id, video_id, frame_idx, text, text_unsigned, confidence, entities).

    Candidates are the best 2 top_k by BM25 among rows of enough confidence (and of the video); then the entity type is
    asked for, the best row of each frame stays, and the first top_k are ranked by relevance. entity_first asks for the
    entity before candidates are cut. substrings: without an index, as like_search does.
    """
    if substrings:
        return like_search(records, queries, top_k, video_id, entity_type, min_confidence, entity_first)
    slim = _asked_of(records, min_confidence, video_id)
    slim = (slim.where(_has(entity_type)) if entity_first else slim).select("id", "confidence")
    # candidates are cut before they get their texts, and brought to them, as all texts would be exchanged for a few hits
    best = _best(bm25(records, queries, index, sizes).join(slim, "id"), top_k).drop("confidence")
    best = F.broadcast(best) if 2 * top_k * queries.count() <= MOST_CANDIDATES else best
    return _ranked(records.join(best, "id"), queries, top_k, entity_type)


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def like_search(records: DataFrame, queries: DataFrame, top_k: int = 100, video_id: str | None = None, entity_type: str | None = None, min_confidence: float = 0.30, entity_first: bool = False) -> DataFrame:
    """The fallback where there is no index: records whose search form holds the query's, or whose text holds its clean text, ranked as those of
    search with a BM25 of 1. % and _ in a query stand for any characters and for one; of letters only those of ASCII match in either
    case. Queries of white space alone find nothing. All records are read once for a batch, of at most MOST_LISTED queries.
    """
    asked = queries.select("qid", clean_text(F.col("query")).alias("clean")).select("qid", "clean", to_unsigned(F.col("clean")).alias("u")).where("u <> ''").limit(MOST_LISTED + 1).collect()
    if len(asked) > MOST_LISTED:
        raise ValueError(f"a batch without an index has at most {MOST_LISTED} queries")
    low = lambda c: F.translate(c, CAPITALS, SMALL)
    rows = _asked_of(records, min_confidence, video_id).withColumns({"_t": low(F.col("text")), "_s": low(F.col("text_unsigned"))})
    kind = queries.schema["qid"].dataType
    # clean texts have no control characters, so that one can stand for the escape character of patterns
    like = lambda c, q: F.coalesce(F.like(c, low(F.lit(f"%{q}%")), F.lit("\x01")), F.lit(False))
    met = [F.when(like("_s", r["u"]) | like("_t", r["clean"]), F.lit(r["qid"]).cast(kind)) for r in asked]
    none = F.array().cast(f"array<{kind.simpleString()}>")
    found = rows.select("*", F.explode(F.array_compact(F.array(*met)) if met else none).alias("qid")).drop("_t", "_s").withColumn("bm25", F.lit(1.0))
    return _ranked(_best(found.where(_has(entity_type)) if entity_first else found, top_k), queries, top_k, entity_type)


def keyword_counts(records: DataFrame, words: list[str]) -> DataFrame:
    """How many records hold each word as part of their text, whatever its case."""
    held = [F.count_if(F.lower("text").contains(w.lower())).alias(w) for w in words]
    return records.agg(*held).unpivot([], words, "word", "n")


def match_counts(index: DataFrame, texts: list[str], column: str = "text") -> DataFrame:
    """How many records hold each text as a phrase of index terms in a column: text, n. A text without terms matches nothing."""
    spark = index.sparkSession
    asked = spark.createDataFrame([(t,) for t in texts], "qid string").withColumn("terms", terms(F.col("qid"))).select("qid", F.lit(-1).alias("tok"), "terms", F.size("terms").alias("size"))
    tf = _occurrences(asked, asked_postings(index.where(F.col("col") == column), asked))
    counts = tf.groupBy("qid").agg(F.count("*").alias("n"))
    return asked.join(counts, "qid", "left").select(F.col("qid").alias("text"), F.coalesce("n", F.lit(0)).alias("n"))


def payloads(hits: DataFrame) -> DataFrame:
    """Answer strings of hits: a frame, a frame with an answer, and a moment."""
    frame = F.concat_ws(", ", "video_id", F.col("frame_idx").cast("string"))
    answer = F.coalesce(F.get("entities", F.lit(0)).value, F.col("text"))
    return hits.withColumns({"submission_kis": frame, "submission_qa": F.concat_ws(", ", frame, answer), "submission_trake": frame})


def compact(hits: DataFrame) -> DataFrame:
    """The columns of a hit that tools return, after qid and rank; without a time stamp or boxes these are null."""
    have = set(hits.columns)
    stamp = F.col("timestamp_str") if "timestamp_str" in have else F.lit(None).cast("string")
    edges = ["bbox_ymin", "bbox_xmin", "bbox_ymax", "bbox_xmax"]
    box = F.col("bbox_norm") if "bbox_norm" in have else F.array(*edges) if have.issuperset(edges) else F.lit(None).cast("array<double>")
    return hits.select("qid", "rank", "video_id", "frame_idx", stamp.alias("timestamp_str"), F.col("text").alias("detected_text"), "confidence", box.alias("bbox_norm"), "entities", "submission_kis", "submission_qa")


def result_table(hits: DataFrame, most: int = 20, width: int = 23) -> DataFrame:
    """What a console shows of the first hits: long texts cut."""
    text = F.when(F.length("text") > width, F.concat(F.substring("text", 1, width), F.lit("..."))).otherwise(F.col("text"))
    return hits.where(F.col("rank") <= most).select("qid", "rank", "video_id", "frame_idx", text.alias("text"), "score")


def fuzzy_terms(index: DataFrame, words: list[str], most: int = 2) -> DataFrame:
    """Terms of an index within an edit distance of words: word, term, distance, n (records that hold the term)."""
    df = index.groupBy("term").agg(F.count_distinct("id").alias("n"))
    wanted = F.explode(F.array(*[F.lit(w) for w in words])).alias("word")
    near = df.select("term", "n", wanted).where(F.abs(F.length("term") - F.length("word")) <= most)
    return near.withColumn("distance", F.levenshtein("word", "term", most)).where("distance >= 0").select("word", "term", "distance", "n")


def parse_query(line: str) -> dict:
    """`words --video ID --entity TYPE` as the arguments of search."""
    head, *options = line.split("--")
    out = {"query": head.strip(), "video_id": None, "entity_type": None}
    for option in options:
        name, _, value = option.strip().partition(" ")
        if name in ("video", "entity") and value.strip():
            out["video_id" if name == "video" else "entity_type"] = value.strip()
    return out
