"""Registered queries over the driver's tables, each with the SQL that gives the same rows.

Conversations stand in for videos (a turn is a frame 75 apart), documents for a search corpus, events for a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import spatial as G, text as X
from .operators import documents as D, evaluate as E, frames as P, packaging as K, search as Q, tracks as R
from .plans import vision as V
from .ship import ensure_shipped

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_shipped(spark)
            return f(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(spark, name: str, texts: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), f"k int, {name} string")


def _sql_values(name: str, texts: list[str]) -> str:
    return f"(VALUES {', '.join(f'({i}, {_quoted(t)})' for i, t in enumerate(texts))}) v(k, {name})"


SIGNS = ["Cơm Tấm Ba Ghiền", "Phở Bò Tái Nạm 45k", "Đường Nguyễn Trãi Quận 5", "Hội thi AI Challenge TP.HCM 2026", "Quán cơm tấm 45k, trà đá 5.000đ, lẩu cá 150 nghìn", "Xe máy biển số 59-X3 123.45 và ô tô 51F-9999", "Liên hệ hotline: 0901234567 hoặc 02838354409", "Mở cửa 7h30 đến 21:15:00", "", "  CÀ PHÊ  ñandú  ", "Cà phê Đá 12.5 tr"]
SQL_CLEAN = "trim(regexp_replace(regexp_replace(trim(nfc_normalize({0}), ' \t\n\r\f\x0b'), '[\\x00-\\x1f\\x7f-\\x{{9f}}]', '', 'g'), '\\s+', ' ', 'g'))"
SQL_PLAIN = "trim(lower(translate({0}, " + _quoted(X.MARKED) + ", " + _quoted(X.PLAIN) + ")))"


def _clean_sql(c: str) -> str:
    return SQL_CLEAN.format(c)


def _plain_sql(c: str) -> str:
    return SQL_PLAIN.format(c)


@query(f"SELECT doc_id, {_clean_sql('text')} AS clean, {_plain_sql(_clean_sql('text'))} AS search_form FROM documents")
def text_unsigned(spark, t):
    """T1-T3 over whole documents."""
    rows = t("documents").select("doc_id", X.clean_text(F.col("text")).alias("clean"))
    return rows.select("doc_id", "clean", X.unsigned_of_clean(F.col("clean")).alias("search_form"))


@query(f"SELECT k, {_plain_sql('nfc_normalize(s)')} AS unsigned_form, length(regexp_replace(lower(s), '[^{X.LOWER_MARKED}]', '', 'g')) AS marks, length(regexp_replace(lower(s), '[^{X.LOWER_MARKED}]', '', 'g')) > 0 AS vietnamese FROM (SELECT CAST(doc_id AS VARCHAR) AS k, text AS s FROM documents UNION ALL SELECT 'sign' || k, s FROM {_sql_values('s', SIGNS)})")
def vietnamese_forms_documents(spark, t):
    """T2, M8, T18 on whole documents and signs."""
    rows = _documents_and_signs(spark, t, F.col("text"))
    return rows.select("k", X.to_unsigned(F.col("s")).alias("unsigned_form"), X.diacritics(F.col("s")).cast("bigint").alias("marks"), X.is_vietnamese(F.col("s")).alias("vietnamese"))


def _documents_and_signs(spark, t, text) -> DataFrame:
    return t("documents").select(F.col("doc_id").cast("string").alias("k"), text.alias("s")).unionByName(_values(spark, "s", SIGNS).select(F.concat(F.lit("sign"), "k").alias("k"), "s"))


#: The entity patterns where both edges of each run of word characters are marked by the characters 1 and 2, as SQL has no look-around.
_MARK = "\\x01\\x02"
_SQL_PATTERNS = {
    "PRICE": rf"(?i)\x02(\p{{Nd}}+(?:{_MARK}[.,]{_MARK}\p{{Nd}}+)?(?:{_MARK} +{_MARK})?(?:k|vnđ|vnd|đ|nghìn|ngàn|triệu|tr))\x01",
    "LICENSE_PLATE": rf"(?i)\x02([0-9]{{2}}(?:{_MARK}[- ]{_MARK})?[A-Z]{{1,2}}[0-9]?(?:{_MARK}[- ]{_MARK})?[0-9]{{3,5}}(?:{_MARK}\.{_MARK}[0-9]{{2}})?)\x01",
    "PHONE_NUMBER": rf"\x02((?:0|\+{_MARK}84)[235789][0-9]{{8}})\x01",
    "TIME": rf"(?i)\x02([0-2]?[0-9](?:h|{_MARK}:{_MARK})[0-5][0-9](?:{_MARK}:{_MARK}[0-5][0-9])?)\x01",
    "NUMBER": rf"\x02(\p{{Nd}}+(?:{_MARK}\.{_MARK}\p{{Nd}}+)?)\x01",
}


def _entities_sql(texts: str) -> str:
    """CTEs ending in e(rid, k, o, i, type, value, piece): entities of texts (k, s), and how many characters lie between one and the next."""
    bare = "translate({0}, chr(1) || chr(2), '')"
    kinds = " UNION ALL ".join(
        f"SELECT rid, k, {o} AS o, '{kind}' AS type, [{bare.format('upper(x)' if kind == 'LICENSE_PLATE' else 'x')} FOR x IN regexp_extract_all(m, '{p}', 1)] AS v, [length({bare.format('x')}) FOR x IN string_split_regex(m, '{p}')] AS pieces FROM marked"
        for o, (kind, p) in enumerate(_SQL_PATTERNS.items())
    )
    return rf"""WITH texts AS ({texts}),
marked AS (SELECT row_number() OVER () AS rid, k, regexp_replace(s, '([\p{{L}}\p{{N}}_]+)', chr(1) || chr(2) || '\1' || chr(1) || chr(2), 'g') AS m FROM texts), kinds AS ({kinds}),
e AS (SELECT rid, k, o, type, generate_subscripts(v, 1) AS i, unnest(v) AS value, unnest(pieces[1:len(v)]) AS piece FROM kinds WHERE len(v) > 0)"""


_DOCUMENT_ENTITIES_SQL = _entities_sql(f"SELECT CAST(doc_id AS VARCHAR) AS k, {_clean_sql('text')} AS s FROM documents")
_SPANS_SQL = """, placed AS (SELECT rid, k, o, i, type, value, sum(piece + coalesce(gone, 0)) OVER (PARTITION BY rid, o ORDER BY i) AS start FROM (SELECT *, lag(length(value)) OVER (PARTITION BY rid, o ORDER BY i) AS gone FROM e))
SELECT k, CAST(row_number() OVER (PARTITION BY rid ORDER BY o, i) - 1 AS INTEGER) AS pos, type, value, CAST(start AS INTEGER) AS start, CAST(start + length(value) AS INTEGER) AS "end" FROM placed"""
_SIGNS_SQL = f" UNION ALL SELECT 'sign' || k, s FROM {_sql_values('s', SIGNS)}"


@query(_entities_sql(f"SELECT CAST(doc_id AS VARCHAR) AS k, {_clean_sql('text')} AS s FROM documents{_SIGNS_SQL}") + _SPANS_SQL)
def entity_spans(spark, t):
    """T4-T9 with spans, over documents and signs."""
    rows = _documents_and_signs(spark, t, X.clean_text(F.col("text")))
    return rows.select("k", F.posexplode(X.extract_entities(F.col("s"))).alias("pos", "e")).select("k", "pos", "e.type", "e.value", F.col("e.span.start").alias("start"), F.col("e.span.end").alias("end"))


@query(_entities_sql(f"SELECT CAST(doc_id AS VARCHAR) AS k, {_clean_sql('text')} AS s FROM documents{_SIGNS_SQL}") + " SELECT type, count(*) AS n, count(DISTINCT value) AS n_values FROM e GROUP BY type")
def entity_counts(spark, t):
    """Entities of documents and signs by type."""
    rows = _documents_and_signs(spark, t, X.clean_text(F.col("text"))).select(F.lit("v").alias("video_id"), F.col("k").alias("frame_idx"), F.lit("").alias("timestamp_str"), F.col("k").alias("id"), X.entity_values(F.col("s")).alias("entities"))
    return D.entity_counts(rows)


@query(_DOCUMENT_ENTITIES_SQL + _SPANS_SQL)
def lateral_entities(spark, t):
    """T4-T9 in SQL alone: a table function joined laterally to the cleaned texts. Entities have digits; texts without one, or without a character that the JVM's
    tables do not know, need not go to Python."""
    X.register(spark)
    return spark.sql(r"SELECT CAST(d.doc_id AS STRING) AS k, e.pos, e.type, e.value, e.start, e.end FROM (SELECT * FROM (SELECT doc_id, vn_clean(text) AS s FROM {docs}) WHERE s RLIKE '[\\p{{Nd}}\\p{{Cn}}]') d, LATERAL text_entities(d.s) e", docs=t("documents"))


@query(f"SELECT source, {_plain_sql(_clean_sql('text'))} = {_plain_sql('nfc_normalize(text)')} AS same, count(*) AS n, sum(length(regexp_replace(lower(text), '[^{X.LOWER_MARKED}]', '', 'g'))) AS marks FROM (SELECT source, coalesce(text, '') AS text FROM documents) GROUP BY ALL")
def sql_functions(spark, t):
    """T1-T3, M8 in SQL alone: how many texts of each source cleaning leaves the same in search form, and their letters with marks."""
    X.register(spark)
    return spark.sql("SELECT source, vn_unsigned(vn_clean(text)) = vn_unsigned(text) AS same, count(*) AS n, sum(vn_marks(text)) AS marks FROM {docs} GROUP BY ALL", docs=t("documents"))


NAMES = ["L21_V001/keyframe_75.webp", "L21_V001_150.jpg", "frame_0150.png", "a/b/0042.webp", "cover.jpg", "Keyframe_9x8.JPG"]


_INDEX_SQL = "coalesce(try_cast(nullif(regexp_extract(regexp_replace(split_part(name, '/', -1), '\\.[^.]*$', ''), '([0-9]+)', 1), '') AS BIGINT), 0)"


@query(f"SELECT k, {_INDEX_SQL} AS frame_idx FROM (SELECT conv_id || '-' || turn AS k, 'V' || conv_id || '/keyframe_' || turn * 75 || '.webp' AS name FROM conversations UNION ALL SELECT 'name' || k, name FROM {_sql_values('name', NAMES)})")
def frame_index_turns(spark, t):
    """P1 on a name per turn of all conversations, and on NAMES."""
    rows = t("conversations").selectExpr("concat_ws('-', conv_id, turn) as k", "concat('V', conv_id, '/keyframe_', turn * 75, '.webp') as name")
    rows = rows.unionByName(_values(spark, "name", NAMES).select(F.concat(F.lit("name"), "k").alias("k"), "name"))
    return rows.select("k", P.frame_index(F.col("name")).alias("frame_idx"))


RATES = "(VALUES (0, 30.0), (1, 25.0), (2, 29.97), (3, 0.0)) f(m, fps)"
INFO_SQL = f"""
WITH frames AS (SELECT DISTINCT 'V' || conv_id AS video_id, turn * 75 + conv_id % 7 AS frame_idx, conv_id % 5 AS m, conv_id FROM conversations),
a AS (SELECT video_id, frame_idx, conv_id, coalesce(CAST(fps AS DOUBLE), 25.0) AS fps FROM frames LEFT JOIN {RATES} USING (m)),
b AS (SELECT *, CASE WHEN fps > 0 THEN round_even(frame_idx / fps, 3) ELSE 0.0 END AS timestamp FROM a),
c AS (SELECT *, CAST(floor(timestamp * 1000.0) AS BIGINT) AS timestamp_ms FROM b)
SELECT CASE WHEN frame_idx % 2 = 0 THEN 'id' || conv_id || '-' || frame_idx ELSE video_id || '_' || frame_idx END AS frame_id, video_id, frame_idx, timestamp, timestamp_ms,
 CASE WHEN timestamp_ms >= 3600000 THEN printf('%02d:%02d:%02d.%03d', timestamp_ms // 3600000, timestamp_ms // 60000 % 60, timestamp_ms // 1000 % 60, timestamp_ms % 1000)
 ELSE printf('%02d:%02d.%03d', timestamp_ms // 60000, timestamp_ms // 1000 % 60, timestamp_ms % 1000) END AS timestamp_str,
 CASE WHEN conv_id % 3 = 0 THEN '' WHEN conv_id % 3 = 1 THEN 'https://v.example/' || conv_id || '?t=' || CAST(floor(timestamp) AS BIGINT) || 's'
 ELSE 'https://v.example/w?v=' || conv_id || '&t=' || CAST(floor(timestamp) AS BIGINT) || 's' END AS youtube_url, fps FROM c"""


@query(INFO_SQL)
def frame_info(spark, t):
    """Conversations as frames, dimensions derived from them."""
    conv = t("conversations").select("conv_id", F.concat(F.lit("V"), F.col("conv_id").cast("string")).alias("video_id"), (F.col("turn") * 75 + F.col("conv_id") % 7).alias("idx")).distinct()
    rates = spark.createDataFrame([(0, 30.0), (1, 25.0), (2, 29.97), (3, 0.0)], "m long, fps double")
    fps = conv.select("video_id", (F.col("conv_id") % 5).alias("m")).distinct().join(rates, "m").drop("m")
    index = conv.where("idx % 2 = 0").select(F.concat_ws("-", F.concat(F.lit("id"), F.col("conv_id").cast("string")), F.col("idx").cast("string")).alias("frame_id"), F.concat(F.col("video_id"), F.lit("/keyframe_"), F.col("idx").cast("string"), F.lit(".webp")).alias("rel_path"))
    base = F.concat(F.lit("https://v.example/"), F.when(F.col("conv_id") % 3 == 2, "w?v=").otherwise(""), F.col("conv_id").cast("string"))
    urls = conv.where("conv_id % 3 <> 0").select("video_id", base.alias("watch_url")).distinct()
    return P.frame_info(conv.select("video_id", F.concat(F.lit("keyframe_"), F.col("idx").cast("string"), F.lit(".webp")).alias("image_name")), fps, index, urls)


BOXES = """SELECT l_orderkey, l_linenumber, (l_partkey % 50) / 100.0 AS t1, (l_suppkey % 40) / 100.0 AS l1, (l_partkey % 50) / 100.0 + 0.3 AS b1, (l_suppkey % 40) / 100.0 + 0.25 AS r1,
 (l_orderkey % 50) / 100.0 AS t2, (l_linenumber * 5 % 40) / 100.0 AS l2, (l_orderkey % 50) / 100.0 + 0.2 AS b2, (l_linenumber * 5 % 40) / 100.0 + 0.4 AS r2 FROM lineitem"""


@query(f"""WITH b AS ({BOXES.replace('/ 100.0', '/ 100.0::DOUBLE').replace('+ 0.', '+ 0.').replace('0.25 AS', '0.25::DOUBLE AS').replace('0.3 AS', '0.3::DOUBLE AS').replace('0.2 AS', '0.2::DOUBLE AS').replace('0.4 AS', '0.4::DOUBLE AS')}),
c AS (SELECT *, least(b1, b2) - greatest(t1, t2) AS h, least(r1, r2) - greatest(l1, l2) AS w FROM b)
SELECT l_orderkey, l_linenumber, round(CASE WHEN h > 0 AND w > 0 THEN h * w / ((b1 - t1) * (r1 - l1) + (b2 - t2) * (r2 - l2) - h * w) ELSE 0 END, 8) AS iou,
 round(sqrt(power((t1 + b1) / 2 - (t2 + b2) / 2, 2) + power((l1 + r1) / 2 - (l2 + r2) / 2, 2)), 8) AS distance, (t1 + b1) / 2 BETWEEN 0.2 AND 0.5021 AND (l1 + r1) / 2 BETWEEN 0.1 AND 0.4021 AS inside FROM c""")
def bbox_geometry(spark, t):
    """G1, G2, G4."""
    rows = t("lineitem").selectExpr("l_orderkey", "l_linenumber", "(l_partkey % 50) / 100D t1", "(l_suppkey % 40) / 100D l1", "(l_partkey % 50) / 100D + 0.3D b1", "(l_suppkey % 40) / 100D + 0.25D r1", "(l_orderkey % 50) / 100D t2", "(l_linenumber * 5 % 40) / 100D l2", "(l_orderkey % 50) / 100D + 0.2D b2", "(l_linenumber * 5 % 40) / 100D + 0.4D r2")
    a, b = G.box("t1", "l1", "b1", "r1"), G.box("t2", "l2", "b2", "r2")
    roi = G.box(F.lit(0.2), F.lit(0.1), F.lit(0.5021), F.lit(0.4021))
    return rows.select("l_orderkey", "l_linenumber", F.round(G.iou(a, b), 8).alias("iou"), F.round(G.center_distance(a, b), 8).alias("distance"), G.center_in(a, roi).alias("inside"))


@query("""SELECT p_partkey, CAST(a * b AS DOUBLE) AS area, least(1.0, (p_partkey % 300) / 640.0::DOUBLE) >= 0 AND a * b >= 80 AS usable,
 round_even(least(1.0, (p_partkey % 200) / 480.0::DOUBLE), 4) AS ymin, round_even(least(1.0, (p_partkey % 300) / 640.0::DOUBLE), 4) AS xmin,
 round_even(least(1.0, (p_partkey % 200 + b) / 480.0::DOUBLE), 4) AS ymax, round_even(least(1.0, (p_partkey % 300 + a) / 640.0::DOUBLE), 4) AS xmax, CAST(trunc((p_partkey % 300) / 0.75::DOUBLE) AS INT) AS x0
FROM (SELECT p_partkey, p_partkey % 37 + 1 AS a, p_size % 23 + 1 AS b FROM part)""")
def polygon_columns(spark, t):
    """Area, box and rescaling of polygons."""
    rows = t("part").selectExpr("p_partkey", "cast(p_partkey % 300 as int) x", "cast(p_partkey % 200 as int) y", "cast(p_partkey % 37 + 1 as int) a", "cast(p_size % 23 + 1 as int) b")
    rows = rows.withColumn("poly", F.expr("array(array(x, y), array(x + a, y), array(x + a, y + b), array(x, y + b))"))
    box = G.polygon_box(F.col("poly"), F.lit(640.0), F.lit(480.0))
    return rows.select("p_partkey", G.polygon_area(F.col("poly")).alias("area"), G.usable_polygon(F.col("poly")).alias("usable"), box.ymin.alias("ymin"), box.xmin.alias("xmin"), box.ymax.alias("ymax"), box.xmax.alias("xmax"), G.rescale_polygon(F.col("poly"), F.lit(0.75))[0][0].alias("x0"))


@query("""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN '59-X3' ELSE 'PHO ' || c_custkey END AS a, (c_custkey % 90) / 100.0::DOUBLE AS pa,
 CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'phở ' || c_custkey ELSE 'pho' END AS b, (c_custkey % 83) / 100.0::DOUBLE AS pb FROM customer),
p AS (SELECT *, CASE WHEN a <> '' AND b = '' THEN 1 WHEN a = '' AND b <> '' THEN 2 WHEN a = '' AND b = '' THEN 0 WHEN b LIKE 'phở%' AND pb >= 0.65 THEN 2
 WHEN a NOT LIKE '%-%' AND b NOT LIKE 'phở%' AND pa >= pb - 0.10::DOUBLE THEN 1 WHEN pb >= pa THEN 2 ELSE 1 END AS w FROM r)
SELECT c_custkey, CASE w WHEN 1 THEN a WHEN 2 THEN b ELSE '' END AS text, CASE w WHEN 1 THEN pa WHEN 2 THEN pb ELSE 0 END AS conf FROM p""")
def hybrid_vote(spark, t):
    """M9."""
    rows = t("customer").selectExpr("c_custkey", "case when c_custkey % 11 = 0 then '' when c_custkey % 3 = 0 then '59-X3' else concat('PHO ', c_custkey) end a", "(c_custkey % 90) / 100D pa", "case when c_custkey % 13 = 0 then '' when c_custkey % 2 = 0 then concat('phở ', c_custkey) else 'pho' end b", "(c_custkey % 83) / 100D pb")
    v = G.hybrid_vote(F.col("a"), F.col("pa"), F.col("b"), F.col("pb"))
    return rows.select("c_custkey", v.text.alias("text"), v.conf.alias("conf"))


def _corpus(t) -> DataFrame:
    rows = t("documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("V"), "source").alias("video_id"), F.col("doc_id").alias("frame_idx"), X.clean_text(F.col("text")).alias("text"), ((F.col("doc_id") * 7 % 80) / 100.0 + 0.2).alias("confidence"))
    return rows.withColumn("text_unsigned", X.unsigned_of_clean(F.col("text"))).withColumn("entities", X.entity_values(F.col("text")))


SEARCHES = [("q0", "the ered"), ("q1", "con la"), ("q2", "tion"), ("q3", "for the erblere"), ("q4", "éa queux"), ("q5", "über")]
_FOLD = f"translate(lower({{0}}), {_quoted(Q.FOLDED)}, {_quoted(Q.BASE)})"
SEARCH_SQL = f"""
WITH recs AS (SELECT doc_id AS id, 'V' || source AS video_id, doc_id AS frame_idx, {_clean_sql('text')} AS text, CAST((doc_id * 7 % 80) / 100.0::DOUBLE + 0.2::DOUBLE AS DOUBLE) AS confidence FROM documents),
r AS (SELECT *, {_plain_sql('text')} AS text_unsigned FROM recs),
tk AS (SELECT id, 'text' AS col, list_filter(string_split_regex({_FOLD.format('text')}, '[^\\p{{L}}\\p{{N}}\\p{{Co}}]+'), lambda x: x <> '') AS ts FROM r
 UNION ALL SELECT id, 'text_unsigned', list_filter(string_split_regex({_FOLD.format('text_unsigned')}, '[^\\p{{L}}\\p{{N}}\\p{{Co}}]+'), lambda x: x <> '') FROM r),
post AS (SELECT id, col, unnest(ts) AS term, generate_subscripts(ts, 1) - 1 AS pos FROM tk),
q AS (SELECT qid, {_plain_sql('query')} AS u FROM (VALUES {', '.join(f"('{a}', {_quoted(b)})" for a, b in SEARCHES)}) v(qid, query)),
ws AS (SELECT qid, u, string_split(u, ' ') AS w FROM q),
ct AS (SELECT qid, CASE WHEN len(list_filter(w, lambda x: x NOT IN ({', '.join(map(_quoted, X.STOPWORDS))}))) > 0 THEN list_filter(w, lambda x: x NOT IN ({', '.join(map(_quoted, X.STOPWORDS))})) ELSE w END AS c FROM ws),
ph AS (SELECT qid, -1 AS tok, list_filter(string_split_regex({_FOLD.format('u')}, '[^\\p{{L}}\\p{{N}}\\p{{Co}}]+'), lambda x: x <> '') AS ts FROM q
 UNION ALL SELECT qid, tok, list_filter(string_split_regex({_FOLD.format('w')}, '[^\\p{{L}}\\p{{N}}\\p{{Co}}]+'), lambda x: x <> '') FROM (SELECT qid, unnest(c) AS w, generate_subscripts(c, 1) - 1 AS tok FROM ct)),
st AS (SELECT qid, tok, len(ts) AS size, unnest(ts) AS want, generate_subscripts(ts, 1) - 1 AS k FROM ph),
met AS (SELECT qid, tok, size, id, col, pos - k AS base FROM st JOIN post ON CASE WHEN tok >= 0 AND k = size - 1 THEN starts_with(term, want) ELSE term = want END),
tf AS (SELECT qid, tok, id, col, count(*) AS tf FROM (SELECT qid, tok, size, id, col, base FROM met GROUP BY ALL HAVING count(*) = size) GROUP BY qid, tok, id, col),
df AS (SELECT qid, tok, col, count(*) AS df FROM tf GROUP BY ALL),
d AS (SELECT id, sum(len(ts)) AS d FROM tk GROUP BY id), s AS (SELECT count(*) AS n, avg(d) AS mean FROM d), nt AS (SELECT qid, count(*) AS nt FROM ph WHERE tok >= 0 GROUP BY qid),
pt AS (SELECT qid, tok, id, col, nt, (CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * d / mean)) AS p
 FROM tf JOIN df USING (qid, tok, col) JOIN d USING (id) JOIN nt USING (qid) CROSS JOIN s),
pc AS (SELECT qid, id, col, coalesce(sum(p) FILTER (tok < 0), 0) + coalesce(sum(p) FILTER (tok >= 0), 0) * CASE WHEN count(*) FILTER (tok >= 0) = any_value(nt) THEN 2 ELSE 1 END AS score FROM pt GROUP BY qid, id, col),
bm AS (SELECT qid, id, -sum(score) AS bm25 FROM pc GROUP BY qid, id)"""


def _half_up(number: str, digits: int) -> str:
    """Rounded half up as the number is printed. DuckDB's own round of a double multiplies it first, which misses some halves (1.0005 becomes 1.0)."""
    return f"CAST(round(CAST(CAST({number} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


RANKED_SQL = SEARCH_SQL + """,
f AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY CAST(printf('%.9e', bm25) AS DOUBLE), confidence DESC, id) AS c FROM bm JOIN r USING (id) JOIN q USING (qid) WHERE confidence >= {least} AND {more}),
g AS (SELECT *, row_number() OVER (PARTITION BY qid, video_id, frame_idx ORDER BY c) AS fr FROM f WHERE c <= 2 * {k}),
h AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c) AS kk FROM g WHERE fr = 1),
i AS (SELECT *, """ + _half_up("0.7 / (1 + abs(bm25)) + 0.3 * confidence + CASE WHEN contains(text_unsigned, u) THEN 0.5 ELSE 0 END", 4) + """ AS score FROM h WHERE kk <= {k})"""


_INDEXES: dict[tuple[str, ...], str] = {}


def _indexed(spark, t) -> tuple:
    """The corpus and its written index. An index is written once in a session for the same files of documents and then read."""
    from .sources.segments import TermIndex, add_segment
    from .sources.shared import new_folder

    source = t("documents")
    key = (spark.sparkContext.applicationId, *sorted(source.inputFiles()))
    if key not in _INDEXES:
        folder = new_folder(spark, "text-index")
        add_segment(_corpus(t), folder)
        _INDEXES[key] = folder
    index = TermIndex(spark, _INDEXES[key])
    return index.records(), index


def _ranked(least: str, more: str, k: str) -> str:
    return RANKED_SQL.replace("{least}", least).replace("{more}", more).replace("{k}", k)


def _searches(spark) -> DataFrame:
    return spark.createDataFrame(SEARCHES, "qid string, query string")


@query(SEARCH_SQL + " SELECT qid, id, round(bm25, 6) AS bm25 FROM bm")
def fulltext_bm25(spark, t):
    """BM25 of every match of a batch of queries."""
    records, index = _indexed(spark, t)
    return Q.bm25(records, _searches(spark), index).select("qid", "id", F.round("bm25", 6).alias("bm25"))


@query(_ranked("0.30", "true", "20") + f" SELECT qid, id, video_id, frame_idx, {_half_up('score', 3)} AS score FROM i")
def fulltext_search(spark, t):
    """Ranked hits."""
    records, index = _indexed(spark, t)
    return Q.search(records, _searches(spark), top_k=20, index=index).select("qid", "id", "video_id", "frame_idx", F.round("score", 3).alias("score"))


@query(_ranked("0.50", "video_id = 'Vsrc1'", "5") + f" SELECT qid, id, video_id, frame_idx, {_half_up('score', 3)} AS score FROM i")
def fulltext_filtered(spark, t):
    """Q1 within one video and above a confidence."""
    records, index = _indexed(spark, t)
    return Q.search(records, _searches(spark), top_k=5, video_id="Vsrc1", min_confidence=0.50, index=index).select("qid", "id", "video_id", "frame_idx", F.round("score", 3).alias("score"))


@query(_ranked("0.30", "true", "100") + """,
o AS (SELECT qid, video_id, frame_idx, row_number() OVER (PARTITION BY qid ORDER BY score DESC, c) AS rank FROM i),
tr AS (SELECT 'q' || i AS qid, 'Vsrc' || i AS video, 0 AS s, 500 AS e FROM range(6) t(i)),
m AS (SELECT tr.qid, rank, CASE WHEN rank IS NOT NULL AND o.video_id = video AND frame_idx BETWEEN s AND e THEN 1.0 ELSE 0.0 END AS r FROM tr LEFT JOIN o ON tr.qid = o.qid AND rank <= 100)
SELECT qid, coalesce(max(r) FILTER (rank <= 1), 0) AS r_at_1, coalesce(max(r) FILTER (rank <= 5), 0) AS r_at_5, coalesce(max(r) FILTER (rank <= 20), 0) AS r_at_20, coalesce(max(r) FILTER (rank <= 50), 0) AS r_at_50, coalesce(max(r) FILTER (rank <= 100), 0) AS r_at_100, min(rank) FILTER (r > 0) AS best_rank,
 CAST((coalesce(max(r) FILTER (rank <= 1), 0) + coalesce(max(r) FILTER (rank <= 5), 0) + coalesce(max(r) FILTER (rank <= 20), 0) + coalesce(max(r) FILTER (rank <= 50), 0) + coalesce(max(r) FILTER (rank <= 100), 0)) / 5 AS DOUBLE) AS final_score FROM m GROUP BY qid""")
def batch_search_eval(spark, t):
    """A batch of searches against known frame ranges."""
    records, index = _indexed(spark, t)
    hits = Q.search(records, _searches(spark), top_k=100, index=index).select("qid", "rank", "video_id", "frame_idx")
    truth = spark.range(6).selectExpr("concat('q', id) qid", "'KIS' type", "concat('Vsrc', id) video", "0L start", "500L end", "'' answer")
    scores = E.evaluate(hits, truth)
    return scores.select("qid", *[F.col(f"r_at_{k}").cast("decimal(2,1)").alias(f"r_at_{k}") for k in E.CUTS], F.col("best_rank").cast("bigint").alias("best_rank"), F.round("final_score", 4).alias("final_score"))


@query("""WITH s AS (SELECT p_partkey, CASE WHEN p_size > 30 THEN 1 ELSE 0 END AS a, CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS b FROM part)
SELECT count(*) AS n_queries, round(avg(a), 9) AS r_at_1, round(avg(b), 9) AS r_at_100, round(avg((a + 4 * b) / 5.0::DOUBLE), 9) AS final_score, round(2500.0::DOUBLE / count(*), 3) AS latency_ms FROM s""")
def benchmark_means(spark, t):
    """Means over queries, with the share of a batch's time."""
    hits = t("part").where("p_size > 10").selectExpr("p_partkey qid", "case when p_size > 30 then 1 else 3 end rank", "'V' video_id", "1L frame_idx")
    truth = t("part").selectExpr("p_partkey qid", "'KIS' type", "'V' video", "0L start", "5L end", "'' answer")
    means = E.benchmark_means(E.evaluate(hits, truth), 2.5)
    return means.select("n_queries", *[F.round(c, 9).alias(c) for c in ("r_at_1", "r_at_100", "final_score")], "latency_ms")


@query("SELECT w AS word, (SELECT count(*) FROM documents WHERE contains(lower(text), w)) AS n FROM (VALUES ('license'), ('the'), ('idiot'), ('haus')) v(w)")
def keyword_counts(spark, t):
    """T21, A14."""
    return Q.keyword_counts(t("documents"), ["license", "the", "idiot", "haus"])


def _records(t) -> DataFrame:
    """Turns as records: two turns to a frame."""
    rows = t("conversations").selectExpr("conv_id * 100 + turn as id", "concat('V', conv_id) as video_id", "cast(floor(turn / 2) * 75 as bigint) as frame_idx", "text", "cast(turn as double) / 10 as timestamp", "concat('u', conv_id) as youtube_url", "(turn * 13 % 10) / 10D as bbox_ymin", "(turn * 7 % 10) / 10D as bbox_xmin", "(turn * 13 % 10) / 10D + 0.1D as bbox_ymax", "(turn * 7 % 10) / 10D + 0.1D as bbox_xmax", "array(named_struct('type', 'ROLE', 'value', role), named_struct('type', 'Turn', 'value', cast(turn % 2 as string))) as entities", "'' as timestamp_str", "role")
    return rows.withColumn("frame_id", F.concat_ws("_", "video_id", F.col("frame_idx").cast("string")))


RECORDS_SQL = """WITH r AS (SELECT conv_id * 100 + turn AS id, 'V' || conv_id AS video_id, CAST(turn // 2 * 75 AS BIGINT) AS frame_idx, text, turn, role, conv_id, turn / 10.0::DOUBLE AS ts,
 (turn * 13 % 10) / 10.0::DOUBLE AS y, (turn * 7 % 10) / 10.0::DOUBLE AS x FROM conversations)"""


@query(RECORDS_SQL + """ SELECT video_id || '_' || frame_idx AS frame_id, string_agg(trim(text), ' | ' ORDER BY id) FILTER (trim(coalesce(text, '')) <> '') AS ocr_text, any_value(video_id) AS video_id, any_value(frame_idx) AS frame_idx,
 arg_min(ts, id) AS timestamp, 'u' || any_value(conv_id) AS youtube_url,
 array_to_string(list_concat(arg_min(['ROLE:' || role, 'Turn:' || turn % 2], id), list_sort(list_distinct(list_filter(flatten(list(['ROLE:' || role, 'Turn:' || turn % 2])), lambda e: NOT list_contains(arg_min(['ROLE:' || role, 'Turn:' || turn % 2], id), e))))), ',') AS entities FROM r GROUP BY video_id, frame_idx""".replace("GROUP BY video_id, frame_idx", "GROUP BY r.video_id, r.frame_idx").replace("any_value(video_id) AS video_id, any_value(frame_idx) AS frame_idx", "r.video_id, r.frame_idx"))
def frame_documents(spark, t):
    """With the ordered union of entities, in which ROLE sorts before Turn."""
    return D.frame_documents(_records(t)).select("frame_id", "ocr_text", "video_id", "frame_idx", "timestamp", "youtube_url", _named("entities"))


def _named(entities: str):
    return F.array_join(F.transform(entities, lambda e: F.concat_ws(":", e["type"], e["value"])), ",").alias(entities)


@query(RECORDS_SQL + """, d AS (SELECT video_id || '_' || frame_idx AS frame_id, video_id, frame_idx, string_agg(trim(text), ' ' ORDER BY id) FILTER (trim(text) <> '') AS body, arg_min(ts, id) AS ts FROM r GROUP BY video_id, frame_idx)
SELECT frame_id, 0 AS part, '{"index":{"_index":"frames_ocr","_id":"' || frame_id || '"}}' AS line FROM d
UNION ALL SELECT frame_id, 1, CAST(json_object('ocr_text', coalesce(body, ''), 'video_id', video_id, 'frame_idx', frame_idx, 'timestamp', ts) AS VARCHAR) FROM d""")
def bulk_actions(spark, t):
    """A2, K4: both lines of each frame in a bulk load."""
    return D.bulk_lines(_records(t)).select("frame_id", "part", "line")


@query(RECORDS_SQL + " SELECT video_id, frame_idx, string_agg(trim(text), ' | ' ORDER BY y, x, id) FILTER (trim(text) <> '') AS text, count(*) AS total, string_agg('ROLE:' || role || ',Turn:' || turn % 2, ',' ORDER BY y, x, id) AS entities FROM r GROUP BY video_id, frame_idx")
def read_frame(spark, t):
    """A9, O4."""
    return D.read_frames(_records(t)).select("video_id", "frame_idx", "text", "total", _named("entities"))


@query(RECORDS_SQL + """ SELECT video_id, frame_idx, count(*) AS total_detections, string_agg(coalesce(text, ''), ' | ' ORDER BY y, x, id) AS full_transcription, string_agg(CAST(id AS VARCHAR), ',' ORDER BY y, x, id) AS ids,
 string_agg(printf('%.2f %.2f', y, x + 0.1::DOUBLE), ',' ORDER BY y, x, id) AS boxes, string_agg('ROLE:' || role || ',Turn:' || turn % 2, ',' ORDER BY y, x, id) AS extracted_entities FROM r GROUP BY video_id, frame_idx""")
def tool_read_frame(spark, t):
    """API2, API6: the answer about every frame."""
    rows = D.frame_answers(_records(t))
    box = F.transform("detections", lambda d: F.format_string("%.2f %.2f", d["bbox_norm"][0], d["bbox_norm"][3]))
    return rows.select("video_id", "frame_idx", "total_detections", "full_transcription", F.array_join(F.transform("detections", lambda d: d["id"].cast("string")), ",").alias("ids"), F.array_join(box, ",").alias("boxes"), _named("extracted_entities"))


@query(RECORDS_SQL + """ SELECT video_id, frame_idx, string_agg(coalesce(text, ''), ' ' ORDER BY y, x, id) AS matched_text, string_agg(CAST(id AS VARCHAR), ',' ORDER BY y, x, id) AS ids FROM r
 WHERE (y + (y + 0.1::DOUBLE)) / 2 BETWEEN 0.2 AND 0.9 AND (x + (x + 0.1::DOUBLE)) / 2 BETWEEN 0.1 AND 0.8 GROUP BY video_id, frame_idx""")
def tool_inspect_roi(spark, t):
    """API3: the answer about a region of every frame."""
    rows = D.roi_answers(_records(t), G.box(F.lit(0.2), F.lit(0.1), F.lit(0.9), F.lit(0.8)))
    return rows.select("video_id", "frame_idx", "matched_text", F.array_join(F.transform("detections", lambda d: d["id"].cast("string")), ",").alias("ids"))


@query(RECORDS_SQL + " SELECT video_id, frame_idx, id, coalesce(text, '') AS raw_text, 'Turn' AS entity_type, CAST(turn % 2 AS VARCHAR) AS entity_value, printf('%.2f %.2f', y, x) AS corner FROM r")
def tool_extract_entities(spark, t):
    """API4: entities of a type, whatever its case, with the text and the box of their detections."""
    rows = D.entity_answers(_records(t), "TURN")
    return rows.select("video_id", "frame_idx", "id", F.coalesce("raw_text", F.lit("")).alias("raw_text"), "entity_type", "entity_value", F.format_string("%.2f %.2f", F.col("bbox_norm")[0], F.col("bbox_norm")[1]).alias("corner"))


@query(RECORDS_SQL + """ SELECT id, video_id || ', ' || frame_idx AS submission_kis, video_id || ', ' || frame_idx || ', ' || CASE WHEN turn % 3 = 0 THEN coalesce(text, '') ELSE role END AS submission_qa,
 video_id || ', ' || frame_idx AS submission_trake, coalesce(text, '') AS detected_text, printf('%.2f', y) AS top FROM r""")
def hit_payloads(spark, t):
    """Answer strings and the compact form of hits, a third of them without entities."""
    hits = _records(t).withColumns({"entities": F.when(F.col("id") % 100 % 3 != 0, F.col("entities")), "text": F.coalesce("text", F.lit("")), "qid": F.col("id"), "rank": F.lit(1), "confidence": F.lit(0.5)})
    short = Q.compact(Q.payloads(hits))
    trake = Q.payloads(hits).select(F.col("id").alias("qid"), "submission_trake")
    return short.join(trake, "qid").select(F.col("qid").alias("id"), "submission_kis", "submission_qa", "submission_trake", "detected_text", F.format_string("%.2f", F.col("bbox_norm")[0]).alias("top"))


@query("SELECT 'V' || conv_id || '_' || turn * 75 AS frame_id, 'V' || conv_id AS video_id, turn * 75 AS frame_idx, round_even(turn * 300 / 1000.0::DOUBLE, 3) AS timestamp, turn * 300 AS timestamp_ms, '00:00:00.000' AS timestamp_str, turn * 75 AS frame_start, CAST(1 AS BIGINT) AS occurrences, coalesce(text, '') AS text, 0.0::DOUBLE AS confidence, turn / 10.0::DOUBLE AS bbox_xmin, '[]' AS entities_json FROM conversations")
def flat_records(spark, t):
    """Defaults of the record table's columns."""
    from .sources.sinks import flat_records as flat

    rows = t("conversations").selectExpr("concat('V', conv_id) as video_id", "turn * 75 as frame_idx", "turn * 300 as timestamp_ms", "text", "array(0D, cast(turn as double) / 10, 0.5D, 0.6D) as bbox_norm")
    return flat(rows).select("frame_id", "video_id", "frame_idx", "timestamp", "timestamp_ms", "timestamp_str", "frame_start", "occurrences", "text", "confidence", "bbox_xmin", "entities_json")


@query("""WITH f AS (SELECT DISTINCT conv_id, turn * 75 AS idx, conv_id % 3 = 0 AS listed, conv_id % 2 = 0 AND turn % 2 = 0 AS told FROM conversations),
g AS (SELECT *, CASE WHEN told THEN idx + 1000 ELSE idx END AS frame_idx, CASE WHEN listed THEN 30.0 WHEN conv_id % 2 = 0 THEN 50.0 ELSE 25.0 END::DOUBLE AS fps FROM f),
h AS (SELECT *, CASE WHEN told THEN CAST(idx * 997 + 5 AS BIGINT) ELSE CAST(floor(round_even(frame_idx / fps, 3) * 1000.0) AS BIGINT) END AS timestamp_ms, CASE WHEN told THEN round_even((idx * 997 + 5) / 1000.0::DOUBLE, 3) ELSE round_even(frame_idx / fps, 3) END AS timestamp FROM g)
SELECT 'V' || conv_id || '_' || frame_idx AS frame_id, 'V' || conv_id AS video_id, frame_idx, timestamp, timestamp_ms, fps,
 CASE WHEN told AND idx % 4 = 0 THEN 'given' ELSE printf('%02d:%02d.%03d', timestamp_ms // 60000, timestamp_ms // 1000 % 60, timestamp_ms % 1000) END AS timestamp_str FROM h""")
def metadata_override(spark, t):
    """What per-video metadata say of a frame goes before what its name says; names with and without extension."""
    conv = t("conversations").selectExpr("conv_id", "concat('V', conv_id) video_id", "turn", "turn * 75 idx").distinct()
    told = conv.where("conv_id % 2 = 0 and turn % 2 = 0").select("video_id", F.concat(F.lit("keyframe_"), F.col("idx").cast("string"), F.when(F.col("idx") % 4 == 0, ".webp").otherwise("")).alias("k"), F.struct((F.col("idx") + 1000).alias("frame_idx"), (F.col("idx") * 997 + 5).alias("timestamp_ms"), F.when(F.col("idx") % 4 == 0, "given").alias("timestamp_str")).alias("v"))
    told = told.groupBy("video_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("frames"))
    metadata = conv.where("conv_id % 2 = 0").select("video_id").distinct().join(told, "video_id", "left").withColumn("fps", F.lit("50"))
    fps = conv.where("conv_id % 3 = 0").select("video_id", F.lit(30.0).alias("fps")).distinct()
    none = spark.createDataFrame([], "frame_id string, rel_path string"), spark.createDataFrame([], "video_id string, watch_url string")
    info = P.frame_info(conv.select("video_id", F.concat(F.lit("a/keyframe_"), F.col("idx").cast("string"), F.lit(".webp")).alias("image_name")), fps, *none, metadata)
    return info.select("frame_id", "video_id", "frame_idx", "timestamp", "timestamp_ms", "fps", "timestamp_str")


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'unknown' ELSE 'V' || p_partkey % 9 END AS video_id FROM part")
def index_catalogue(spark, t):
    """S3: the video that an entry of an index is listed under."""
    rows = t("part").selectExpr("cast(p_partkey as string) frame_id", "case when p_partkey % 5 = 0 then concat('k_', p_partkey, '.webp') when p_partkey % 2 = 0 then concat('V', p_partkey % 9, '\\\\k.webp') else concat('V', p_partkey % 9, '/x/k.webp') end rel_path")
    return P.catalogue(rows).select(F.col("frame_id").cast("bigint").alias("p_partkey"), "video_id")


@query("SELECT 'V' || conv_id AS video_id, turn FROM conversations WHERE 'V' || conv_id IN (SELECT DISTINCT 'V' || conv_id AS v FROM conversations ORDER BY v LIMIT 7)")
def first_videos(spark, t):
    """API11: the frames of the first videos."""
    return P.first_videos(t("conversations").selectExpr("concat('V', conv_id) video_id", "turn"), 7)


LIKES = [("q0", "the Er"), ("q1", "Cơm"), ("q2", "con_la"), ("q3", "the%haus"), ("q4", "  ")]
_LIKED = f"translate({{0}}, {_quoted(Q.CAPITALS)}, {_quoted(Q.SMALL)})"


@query(f"""WITH recs AS (SELECT doc_id AS id, 'V' || source AS video_id, doc_id AS frame_idx, {_clean_sql('text')} || CASE WHEN doc_id % 50 = 0 THEN ' Cơm Tấm' ELSE '' END AS text, CAST((doc_id * 7 % 80) / 100.0::DOUBLE + 0.2::DOUBLE AS DOUBLE) AS confidence FROM documents),
r AS (SELECT *, {_plain_sql('text')} AS text_unsigned FROM recs),
q AS (SELECT qid, {_clean_sql('query')} AS c, {_plain_sql(_clean_sql('query'))} AS u FROM (VALUES {', '.join(f"('{a}', {_quoted(b)})" for a, b in LIKES)}) v(qid, query)),
f AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY confidence DESC, id) AS n FROM r, q WHERE u <> '' AND confidence >= 0.5 AND video_id <> 'Vsrc0' AND ({_LIKED.format('text_unsigned')} LIKE {_LIKED.format("'%' || u || '%'")} OR {_LIKED.format('text')} LIKE {_LIKED.format("'%' || c || '%'")})),
h AS (SELECT * FROM f WHERE n <= 60 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY n) <= 30)
SELECT qid, id, round(confidence, 6) AS confidence, round(0.35 + 0.3 * confidence + CASE WHEN contains(text_unsigned, u) THEN 0.5 ELSE 0 END, 3) AS score FROM h""")
def like_search(spark, t):
    """The fallback by substring: marked and unmarked queries, patterns, a bound of confidence below which records hold the words."""
    rows = _corpus(t).withColumn("text", F.concat("text", F.when(F.col("id") % 50 == 0, " Cơm Tấm").otherwise("")))
    rows = rows.withColumn("text_unsigned", X.unsigned_of_clean(F.col("text"))).where("video_id <> 'Vsrc0'")
    return Q.search(rows, spark.createDataFrame(LIKES, "qid string, query string"), 30, min_confidence=0.5, substrings=True).select("qid", "id", F.round("confidence", 6).alias("confidence"), F.round("score", 3).alias("score"))


_QA_HIT = "(a = '' OR contains(u, a) OR contains(e1, a) OR contains(e2, a))"


@query(f"""WITH h AS (SELECT p_partkey, p_partkey % 2 = 0 AS qa, 'V' || p_partkey % 3 AS video_id, p_size AS frame_idx, lower(p_name) AS u, lower(p_brand) AS e1, CASE p_partkey % 3 WHEN 1 THEN '150 nghin' ELSE 'da lat' END AS e2 FROM part),
r AS (SELECT p_partkey, CASE WHEN video_id = 'V1' AND frame_idx BETWEEN 10 AND 40 THEN 1.0 ELSE 0.0 END AS kis, qa, u, e1, e2, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'brand#1' WHEN 2 THEN '150 nghin' WHEN 3 THEN 'da la' ELSE 'a' END AS a FROM h)
SELECT p_partkey, CAST(CASE WHEN NOT qa THEN kis WHEN kis = 1.0 AND {_QA_HIT} THEN 1.0 ELSE 0.0 END AS DECIMAL(2,1)) AS r_at_1, CAST(CASE WHEN NOT qa THEN kis WHEN kis = 1.0 AND {_QA_HIT} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS final_score FROM r""")
def qa_scores(spark, t):
    """A hit for each part, half of them answers to questions, some of which only a marked entity holds."""
    part = t("part").selectExpr("p_partkey qid", "p_partkey", "concat('V', p_partkey % 3) video_id", "cast(p_size as bigint) frame_idx", "lower(p_name) text_unsigned", "array(named_struct('type', 'B', 'value', p_brand), named_struct('type', 'PRICE', 'value', case p_partkey % 3 when 1 then '150 nghìn' else 'Đà Lạt' end)) entities")
    truth = part.selectExpr("qid", "case when p_partkey % 2 = 0 then 'QA' else 'KIS' end type", "'V1' video", "10L start", "40L end", "case p_partkey % 5 when 0 then '' when 1 then 'Brand#1' when 2 then '150 nghìn' when 3 then 'Đà La' else 'A' end answer")
    scores = E.evaluate(part.withColumn("rank", F.lit(1)), truth)
    return scores.select(F.col("qid").alias("p_partkey"), F.col("r_at_1").cast("decimal(2,1)").alias("r_at_1"), F.round("final_score", 4).alias("final_score"))


_MARKED = "CASE doc_id % 4 WHEN 0 THEN 'ax̂b' WHEN 1 THEN 'İstanbul' WHEN 2 THEN 'nǵa ſo' ELSE '' END"


@query(f"SELECT doc_id, CAST(len(ts) AS INT) AS n, array_to_string(ts, ' ') AS terms FROM (SELECT doc_id, list_filter(string_split_regex({_FOLD.format(f"coalesce(text, '') || ' ' || {_MARKED}")}, '[^\\p{{L}}\\p{{N}}\\p{{Co}}]+'), lambda x: x <> '') AS ts FROM documents)")
def index_terms(spark, t):
    """The index terms of whole documents, to each of which a word with combining marks or an odd letter is added."""
    ts = Q.terms(F.concat_ws(" ", F.coalesce("text", F.lit("")), F.expr(_MARKED)))
    return t("documents").select("doc_id", ts.alias("ts")).select("doc_id", F.size("ts").alias("n"), F.array_join("ts", " ").alias("terms"))


@query()
def image_preparation(spark, t):
    """M1-M5: the bytes of each whole text as a gray image 64 wide (the last row filled up with zeros), prepared for a detector of sides 24 to 96; its pixels by
    their digest. An empty text is no image. Tested against a plain loop."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    high = F.ceil(size / 64).cast("int")
    content = F.when(size > 0, F.concat(F.encode(F.concat(F.lit("P5 64 "), high.cast("string"), F.lit(" 255\n")), "utf-8"), F.rpad(F.encode("text", "utf-8"), high * 64, F.lit(b"\x00"))))
    images = t("documents").select(F.col("doc_id").cast("string").alias("path"), content.alias("content"))
    rows = V.prepare_images(images, most=96, least=24)
    return rows.select(F.col("path").cast("bigint").alias("doc_id"), "width", "height", "channels", "scale", "blur_score", "is_blurry", "error", F.sha2("pixels", 256).alias("pixels_sha256"))


@query("""SELECT p_partkey, CASE WHEN greatest(w, h) <= 1600 AND least(w, h) <= 640 THEN 1.0 ELSE round(1600.0::DOUBLE / greatest(w, h), 6) END AS scale, CASE WHEN greatest(w, h) <= 1600 AND least(w, h) <= 640 THEN w ELSE CAST(trunc(w * (1600.0::DOUBLE / greatest(w, h))) AS INT) END AS width
FROM (SELECT p_partkey, CAST(p_partkey * 13 % 2400 + 40 AS INT) AS w, CAST(p_size * 31 + 20 AS INT) AS h FROM part)""")
def detection_sizes(spark, t):
    """M4: the size at which an image goes to detection."""
    size = G.detection_size(F.col("w"), F.col("h"), 1600, 640)
    return t("part").selectExpr("p_partkey", "cast(p_partkey * 13 % 2400 + 40 as int) w", "cast(p_size * 31 + 20 as int) h").select("p_partkey", F.round(size.scale, 6).alias("scale"), size.width.alias("width"))


@query("""WITH p AS (SELECT p_partkey, p_size AS s, p_partkey % 7 AS k FROM part), q AS (SELECT p_partkey, [[k, 1], [k + 20 + s, 2], [k + 22 + s, 30 + s], [k + 1, 33 + s]] AS c FROM p),
o AS (SELECT p_partkey, unnest([c[3], c[1], c[4], c[2]]) AS pt, unnest([0, 1, 2, 3]) AS i FROM q)
SELECT p_partkey, arg_min(pt, [pt[1] + pt[2], i])[1] AS tl_x, arg_min(pt, [pt[2] - pt[1], i])[1] AS tr_x, arg_min(pt, [-(pt[1] + pt[2]), i])[2] AS br_y, arg_min(pt, [-(pt[2] - pt[1]), i])[2] AS bl_y FROM o GROUP BY p_partkey""")
def polygon_corners(spark, t):
    """M7: the corners of a quadrilateral given in any order."""
    rows = t("part").selectExpr("p_partkey", "p_size s", "cast(p_partkey % 7 as int) k").withColumn("c", F.expr("array(array(k + 22 + s, 30 + s), array(k, 1), array(k + 1, 33 + s), array(k + 20 + s, 2))"))
    c = G.corners(F.col("c"))
    return rows.select("p_partkey", c[0][0].cast("bigint").alias("tl_x"), c[1][0].cast("bigint").alias("tr_x"), c[2][1].cast("bigint").alias("br_y"), c[3][1].cast("bigint").alias("bl_y"))


@query("SELECT p_partkey FROM part WHERE (p_partkey % 100) / 100.0::DOUBLE >= 0.40 AND p_partkey % 9 <> 0")
def recognised_lines(spark, t):
    """Unsure and blank readings go."""
    rows = t("part").selectExpr("p_partkey", "case when p_partkey % 9 = 0 then ' ' else p_name end s", "(p_partkey % 100) / 100D p")
    return rows.where(G.recognized(F.col("s"), F.col("p"))).select("p_partkey")


@query("SELECT w AS text, (SELECT count(*) FROM documents WHERE list_contains(list_transform(list_filter(string_split_regex(translate(lower(text), " + _quoted(Q.FOLDED) + ", " + _quoted(Q.BASE) + "), '[^\\p{L}\\p{N}\\p{Co}]+'), lambda x: x <> ''), lambda x: x), w)) AS n FROM (VALUES ('license'), ('the'), ('haus')) v(w)")
def match_counts(spark, t):
    """How many records an index term matches."""
    records = t("documents").select(F.col("doc_id").alias("id"), "text", F.lit("").alias("text_unsigned"))
    return Q.match_counts(Q.postings(records), ["license", "the", "haus"])


@query(RECORDS_SQL + " SELECT video_id, frame_idx, string_agg(trim(text), ' ' ORDER BY y, x, id) FILTER (trim(text) <> '') AS text, count(*) AS total FROM r WHERE (y + (y + 0.1::DOUBLE)) / 2 BETWEEN 0 AND 0.5 AND (x + (x + 0.1::DOUBLE)) / 2 BETWEEN 0 AND 0.8 GROUP BY video_id, frame_idx")
def roi_text(spark, t):
    """A10, G4."""
    return D.roi_text(_records(t), G.box(F.lit(0.0), F.lit(0.0), F.lit(0.5), F.lit(0.8)))


@query(RECORDS_SQL + " SELECT video_id, frame_idx, id, 'ROLE' AS type, role AS value FROM r")
def video_entities(spark, t):
    """Entities of a type, whatever its case."""
    return D.video_entities(_records(t), "role").select("video_id", "frame_idx", "id", "type", "value")


@query(RECORDS_SQL + " SELECT count(DISTINCT video_id) AS videos, (SELECT count(*) FROM (SELECT DISTINCT video_id, frame_idx FROM r)) AS frames, count(*) AS records, count(*) AS detections FROM r")
def run_summary(spark, t):
    """A3, A8."""
    records = _records(t).withColumn("occurrences", F.lit(1).cast("bigint"))
    return D.run_summary(records.select("video_id", "frame_idx").distinct(), records)


@query("""WITH e AS (SELECT user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS "at", value FROM events), c AS (SELECT *, CASE WHEN "at" - lag("at") OVER w > 86400 THEN 1 ELSE 0 END AS cut FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY "at")),
k AS (SELECT *, sum(cut) OVER (PARTITION BY user_id, event_type ORDER BY "at") AS track FROM c)
SELECT user_id, event_type, CAST(track AS BIGINT) AS track, min("at") AS frame_start, max("at") AS frame_end, count(*) AS occurrences, max(value) AS best, min("at") FILTER (value = m) AS best_at FROM (SELECT *, max(value) OVER (PARTITION BY user_id, event_type, track) AS m FROM k) GROUP BY user_id, event_type, track""")
def tracks_exact(spark, t):
    """Runs of equal events by gaps."""
    rows = t("events").select("user_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"), "value")
    return R.exact_tracks(rows, ["user_id", "event_type"], "at", 86400, "value")


def _stream_of(spark, source: DataFrame) -> DataFrame:
    """The files of a table as a stream, a file at a time."""
    path = source.inputFiles()[0].rsplit("/", 1)[0]
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1)
    return stream.parquet(path) if path.endswith(".parquet") else stream.option("pathGlobFilter", source.inputFiles()[0].rsplit("/", 1)[1]).parquet(path)


def _detected(conversations: DataFrame) -> DataFrame:
    return conversations.selectExpr("concat('V', conv_id) video_id", "concat(conv_id, '-', turn) frame_id", "cast(floor(turn / 2) * 75 as bigint) frame_idx", "cast(turn as double) timestamp", "turn * 1000 timestamp_ms", "'' timestamp_str", "'' youtube_url", "turn as ord", "text", "lower(text) text_unsigned", "(turn * 37 % 100) / 100D confidence", "0.1D bbox_ymin", "0.1D bbox_xmin", "0.3D bbox_ymax", "0.5D bbox_xmax", "'[]' polygon_json", "array(role) entities")


def _detections(t) -> DataFrame:
    return _detected(t("conversations"))


# with equal texts alone the rule is one of gaps: the k-th detection of a text in a frame joins the k-th open track of that text
_EQUAL_SQL = """WITH r AS (SELECT 'V' || conv_id AS video_id, CAST(turn // 2 * 75 AS BIGINT) AS f, turn, text, trim(lower(text)) AS u FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY video_id, u, f ORDER BY turn) AS k FROM r WHERE u <> ''),
c AS (SELECT *, CASE WHEN f - lag(f) OVER (PARTITION BY video_id, u, k ORDER BY f) > 120 THEN 1 ELSE 0 END AS cut FROM n),
g AS (SELECT *, sum(cut) OVER (PARTITION BY video_id, u, k ORDER BY f) AS track FROM c),
x AS (SELECT video_id, min(f) AS frame_start, max(f) AS frame_end, count(*) AS occurrences, u FROM g GROUP BY video_id, u, k, track UNION ALL SELECT video_id, f, f, 1, '' FROM r WHERE coalesce(u, '') = '')
SELECT video_id, frame_start, frame_end, CAST(occurrences AS BIGINT) AS occurrences, u AS text FROM x"""


def _track_rows(records: DataFrame) -> DataFrame:
    return records.select("video_id", "frame_start", "frame_end", "occurrences", F.trim(F.lower(F.coalesce("text", F.lit("")))).alias("text"))


@query(_EQUAL_SQL)
def tracks_equal(spark, t):
    """2.9, J7: greedy merging where only equal texts are alike, which SQL can say."""
    return _track_rows(R.greedy_tracks(_detections(t), threshold=1.0))


@query(_EQUAL_SQL)
def stream_index(spark, t):
    """2.11, K6, U1: conversations as a stream of detections, a file a batch, into tables by video."""
    from .sources import sinks
    from .sources.shared import new_folder
    from .streaming.indexing import index_stream

    out = new_folder(spark, "stream-index")
    stream = _stream_of(spark, t("conversations")).withColumn("video_id", F.concat(F.lit("V"), "conv_id"))
    index_stream(stream, out, _detected, threshold=1.0).awaitTermination()
    return _track_rows(sinks.read_records(spark, f"{out}/records"))


@query()
def tracks_greedy(spark, t):
    """2.9: greedy merging."""
    return R.greedy_tracks(_detections(t)).drop("entities")


@query(RECORDS_SQL + " SELECT count(*) AS records, avg(CASE WHEN length(regexp_replace(lower(text), '[^" + X.LOWER_MARKED + "]', '', 'g')) > 0 THEN 1.0 ELSE 0.0 END) AS vietnamese, 1.0::DOUBLE AS with_id, avg(CASE WHEN frame_idx = 0 OR ts > 0 THEN 1.0 ELSE 0.0 END) AS with_time FROM r")
def quality_ratios(spark, t):
    """A13."""
    return D.quality_ratios(_records(t))


@query("""WITH t AS (SELECT DISTINCT doc_id, unnest(string_split_regex(translate(lower(text), """ + _quoted(Q.FOLDED) + ", " + _quoted(Q.BASE) + """), '[^\\p{L}\\p{N}\\p{Co}]+')) AS term FROM documents), d AS (SELECT term, count(*) AS n FROM t WHERE term <> '' GROUP BY term),
e AS (SELECT word, term, n, CASE WHEN word = term THEN 0 WHEN length(word) = length(term) THEN len(list_filter(range(1, length(word) + 1), lambda i: substr(word, i, 1) <> substr(term, i, 1)))
 WHEN length(word) = length(term) + 1 AND len(list_filter(range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1) = term)) > 0 THEN 1
 WHEN length(term) = length(word) + 1 AND len(list_filter(range(1, length(term) + 1), lambda i: substr(term, 1, i - 1) || substr(term, i + 1) = word)) > 0 THEN 1 ELSE 2 END AS distance
 FROM d CROSS JOIN (VALUES ('therin'), ('queaux'), ('schtz')) v(word))
SELECT word, term, CAST(distance AS INT) AS distance, n FROM e WHERE distance <= 1""")
def fuzzy_terms(spark, t):
    """Terms within an edit of words. Distances up to 1 are spelled out in SQL, as levenshtein there counts bytes."""
    rows = t("documents").select(F.col("doc_id").alias("id"), F.explode(Q.terms(F.col("text"))).alias("term"))
    return Q.fuzzy_terms(rows, ["therin", "queaux", "schtz"], 1)


@query("SELECT 'V' || conv_id AS video_id, CAST(turn // 2 * 75 AS BIGINT) AS frame_start, CAST(turn // 2 * 75 AS BIGINT) AS frame_end, CAST(1 AS BIGINT) AS occurrences, text FROM conversations")
def tracks_disabled(spark, t):
    """2.9 with merging off: a record per detection."""
    return R.untracked(_detections(t)).select("video_id", "frame_start", "frame_end", "occurrences", "text")


@query("SELECT c_custkey AS video_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderkey % 20 = 0)")
def resume_pending(spark, t):
    """Videos that no run has finished."""
    return P.pending(t("customer").select(F.col("c_custkey").alias("video_id")), t("orders").where("o_orderkey % 20 = 0").select(F.col("o_custkey").alias("video_id")))


@query("SELECT p_partkey, regexp_replace(trim(v), '(?i)\\.mp4$', '') AS video_id, coalesce(try_cast(regexp_replace(f, '\\s+', '', 'g') AS BIGINT), 0) AS frame_idx, rtrim(substr(trim(p_name), 1, 100)) AS answer FROM (SELECT p_partkey, p_name, ' L' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '.mp4' WHEN 1 THEN '.MP4' ELSE '' END || ' ' AS v, CASE p_partkey % 4 WHEN 0 THEN '12 ' || p_partkey WHEN 1 THEN 'x' ELSE '' || p_partkey END AS f FROM part)")
def clean_fields(spark, t):
    """T15-T17."""
    rows = t("part").selectExpr("p_partkey", "p_name", "concat(' L', p_partkey, case p_partkey % 3 when 0 then '.mp4' when 1 then '.MP4' else '' end, ' ') v", "case p_partkey % 4 when 0 then concat('12 ', p_partkey) when 1 then 'x' else cast(p_partkey as string) end f")
    return rows.select("p_partkey", X.clean_video_id(F.col("v")).alias("video_id"), X.clean_frame_idx(F.col("f")).alias("frame_idx"), X.clean_answer(F.col("p_name")).alias("answer"))


@query(_ranked("0.30", "true", "100") + """,
o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, c) AS rank FROM i),
n AS (SELECT qid, CASE qid WHEN 'q0' THEN 'a_kis' WHEN 'q1' THEN 'b_TRAKE' ELSE 'c_' || qid END AS name FROM q)
SELECT name, CAST(rank AS INT) AS rank, video_id || ',' || frame_idx AS line FROM o JOIN n USING (qid) WHERE rank <= 100""")
def submission_rows(spark, t):
    """Answer rows by kind of query."""
    records, index = _indexed(spark, t)
    hits = Q.search(records, _searches(spark), top_k=100, index=index)
    names = _searches(spark).select("qid", F.when(F.col("qid") == "q0", "a_kis").when(F.col("qid") == "q1", "b_TRAKE").otherwise(F.concat(F.lit("c_"), "qid")).alias("name"))
    return K.answer_rows(hits, names).select("name", "rank", K.csv_line(F.col("fields")).alias("line"))


@query("SELECT p_partkey, CASE WHEN contains(n, '\"') OR contains(n, ',') THEN '\"' || replace(n, '\"', '\"\"') || '\"' ELSE n END || ',' || p_partkey AS line FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || ', x' WHEN 1 THEN p_name || ' \"q\"' ELSE p_name END AS n FROM part)")
def csv_lines(spark, t):
    """K7: quoting."""
    rows = t("part").selectExpr("p_partkey", "case p_partkey % 3 when 0 then concat(p_name, ', x') when 1 then concat(p_name, ' \"q\"') else p_name end n")
    return rows.select("p_partkey", K.csv_line(F.array("n", F.col("p_partkey").cast("string"))).alias("line"))


@query("SELECT conv_id, turn FROM conversations WHERE turn * 75 BETWEEN floor(2.0 * (CASE WHEN conv_id % 2 = 0 THEN 25.0 ELSE 30.0 END)) - 200 AND floor(4.5 * (CASE WHEN conv_id % 2 = 0 THEN 25.0 ELSE 30.0 END)) + 200")
def time_range(spark, t):
    """Range predicate on frames."""
    rows = t("conversations").selectExpr("conv_id", "turn", "turn * 75 as frame_idx", "case when conv_id % 2 = 0 then 25.0D else 30.0D end fps")
    return P.frames_between(rows, 2.0, 4.5).select("conv_id", "turn")


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'V' || conv_id || '/keyframe_' || (turn * 75) || '.webp' END AS path FROM conversations")
def image_path(spark, t):
    """Where a frame's image is."""
    conv = t("conversations").selectExpr("conv_id", "turn", "concat('V', conv_id) video_id", "turn * 75 as frame_idx", "concat('f', conv_id, '-', turn) frame_id")
    known = conv.where("turn % 2 = 0").selectExpr("case when turn % 4 = 0 then frame_id else concat('x', frame_id) end frame_id", "video_id", "concat(video_id, '/keyframe_', frame_idx, '.webp') path")
    return P.image_paths(conv, known).select("conv_id", "turn", "path")


@query("""WITH c AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 1 DAY THEN 1 ELSE 0 END AS cut FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
k AS (SELECT *, sum(cut) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS track FROM c)
SELECT user_id, event_type, min(ts) AS first_at, max(ts) AS last_at, count(*) AS occurrences FROM k GROUP BY user_id, event_type, track""")
def stream_tracks(spark, t):
    """2.11: the events file as a stream, all that is there, in session windows."""
    from .sources.shared import new_folder
    from .streaming.tracks import session_tracks

    stream = _stream_of(spark, t("events")).withColumn("at", F.col("ts").cast("timestamp"))
    folder = new_folder(spark, "stream-tracks")
    tracks = session_tracks(stream, ["user_id", "event_type"], "at", "1 day")
    done = tracks.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    done.foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{folder}/tracks")).start().awaitTermination()
    return spark.read.schema(tracks.schema).parquet(f"{folder}/tracks").select("user_id", "event_type", F.col("first_at").cast("timestamp_ntz").alias("first_at"), F.col("last_at").cast("timestamp_ntz").alias("last_at"), "occurrences")
