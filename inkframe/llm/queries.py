"""The queries of this subpackage, by the names under which they are registered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles at 0.9, with the number of links. Null, empty and repeated rows: see jaccard_groups."""
    from .jaccard_join import jaccard_groups

    groups = jaccard_groups(_table(spark, sf_dir, "documents"), words=3, similarity=(90, 100), count_links=True)
    return groups.select("doc_id", "n_shingles", "component_id", "n_links")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards in the shared folder, read back. Null texts are the end id alone; null doc_ids come first; repeated rows each have their place."""
    from .token_store import token_store

    return token_store(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2).drop("file")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document; null and empty texts count 0, whole texts of any length are counted."""
    from .token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document; null texts have no words, items without words no window, an empty benchmark marks nothing."""
    from .decontaminate import contamination

    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document; null texts and texts without a letter are und, as is all without labels to learn from."""
    from .language_id import language_id

    return language_id(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document with its copies. A null source is a source of its own; null and empty texts have 0 tokens; repeated rows are planned each."""
    from .mixing import plan_mix

    return plan_mix(_table(spark, sf_dir, "documents"), entropy=0.95, repeats=4.0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document; null and empty texts score as texts without a toxic word; without both labels all scores are 0."""
    from .toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 5 rows per query. Null vectors and vectors with null or non-finite components take no part; ties go to the smaller vec_id."""
    from .knn_join import knn_join

    return knn_join(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document; null texts are empty, repeated rows are copies of each other. passage_words finds shorter passages of over 50 words."""
    from .suffix_dedup import repeated_strings

    return repeated_strings(_table(spark, sf_dir, "documents"), length=400).drop("spans")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / group of 1000 / group of 50, the first of each 50 as its LICENSE file."""
    from pyspark.sql import functions as F

    from .license_scan import license_scan

    name = F.when(F.col("doc_id") % 50 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.when(F.col("doc_id") % 100 < 50, F.floor(F.col("doc_id") / 100).cast("string")), name)
    return license_scan(_table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path")), threshold=0.6)


def op11_cow_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per remaining file. Clients and changes without an id take no part; a change without a change_id or op sets; see upsert for the rest."""
    from .upsert import client_upsert

    return client_upsert(_table(spark, sf_dir, "clients"), _table(spark, sf_dir, "client_changes"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per part, order of the five filters and step. Null texts are empty, a null source is the part ''; repeated rows count each."""
    from .filter_audit import filter_audit

    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document; shards differ by one row at most. Null texts are empty; rows of null or repeated doc_ids are rows like others."""
    from .sharding import shard_documents

    return shard_documents(_table(spark, sf_dir, "documents"), shards=8)


QUERIES = {
    "op11_cow_upsert": op11_cow_upsert,
    "op12_filter_audit": op12_filter_audit,
    "op13_sharding": op13_sharding,
    "op10_license_scan": op10_license_scan,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op1_source_mixing": op1_source_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_knn_join": op8_knn_join,
    "op6_decontaminate": op6_decontaminate,
    "op9_language_id": op9_language_id,
    "op4_token_store": op4_token_store,
    "op5_token_counts": op5_token_counts,
    "op2_jaccard_join": op2_jaccard_join,
}

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _bag(c: str) -> str:
    return f"list_filter(list_transform(string_split_regex(lower({c}), '[^a-z0-9.]+'), lambda w: regexp_replace(w, '^[.]+|[.]+$', '', 'g')), lambda w: w <> '')"


def _licence_sql() -> str:
    from .license_scan import TEMPLATES

    listed = ", ".join(f"('{n}', '{t}')" for n, t in TEMPLATES.items())
    return f"""
WITH f AS (SELECT doc_id, text, concat_ws('/', source, CAST(doc_id // 1000 AS VARCHAR), CASE WHEN doc_id % 100 < 50 THEN CAST(doc_id // 100 AS VARCHAR) END, CASE WHEN doc_id % 50 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END) AS path FROM documents),
b AS (SELECT name, unnest({_bag("t")}) AS term FROM (VALUES {listed}) v(name, t)),
n AS (SELECT count(*) AS n FROM f), fw AS (SELECT DISTINCT doc_id, unnest({_bag("coalesce(text, '')")}) AS term FROM f),
idf AS (SELECT term, round(ln((max(n) + 1) / (count(doc_id) + 1)) + 1, 9) AS idf FROM (SELECT DISTINCT term FROM b) LEFT JOIN fw USING (term) CROSS JOIN n GROUP BY term),
tw AS (SELECT name, term, count(*) * any_value(idf) AS w FROM b JOIN idf USING (term) GROUP BY name, term),
ts AS (SELECT name, sqrt(sum(w * w)) AS size FROM tw GROUP BY name),
l AS (SELECT doc_id, unnest(u) AS line, generate_subscripts(u, 1) AS at_ FROM (SELECT doc_id, list_concat(string_split(text, chr(10)), CASE WHEN doc_id % 50 = 0 THEN [text] ELSE [] END) AS u FROM f)),
c AS (SELECT doc_id, at_, term, count(*) * any_value(coalesce(idf, u)) AS w FROM (SELECT doc_id, at_, unnest({_bag("line")}) AS term FROM l) LEFT JOIN idf USING (term) CROSS JOIN (SELECT round(ln(n + 1) + 1, 9) AS u FROM n) GROUP BY doc_id, at_, term),
m AS (SELECT doc_id, at_, sqrt(sum(w * w)) AS norm FROM c GROUP BY doc_id, at_),
s AS (SELECT doc_id, name, round(sum(c.w * tw.w / size) / any_value(norm), 6) AS score FROM c JOIN tw USING (term) JOIN ts USING (name) JOIN m USING (doc_id, at_) GROUP BY doc_id, at_, name),
o AS (SELECT doc_id, arg_min(name, (-score, name)) AS own, max(score) AS own_score FROM s WHERE score >= 0.6 GROUP BY doc_id),
p AS (SELECT f.*, own, own_score, regexp_replace(path, '/?[^/]*$', '') AS dir FROM f LEFT JOIN o USING (doc_id)),
g AS (SELECT dir AS above, arg_min(own, (-own_score, own)) AS granted FROM p WHERE doc_id % 50 = 0 AND own IS NOT NULL GROUP BY dir),
h AS (SELECT dir, level, array_to_string(string_split(dir, '/')[1 : level], '/') AS above FROM (SELECT DISTINCT dir, unnest(range(1, len(string_split(dir, '/')) + 1)) AS level FROM p)),
r AS (SELECT dir, arg_max(granted, level) AS granted, arg_max(above, level) AS above, max(level) AS level FROM h JOIN g USING (above) GROUP BY dir)
SELECT doc_id, path, own AS own_license, own_score, coalesce(own, granted) AS license, CASE WHEN own IS NULL THEN above END AS inherited_from, CAST(CASE WHEN own IS NULL THEN level END AS INT) AS depth FROM p LEFT JOIN r USING (dir)"""


_AUDIT_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word FROM d) GROUP BY rid, word),
t AS (SELECT rid, sum(n) AS words, count(*) AS kinds FROM w GROUP BY rid),
e AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN coalesce(words, 0) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * coalesce(kinds, 0) < 50 * coalesce(words, 0) THEN 2 ELSE 0 END
 + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS m
 FROM d LEFT JOIN t USING (rid) LEFT JOIN e USING (text) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, m),
g AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, v)),
p AS (SELECT o, [a, b, x, y, z] AS fs FROM (SELECT a.f || b.f || x.f || y.f || z.f AS o, a.v AS a, b.v AS b, x.v AS x, y.v AS y, z.v AS z FROM g a JOIN g b ON b.f <> a.f JOIN g x ON x.f NOT IN (a.f, b.f) JOIN g y ON y.f NOT IN (a.f, b.f, x.f) JOIN g z ON z.f NOT IN (a.f, b.f, x.f, y.f))),
s AS (SELECT o AS filter_order, k AS step, fs[k] AS f, coalesce(list_sum(fs[1 : k - 1]), 0)::INT AS b FROM p, range(1, 6) r(k)),
a AS (SELECT part, filter_order, CAST(step AS INT) AS step, f, sum(CASE WHEN m & (f | b) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN m & f <> 0 AND m & b = 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN m & f <> 0 AND m & b <> 0 THEN n ELSE 0 END) AS redundant,
 sum(CASE WHEN m = f THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN m & f <> 0 AND m & b = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN m & f <> 0 AND m & b = 0 THEN toxic ELSE 0 END) AS toxic_lost FROM c, s GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
 CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM a"""


#: DuckDB SQL by query name; what SQL cannot express is tested against brute force.
ORACLE: dict[str, str] = {
    "op12_filter_audit": _AUDIT_SQL,
    "op10_license_scan": _licence_sql(),
    "op1_source_mixing": """
WITH RECURSIVE r AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS key, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS n_tokens,
 CAST('0x' || substr(md5('mix|' || name), 1, 12) AS BIGINT) AS h1, CAST('0x' || substr(md5('mix|doc|' || name), 1, 12) AS BIGINT) AS h2, name FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, '')) AS name FROM documents)),
t AS (SELECT key, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM r GROUP BY key),
c AS (SELECT CAST(max(tokens) AS DOUBLE) AS mx, CAST(min(tokens) FILTER (tokens > 0) AS DOUBLE) AS mn, CAST(sum(tokens) AS DOUBLE) AS b, list(tokens / CAST((SELECT max(tokens) FROM t) AS DOUBLE)) FILTER (tokens > 0) AS l FROM t),
s(i, lo, hi, flo, fhi) AS (SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
 SELECT i + 1, CASE WHEN e THEN m ELSE lo END, CASE WHEN e THEN hi ELSE m END, CASE WHEN f THEN fm ELSE flo END, CASE WHEN f THEN fhi ELSE fm END FROM (
 SELECT *, ln(list_sum(list_transform(l, lambda x: pow(x, m)))) - m * list_sum(list_transform(l, lambda x: pow(x, m) * ln(x))) / list_sum(list_transform(l, lambda x: pow(x, m))) >= 0.95 * ln(len(l)) AS e,
  b * pow(mn / mx, fm) / list_sum(list_transform(l, lambda x: pow(x, fm))) / mn > 4.0 AS f FROM (SELECT *, (lo + hi) / 2 AS m, (flo + fhi) / 2 AS fm FROM s, c WHERE i < 45))),
a AS (SELECT CASE WHEN mx = mn THEN 1.0 ELSE round(greatest(CASE WHEN hi = 1.0 THEN 1.0 ELSE lo END, CASE WHEN flo = 0.0 THEN 0.0 ELSE flo END), 6) END AS a, mx, b FROM s, c WHERE i = 45),
w AS (SELECT key, tokens, CASE WHEN tokens > 0 THEN pow(tokens / mx, a) ELSE 0 END AS p, b FROM t, a),
q AS (SELECT key, tokens, round(p / (SELECT sum(p) FROM w), 9) AS weight, b, greatest(1, CAST(ceil(tokens / 262144.0) AS BIGINT)) AS blocks FROM w),
d AS (SELECT r.*, weight, h1 % blocks AS block, tokens, CAST(floor(weight * b + 0.5) AS BIGINT) AS quota FROM r JOIN q USING (key)),
k AS (SELECT key, block, sum(n_tokens) AS bt, any_value(tokens) AS tokens, any_value(quota) AS quota FROM d GROUP BY key, block),
o AS (SELECT *, row_number() OVER v AS block_rank, coalesce(sum(bt) OVER (PARTITION BY key ORDER BY md5('mix|' || key || '|' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k WINDOW v AS (PARTITION BY key ORDER BY md5('mix|' || key || '|' || block), block)),
u AS (SELECT d.*, sum(n_tokens) OVER (PARTITION BY key, block ORDER BY h2, name ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT u.doc_id, u.source, u.n_tokens, u.weight, u.block, CAST(block_rank AS INT) AS block_rank,
 CAST(CASE WHEN u.tokens > 0 THEN u.quota // u.tokens ELSE 1 END + CASE WHEN u.tokens > 0 AND u.quota % u.tokens > 0 AND before + upto <= u.quota % u.tokens THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM u JOIN o USING (key, block)""",
    "op2_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 3 THEN w ELSE w[i : i + 2] END, ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * same >= 90 * (x.n + y.n - same)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) AS component_id, coalesce(k.k, 0) AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM u GROUP BY a) k USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) m USING (doc_id)""",
    "op6_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item_id, w, least(10, len(w)) AS size FROM i WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, size, array_to_string(w[j : j + size - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS j FROM k)),
x AS (SELECT doc_id, size, j, array_to_string(w[j : j + size - 1], ' ') AS win FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS j FROM d CROSS JOIN (SELECT DISTINCT size FROM p))),
h AS (SELECT doc_id, j, size, item_id FROM x JOIN p USING (size, win)),
c AS (SELECT doc_id, count(DISTINCT o) AS n FROM (SELECT doc_id, unnest(range(j, j + size)) AS o FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op8_knn_join": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(list_zip(q.e, x.e), lambda p: p[1] * p[2])) AS score FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM s QUALIFY rank <= 5""",
}
