"""A full-text index of segments, in tables that a search joins where they lie.

A segment is a folder with the index of some records, which no other segment has:

* postings (term, part, block, col, at, positions), bucketed and sorted by (term, part): at which places of a block of records a term is, and where in each of
  these. col is one of the columns, or BOTH for records whose columns have the same terms. part follows from the block, so that a frequent term is spread over
  several buckets. A batch of queries brings its terms to the buckets; postings are not exchanged. The positions of the empty term, which no text has, are the
  numbers of terms of columns.
* blocks (block, records): ids and lengths d of the records of a block, by place. What is matched meets them by block, so that no posting carries either.
* vocabulary (term, df_text, df_text_unsigned): prefixes are looked up here and never in the postings.
* records, as given; a search form that follows from the text is not written, but made again where it is read.
* stats (n_rows, total, n_terms, buckets, replaces), one row. It is written last: a segment counts only if it is there whole, and then the segments that it
  replaces no longer do.

Statistics add up over segments, so that adding records or compacting changes no score.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import let, unsigned_of_clean
from ..operators.search import MOST_LISTED, terms
from .shared import release
from .sinks import exists

COLUMNS = ("text", "text_unsigned")
#: Instead of a column: both, which have the same terms in the same order.
BOTH = "both"
#: Parts of a frequent term.
PARTS = 8
#: Postings (occurrences) that a bucket of a new segment is meant to hold.
BUCKET_ROWS = 4_000_000
#: Columns of records whose occurrences a task gathers at once.
RECORDS_AT_ONCE = 500
#: Records of a block, and occurrences of one that a task gathers at once.
BLOCK, TERMS_AT_ONCE = 2000, 300_000
#: Bytes of postings that a task holds until it deals them out: so many for each bucket, and in all at least and at most.
FOLD_BYTES, LEAST_FOLDED, MOST_FOLDED = 50_000, 8_000_000, 64_000_000
#: Bytes of a text for each of its terms, about, from which the buckets of a new segment are chosen.
TERM_BYTES = 6
#: Letters that keep a mark, or their own form, in a text's index terms but not in those of its search form are among these.
DIFFERENT = "đĐ\u1ea0-\u1ef9"
#: Terms of a batch of queries that are broadcast (some 10 MB); more are brought to the buckets by an exchange.
MOST_WANTED = 300_000
#: Terms that the queries of a batch may have themselves.
MOST_STEPS = 300_000
#: A batch of so few terms looks them up first, so that only their row groups are read.
FEW_STEPS = 60
POSTING = "term string, part int, col string, id bigint, tf bigint, d int, positions array<int>"
PACKED = "term string, part int, block bigint, col string, at array<int>, positions array<array<int>>"
STATS = "n_rows bigint, total bigint, n_terms bigint, buckets int, replaces array<string>"


class Segment:
    def __init__(self, spark: SparkSession, folder: str, name: str, stats: dict):
        self.spark, self.at, self.name, self.stats = spark, f"{folder}/{name}", name, stats

    def table(self, name: str) -> DataFrame:
        return _as_given(self.spark.read.parquet(f"{self.at}/{name}")) if name == "records" else self.spark.read.parquet(f"{self.at}/{name}")

    def postings(self) -> DataFrame:
        """As a table of the session's catalog, which knows of buckets."""
        table = f"inkframe_{self.name.replace('-', '_')}"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({PACKED}) USING parquet CLUSTERED BY (term, part) SORTED BY (term, part) INTO {self.stats['buckets']} BUCKETS LOCATION '{self.at}/postings'")
        return self.spark.table(table)


def _shortened(records: DataFrame) -> DataFrame:
    """Records without the search forms that follow from their texts; _follows tells which."""
    follows = F.col("text_unsigned").eqNullSafe(unsigned_of_clean(F.col("text")))
    return records.select(*[F.when(~follows, F.col(c)).alias(c) if c == "text_unsigned" else F.col(c) for c in records.columns], follows.alias("_follows"))


def _form() -> Column:
    return F.when(F.col("_follows"), unsigned_of_clean(F.col("text"))).otherwise(F.col("text_unsigned"))


def _as_given(rows: DataFrame) -> DataFrame:
    return rows.select(*[_form().alias(c) if c == "text_unsigned" else F.col(c) for c in rows.columns if c != "_follows"])


def _batch(found: dict[str, pa.Array], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c.split()[0]: found[c.split()[0]] for c in schema.split(", ")})


def _by_term(words: pa.RecordBatch) -> dict[str, pa.Array]:
    """Rows of a record's column (ts and others) -> a row for each of its terms, with the positions in order."""
    row, terms_of = pc.list_parent_indices(words["ts"]).to_numpy(), words["ts"].flatten().dictionary_encode()
    code, first = terms_of.indices.to_numpy(), np.searchsorted(row, np.arange(len(words)))
    key = row * max(1, len(terms_of.dictionary)) + code
    order = np.argsort(key, kind="stable")
    begins = np.flatnonzero(np.diff(key[order], prepend=-1))
    ends = np.append(begins[1:], len(order))
    at, places = row[order[begins]], pa.array((order - first[row[order]]).astype(np.int32))
    found = {c: words[c].take(pa.array(at)) for c in words.schema.names if c != "ts"} | {"term": terms_of.dictionary.take(pa.array(code[order[begins]])), "tf": pa.array(ends - begins, pa.int64())}
    found["positions"] = pa.ListArray.from_arrays(pa.array(np.append(begins, len(order)).astype(np.int32)), places)
    return found


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, len(batch), RECORDS_AT_ONCE):
            yield _batch(_by_term(batch.slice(k, RECORDS_AT_ONCE)), POSTING)


def _by_block(words: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of a record's column (part, block, col, at, ts) -> PACKED rows: a term's records in a block, and lengths as those of the empty term."""
    found, lengths = _by_term(words), pc.list_value_length(words["ts"])
    found |= {c: pa.concat_arrays([found[c], words[c]]) for c in ("part", "block", "col", "at")} | {"term": pa.concat_arrays([found["term"], pa.array([""] * len(words), pa.string())])}
    found["positions"] = pa.concat_arrays([found["positions"], pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32)), lengths)])
    keys = [found[c].dictionary_encode().indices.to_numpy() for c in ("block", "term", "col")]
    order = np.lexsort((found["at"].to_numpy(), *keys[::-1]))
    begins = np.flatnonzero(np.any([np.diff(k[order], prepend=-1) for k in keys], axis=0))
    ends = pa.array(np.append(begins, len(order)).astype(np.int32))
    packed = {c: found[c].take(pa.array(order[begins])) for c in ("term", "part", "block", "col")}
    return _batch(packed | {c: pa.ListArray.from_arrays(ends, found[c].take(pa.array(order))) for c in ("at", "positions")}, PACKED)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block at once, a batch's end and long texts apart."""
    for batch in batches:
        sizes = np.cumsum(pc.list_value_length(batch["ts"]).to_numpy(zero_copy_only=False))
        begins = np.flatnonzero(np.diff(batch["block"].to_numpy(), prepend=-1) | np.diff(sizes // TERMS_AT_ONCE, prepend=0))
        for k, end in zip([0, *begins[begins > 0]], [*begins[begins > 0], len(batch)], strict=True):
            yield _by_block(batch.slice(k, end - k))
        pa.default_memory_pool().release_unused()


def _folded(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (home and others) -> a row for each home with its rows as compressed columns, so that many rows are exchanged as one. Up to about so many bytes are held."""

    def folded(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).sort_by([("home", "ascending"), ("term", "ascending")])
        home = rows["home"].to_numpy()
        begins, out = np.flatnonzero(np.diff(home, prepend=-1)), []
        for k, end in zip(begins, np.append(begins[1:], len(home)), strict=True):
            sink = pa.BufferOutputStream()
            pq.write_table(rows.slice(k, end - k).drop_columns(["home"]), sink, compression="zstd")
            out.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(home[begins], pa.int32()), pa.array(out, pa.binary())], ["home", "folded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > most:
                yield folded(held)
                held, size = [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield folded(held)

    return run


def _unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in batch["folded"]:
            yield from pq.read_table(pa.BufferReader(rows.as_buffer()), use_threads=False).to_batches()
        pa.default_memory_pool().release_unused()


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """PACKED rows, those of a bucket in one partition."""
    most = min(MOST_FOLDED, max(LEAST_FOLDED, FOLD_BYTES * buckets))
    homes = rows.select(F.pmod(F.hash("term", "part"), F.lit(buckets)).alias("home"), "*").mapInArrow(_folded(most), "home int, folded binary")
    return homes.repartition(buckets, "home").select("folded").mapInArrow(_unfolded, PACKED)


def _postings(records: DataFrame) -> DataFrame:
    """POSTING rows of both columns. A record's occurrences of a term are gathered where the record is, so that no single occurrence is exchanged or sorted."""
    words = records.select(F.col("id").cast("bigint").alias("id"), *[terms(F.col(c)).alias(c) for c in COLUMNS])
    words = words.select("id", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int").alias("part"), sum(F.size(c) for c in COLUMNS).cast("int").alias("d"), F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("ts")) for c in COLUMNS])).alias("c"))
    return words.select("part", "c.col", "id", "d", "c.ts").mapInArrow(_grouped, POSTING)


def _placed(records: DataFrame, name: str) -> DataFrame:
    """(block, at, id and the terms of both columns) of written records: the block and the place in it tell the file and the row. Where the second column has the
    terms of the first, and this is known without taking it apart, they are null."""
    row = F.col("_metadata.row_index")
    block = F.xxhash64(F.lit(name), F.col("_metadata.file_name"), F.floor(row / BLOCK)).alias("block")
    alike = F.coalesce(F.col("_follows") & ((F.octet_length("text") == F.char_length("text")) | ~F.col("text").rlike(f"[{DIFFERENT}]")), F.lit(False))
    two = F.when(~alike, let(_form(), terms))
    return records.select(block, F.pmod(row, F.lit(BLOCK)).cast("int").alias("at"), F.col("id").cast("bigint").alias("id"), terms(F.col(COLUMNS[0])).alias(COLUMNS[0]), two.alias(COLUMNS[1]))


def _packed(placed: DataFrame) -> DataFrame:
    """PACKED rows of what _placed gives, a row for a term of a block and column; no single occurrence or record is exchanged or sorted."""
    each = [F.struct(F.lit(c).alias("col"), F.col(c).alias("ts")) for c in COLUMNS]
    same = F.array(F.struct(F.lit(BOTH).alias("col"), F.col(COLUMNS[0]).alias("ts")))
    words = placed.select("block", "at", F.explode(F.when(F.col(COLUMNS[1]).isNull() | (F.col(COLUMNS[0]) == F.col(COLUMNS[1])), same).otherwise(F.array(*each))).alias("c"))
    return words.select(F.pmod("block", F.lit(PARTS)).cast("int").alias("part"), "block", "c.col", "at", "c.ts").mapInArrow(_blocked, PACKED)


def _of(column: str) -> Column:
    return F.col("col").isin(column, BOTH)


def _blocks(placed: DataFrame, postings: DataFrame) -> DataFrame:
    """(block, records): ids and lengths of a block's records."""
    told = postings.where("term = ''").select("block", F.when(F.col("col") == BOTH, 2).otherwise(1).alias("n"), F.explode(F.arrays_zip("at", "positions")).alias("o"))
    lengths = told.groupBy("block", F.col("o.at").alias("at")).agg(F.sum(F.get("o.positions", F.lit(0)) * F.col("n")).cast("int").alias("d"))
    each = F.struct("at", "id", "d").alias("r")
    listed = placed.select("block", "at", "id").join(lengths, ["block", "at"]).select("block", each).groupBy("block").agg(F.array_sort(F.collect_list("r")).alias("records"))
    return listed.select("block", F.transform("records", lambda r: F.struct(r["id"], r["d"])).alias("records"))


@contextlib.contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows, unless the session sets its own number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name, None) is None or spark.conf.get(name) == "10000"
    if own:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        if own:
            spark.conf.unset(name)


def _write(spark: SparkSession, folder: str, name: str, blocks: Callable[[DataFrame], DataFrame], postings: DataFrame, about: int, replaces: list[str]) -> Segment:
    """What belongs to records that are written already. postings: rows of PACKED, about so many occurrences; blocks: gives the blocks of the written postings."""
    buckets = max(spark.sparkContext.defaultParallelism, -(-about // BUCKET_ROWS))
    table = f"inkframe_{name.replace('-', '_')}"
    with _batches_of(spark, BLOCK):
        _dealt(postings, buckets).write.format("parquet").bucketBy(buckets, "term", "part").sortBy("term", "part").option("compression", "zstd").option("path", f"{folder}/{name}/postings").saveAsTable(table)
    release(spark)
    segment = Segment(spark, folder, name, {"n_rows": 0, "total": 0, "n_terms": 0, "buckets": buckets, "replaces": replaces})
    blocks(spark.read.schema(PACKED).parquet(f"{segment.at}/postings")).write.option("compression", "zstd").parquet(f"{folder}/{name}/blocks")
    length = F.aggregate("records", F.lit(0).cast("bigint"), lambda n, r: n + r["d"])
    n_rows, total = segment.table("blocks").agg(F.coalesce(F.sum(F.size("records")), F.lit(0)), F.coalesce(F.sum(length), F.lit(0))).first()
    words = segment.postings().where("term <> ''").groupBy("term").agg(*[F.sum(F.when(_of(c), F.size("at")).otherwise(0)).alias(f"df_{c}") for c in COLUMNS])
    words.repartitionByRange("term").sortWithinPartitions("term").write.option("compression", "zstd").parquet(f"{folder}/{name}/vocabulary")
    segment.stats |= {"n_rows": n_rows, "total": total, "n_terms": segment.table("vocabulary").count()}
    spark.createDataFrame([(n_rows, total, segment.stats["n_terms"], buckets, replaces)], STATS).coalesce(1).write.parquet(f"{folder}/{name}/stats")
    return segment


def _named(records: DataFrame, folder: str) -> tuple[str, DataFrame]:
    """The name of a new segment, and its records as they lie on disk."""
    name, rows = f"seg-{uuid.uuid4().hex}", _shortened(records)
    rows.write.option("compression", "zstd").parquet(f"{folder}/{name}/records")
    return name, records.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{name}/records")


def add_segment(records: DataFrame, folder: str) -> Segment:
    """Index records (id, text, text_unsigned and what else hits show), whose ids no segment below the folder has."""
    name, written = _named(records, folder)
    placed = _placed(written, name)
    held = written.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length(F.when(F.col("_follows"), F.col("text")).otherwise(F.coalesce("text_unsigned", F.lit(""))))), F.lit(0))).first()[0]
    return _write(records.sparkSession, folder, name, lambda postings: _blocks(placed, postings), _packed(placed), held // TERM_BYTES, [])


class TermIndex:
    """The segments that count below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        jvm = spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(folder)
        found = [s.getPath().getName() for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)] if exists(spark, folder) else []
        whole = [n for n in found if n.startswith("seg-") and exists(spark, f"{folder}/{n}/stats/_SUCCESS")]
        told = {n: spark.read.schema(STATS).parquet(f"{folder}/{n}/stats").first().asDict() for n in whole}
        gone = {r for s in told.values() for r in s["replaces"]}
        self.segments = [Segment(spark, folder, n, told[n]) for n in sorted(whole) if n not in gone]
        self.replaced = sorted(gone & set(found))

    def _union(self, name: str) -> DataFrame | None:
        tables = [s.table(name) for s in self.segments]
        out = tables[0] if tables else None
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    def records(self) -> DataFrame:
        return self._union("records")

    def vocabulary(self) -> DataFrame:
        """(term, df_text, df_text_unsigned): how many records hold a term in a column."""
        words = self._union("vocabulary")
        return words if len(self.segments) < 2 else words.groupBy("term").agg(*[F.sum(f"df_{c}").alias(f"df_{c}") for c in COLUMNS])

    def sizes(self) -> tuple[int, float]:
        """How many records there are, and their mean length in terms of both columns."""
        n = sum(s.stats["n_rows"] for s in self.segments)
        return n, sum(s.stats["total"] for s in self.segments) / max(n, 1)

    def wanted(self, steps: DataFrame) -> DataFrame:
        """steps (ph, k, size, want, prefix) -> a row for each term of the vocabulary that is asked for: term, asked (array of ph, k, size)."""
        words = self.vocabulary().select("term")
        heads = steps.where("prefix").withColumn("length", F.length("want"))
        exact = words.join(F.broadcast(steps.where("not prefix").withColumnRenamed("want", "term")), "term")
        # by their leading characters at the lengths that occur, of which there are as many as a query's word has letters
        lengths = F.array_sort(F.array(*[F.lit(r["length"]) for r in heads.select("length").distinct().collect()])) if heads.limit(1).count() else F.array().cast("array<int>")
        near = words.withColumn("length", F.explode(F.filter(lengths, lambda n: n <= F.length("term")))).withColumn("want", F.expr("substr(term, 1, length)")).join(F.broadcast(heads), ["length", "want"])
        both = exact.select("term", "ph", "k", "size").unionByName(near.select("term", "ph", "k", "size"))
        return both.groupBy("term").agg(F.collect_list(F.struct("ph", "k", "size")).alias("asked"))

    def matches(self, phrases: list[dict]) -> DataFrame:
        """(block, ph, id, col, tf, d), dealt out by block, of which a record has one: how often each phrase (ph int, tok, terms) is in each record. The last term of a phrase with tok >= 0 is a prefix.

        Terms are found in the vocabulary. They are broadcast if there are at most MOST_WANTED, else brought to the buckets of the postings, which stay where they are.
        """
        steps = [(p["ph"], k, len(p["terms"]), t, p["tok"] >= 0 and k == len(p["terms"]) - 1) for p in phrases for k, t in enumerate(p["terms"])]
        if len(steps) > MOST_STEPS:
            raise ValueError(f"a batch of queries has at most {MOST_STEPS} terms")
        wanted = self.wanted(self.spark.createDataFrame(steps, "ph int, k int, size int, want string, prefix boolean"))
        n_terms = sum(s.stats["n_terms"] for s in self.segments)
        if len(steps) <= FEW_STEPS or n_terms > MOST_WANTED:
            few = wanted.count() <= MOST_WANTED
            listed = wanted.select("term").limit(MOST_LISTED + 1).collect() if few and len(steps) <= FEW_STEPS else []
            named = [r["term"] for r in listed] if 0 < len(listed) <= MOST_LISTED else None
        else:
            few, named = True, None
        asked, on = (F.broadcast(wanted), ["term"]) if few else (wanted.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(PARTS)]))), ["term", "part"])
        met = None
        for s in self.segments:
            rows = s.postings() if named is None else s.postings().where(F.col("term").isin(named))
            rows = rows.join(asked, on).select("block", "col", "at", "positions", "asked")
            met = rows if met is None else met.unionByName(rows)
        # the only exchange, of packed postings: ids, counts, lengths and scores are all by block. Its parts are as many as the buckets, as rows are many times what is exchanged
        met = met.repartition(sum(s.stats["buckets"] for s in self.segments), "block").join(self._union("blocks"), "block")
        held = F.transform(F.arrays_zip("at", "positions"), lambda o: F.struct(F.get("records", o["at"]).alias("r"), o["positions"].alias("positions")))
        rows = met.select("block", "col", "asked", F.explode(held).alias("h")).select("block", "col", "h.r.id", "h.r.d", "h.positions", F.explode("asked").alias("a"))
        # of a phrase of several terms each occurrence counts, at the place where the phrase would begin
        single = F.col("size") == 1
        begins = F.when(F.col("a.size") == 1, F.array(F.lit(-1))).otherwise(F.transform("positions", lambda p: p - F.col("a.k")))
        rows = rows.select("block", "col", "id", "d", "a.ph", "a.size", F.when(F.col("a.size") == 1, F.size("positions")).otherwise(F.lit(1)).alias("n"), F.explode(begins).alias("at"))
        found = rows.groupBy("block", "ph", "size", "id", "d", "at").agg(*[F.sum(F.when(_of(c), F.col("n")).otherwise(0)).alias(c) for c in COLUMNS])
        tf = found.groupBy("block", "ph", "id", "d").agg(*[F.sum(F.when(single, F.col(c)).otherwise((F.col(c) == F.col("size")).cast("bigint"))).alias(c) for c in COLUMNS])
        each = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("tf")) for c in COLUMNS])
        return tf.select("block", "ph", "id", "d", F.explode(each).alias("c")).select("block", "ph", "id", "c.col", "c.tf", "d").where("tf > 0")

    def compact(self, factor: int = 4) -> Segment | None:
        """Merge the smallest segments into one if at least `factor` of them are within a factor of that of the largest among them; returns it."""
        by_size = sorted(self.segments, key=lambda s: s.stats["total"])
        group = [s for s in by_size if s.stats["total"] <= factor * max(1, by_size[0].stats["total"])] if by_size else []
        if len(group) < factor:
            return None

        def merged(name: str) -> DataFrame:
            out = group[0].postings() if name == "postings" else group[0].table(name)
            for s in group[1:]:
                out = out.unionByName(s.postings() if name == "postings" else s.table(name))
            return out

        name, _ = _named(merged("records"), self.folder)
        return _write(self.spark, self.folder, name, lambda postings: merged("blocks"), merged("postings"), sum(s.stats["total"] for s in group), [s.name for s in group])

    def vacuum(self) -> None:
        """Delete replaced segments, which no search reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for n in self.replaced:
            self.spark.sql(f"DROP TABLE IF EXISTS inkframe_{n.replace('-', '_')}")
            at = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}")
            at.getFileSystem(conf).delete(at, True)
        self.replaced = []
