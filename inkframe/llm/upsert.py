"""Keyed upsert of a table of sorted Parquet files, by copy on write.

A table is a folder of files that are sorted by an integer key and follow each other. What is known of each file is in its footer: the least and greatest
key are its fences. Beside the table each file has a Bloom filter of its keys. A change has a home, the last file that begins at or below its
key, else the first. A delete whose key lies outside the fences of its home or is not in its home's filter is of an absent key and goes, without a
look at rows. What is left is joined with the rows of the homes that are asked for; the changes that differ from them say which files
are read, merged and written again. All other files stay as they are.

Rows never pass through the driver, nor a file's worth of them through a grouped state: the rows of all rewritten files are put into
one global order, in which every new file is a range of places, and each file is written by one task, row by row. The driver plans on what it knows of
files (four numbers each, at most MOST_FILES of them). Filters are read by the tasks that ask for them, which go through keys in order and so
need one filter at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from .hashing import U, mix, trimmed
from .ranks import ranked
from .scratch import Scratch

#: A larger table has to be divided into several; fences of so many files are 24 MB.
MOST_FILES = 1 << 20
#: Bits of a filter for each key, and how many of these a key sets: about one absent key in 120 passes.
BITS, PROBES = 10, 7
_FOOTER = "file string, path string, first long, last long, n_rows long, columns string"


def _opened(uri: str):
    store, at = fs.FileSystem.from_uri(uri)
    return store.open_input_file(at)


def _spots(keys: np.ndarray, size: int) -> np.ndarray:
    """The bits that each key sets in a filter of `size` bits."""
    h = mix(keys.astype(np.int64).view(U))
    step = (h >> U(32)) | U(1)
    return ((h & U(0xFFFFFFFF))[:, None] + step[:, None] * np.arange(PROBES, dtype=U)[None, :]) % U(size)


def bloom(parts: Iterator[np.ndarray], n: int) -> np.ndarray:
    """A filter, a byte for eight bits, of the n keys that come in parts."""
    bits = np.zeros(max(64, BITS * n + 7 & ~7), bool)
    for keys in parts:
        bits[_spots(keys, len(bits)).ravel().astype(np.int64)] = True
    return np.packbits(bits)


def held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a filter may have each key; never false for a key that it has."""
    spots = _spots(keys, 8 * len(bits)).astype(np.int64)
    return ((bits[spots >> 3] >> (7 - (spots & 7))) & 1).all(axis=1)


def _footers(key: str, blooms: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                with _opened(uri) as source:
                    file = pq.ParquetFile(source)
                    told = file.metadata
                    at = file.schema_arrow.names.index(key)
                    stats = [told.row_group(g).column(at).statistics for g in range(told.num_row_groups)]
                    name = uri.rsplit("/", 1)[-1]
                    rows.append((name, uri, min(s.min for s in stats), max(s.max for s in stats), told.num_rows, ",".join(file.schema_arrow.names)))
                    if blooms is not None:
                        bits = bloom((b.column(0).to_numpy() for b in file.iter_batches(columns=[key])), told.num_rows)
                        store, root = fs.FileSystem.from_uri(blooms)
                        store.create_dir(root, recursive=True)
                        with store.open_output_stream(f"{root}/{name}.bloom", compression=None) as out:
                            out.write(bits.tobytes())
        if rows:
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [c.split()[0] for c in _FOOTER.split(", ")])

    return trimmed(run)


def footers(spark: SparkSession, paths: list[str], key: str, blooms: str | None = None) -> DataFrame:
    """file, path, first, last, n_rows, columns of Parquet files that have rows, as their footers say; with blooms also writes a filter of each
    file's keys into that folder."""
    if len(paths) > MOST_FILES:
        raise ValueError(f"{len(paths)} files: a table has at most {MOST_FILES}")
    many = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(many).mapInArrow(_footers(key, blooms), _FOOTER)


class SortedTable:
    """A folder of sorted files, with what the driver knows of each."""

    def __init__(self, spark: SparkSession, folder: str, schema, key: str, blooms: str):
        self.spark, self.folder, self.schema, self.key, self.blooms = spark, folder, schema, key, blooms
        self.names: list[str] = []
        self.first = self.last = np.zeros(0, np.int64)

    def paths(self) -> list[str]:
        """Files of the folder that have been written by Spark."""
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.folder)
        store = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(at):
            return []
        found = self.spark.read.schema(self.schema).parquet(self.folder).inputFiles()
        return sorted(found)

    def learn(self) -> None:
        """Read all footers, and write the filters of files."""
        told = sorted(footers(self.spark, paths, self.key, self.blooms).collect(), key=lambda r: (r["first"], r["last"], r["file"])) if (paths := self.paths()) else []
        self.names, self.at = [r["file"] for r in told], [r["path"] for r in told]
        self.first, self.last = (np.array([r[c] for r in told], np.int64) for c in ("first", "last"))

    def rows(self, files: list[int]) -> DataFrame:
        """The rows of some files: home, k and row, a struct of all columns."""
        read = self.spark.read.schema(self.schema).parquet(*[self.at[i] for i in files])
        named = self.spark.createDataFrame([(self.names[i], i) for i in files], "file string, home int")
        packed = read.select(F.col("_metadata.file_name").alias("file"), F.col(self.key).cast("long").alias("k"), F.struct(*[F.col(f"`{c}`") for c in self.schema.names]).alias("row"))
        return packed.join(F.broadcast(named), "file").drop("file")

    def home(self, key: Column) -> Column:
        """struct(home, first, inside): the file of a key, where it begins, and whether the key lies within its fences."""
        known = self.spark.sparkContext.broadcast((self.first, self.last))

        @pandas_udf("home int, first long, inside boolean")
        def find(keys: pd.Series) -> pd.DataFrame:
            first, last = known.value
            k = keys.to_numpy(np.int64)
            at = np.maximum(np.searchsorted(first, k, "right") - 1, 0)
            return pd.DataFrame({"home": at.astype(np.int32), "first": first[at], "inside": (k >= first[at]) & (k <= last[at])})

        return find(key)


def _present(names: list[str], blooms: str):
    """Keeps the rows (k, home, ...) whose key the filter of their home may have. Rows come in the order of homes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = -1, np.zeros(8, np.uint8)
        for batch in batches:
            home, k = batch.column("home").to_numpy(), batch.column("k").to_numpy()
            keep = np.zeros(len(home), bool)
            for h in np.unique(home).tolist():
                if h != now:
                    with _opened(f"{blooms}/{names[h]}.bloom") as source:
                        now, bits = h, np.frombuffer(source.read(), np.uint8)
                some = np.flatnonzero(home == h)
                keep[some] = held(bits, k[some])
            yield batch.filter(pa.array(keep))

    return trimmed(run)


def write_sorted(packed: DataFrame, bounds: list[int] | int, table: SortedTable) -> None:
    """Add rows (rank, row) to a table as files of the ranks [bounds[i], bounds[i + 1]), or of so many rows each; a file is one task's."""
    if isinstance(bounds, int):
        size, files = bounds, -(-packed.count() // bounds)
        number = F.floor(F.col("rank") / F.lit(size)).cast("int")
    else:
        files, known = len(bounds) - 1, table.spark.sparkContext.broadcast(np.array(bounds, np.int64))
        number = pandas_udf(lambda r: pd.Series(np.searchsorted(known.value, r.to_numpy(np.int64), "right") - 1, dtype="int32"), "int")(F.col("rank"))
    if files > MOST_FILES:
        raise ValueError(f"{files} files: a table has at most {MOST_FILES}")
    if files > 0:
        dealt = packed.select(number.alias("file"), "rank", "row").repartitionById(files, F.col("file")).sortWithinPartitions("rank")
        dealt.select("row.*").write.mode("append").option("maxRecordsPerFile", 0).parquet(table.folder)


def layout(sizes: dict[int, int], n_files: int, most: int) -> list[int]:
    """Where the new files of rewritten homes begin in the order of their rows, and the end. sizes: rows by rewritten home.

    A home becomes the fewest files of at most `most` rows, the larger ones first, at most one row apart. Then each joins
    the new file left of it, as that has grown, if no file that stays as it was lies between and both have at most `most` rows.
    """
    bounds, at, last = [0], 0, None
    for home in range(n_files):
        if home not in sizes:
            last = None
            continue
        n = sizes[home]
        k = -(-n // most)
        for i in range(k):
            size = n // k + (i < n % k)
            at += size
            if last is not None and last + size <= most:
                bounds[-1], last = at, last + size
            else:
                bounds.append(at)
                last = size
    return bounds


def upsert(table: SortedTable, changes: DataFrame, values: list[str], most: int, scratch: Scratch) -> list[str]:
    """Apply changes (k long, home int, inside boolean, gone boolean, set struct of `values`), of which a key has at most one, to a table; returns the names of
    the files that have been replaced.

    gone deletes the rows of a key in its home, else they get the values of set, and a key without rows becomes one, whose other columns are null. Rows of one key that begin in an
    earlier file than their home stay there. A null value is set like any other; nulls are equal, and so are NaNs.
    """
    changes = scratch.write(changes, "changes")
    gone = changes.where("gone and inside").repartitionByRange("k").sortWithinPartitions("k")
    maybe = gone.select("k", "home").mapInArrow(_present(table.names, table.blooms), "k long, home int").withColumn("gone", F.lit(True)).withColumn("set", F.lit(None).cast(changes.schema["set"].dataType))
    todo = scratch.write(maybe.unionByName(changes.where("not gone").select("k", "home", "gone", "set")), "todo")
    asked = sorted(r["home"] for r in todo.select("home").distinct().collect())  # at most a number per file
    if not asked:
        return []
    there = table.rows(asked).select("home", "k", F.lit(True).alias("there"), F.struct(*[F.col(f"row.`{c}`").alias(c) for c in values]).alias("is"))
    differs = F.when(F.col("there").isNull(), ~F.col("gone")).otherwise(F.col("gone") | ~F.col("set").eqNullSafe(F.col("is")))
    found = todo.join(there, ["home", "k"], "left").where(differs)
    found = scratch.write(found.select("home", "k", "gone", "set").dropDuplicates(["home", "k"]), "differences")
    chosen = sorted(r["home"] for r in found.select("home").distinct().collect())
    if not chosen:
        return []
    both = table.rows(chosen).join(found, ["home", "k"], "full_outer").where("gone is null or not gone")
    kind = table.schema[table.key].dataType

    def merged(c: str) -> Column:
        is_, new = F.col(f"row.`{c}`"), F.col("k").cast(kind) if c == table.key else F.lit(None)
        if c in values:
            return F.when(F.col("gone").isNull(), is_).otherwise(F.col(f"set.`{c}`")).cast(table.schema[c].dataType).alias(c)
        return F.when(F.col("row").isNull(), new).otherwise(is_).cast(table.schema[c].dataType).alias(c)

    rows = both.select("home", "k", F.struct(*[merged(c) for c in table.schema.names]).alias("row"))
    placed = ranked(rows.withColumn("tie", F.xxhash64("row")), ["home", "k", "tie"], scratch, "merged")
    sizes = dict.fromkeys(chosen, 0) | {r["home"]: r["n"] for r in placed.groupBy("home").agg(F.count("*").alias("n")).collect()}
    old = [table.at[h] for h in chosen]
    write_sorted(placed, layout(sizes, len(table.names), most), table)
    jvm, conf = table.spark._jvm, table.spark._jsc.hadoopConfiguration()
    for path in old:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        at.getFileSystem(conf).delete(at, False)
    return [table.names[h] for h in chosen]


def start_table(rows: DataFrame, key: str, most: int, scratch: Scratch) -> SortedTable:
    """Write rows, sorted by an integer key and then in any order that their values give, as files of `most` rows; rows without a key are left out."""
    table = SortedTable(rows.sparkSession, scratch.path("table"), rows.schema, key, scratch.path("blooms"))
    packed = rows.select(F.col(f"`{key}`").cast("long").alias("k"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")).where("k is not null")
    write_sorted(ranked(packed.withColumn("tie", F.xxhash64("row")), ["k", "tie"], scratch, "sorted"), most, table)
    table.learn()
    return table


_DIGEST = "first_id long, n_rows long, cents long, rows_crc long, ids_sha256 string, columns string, path string, rewritten boolean"


def client_upsert(clients: DataFrame, client_changes: DataFrame) -> DataFrame:
    """Changes of clients under the rules of the query, and a digest of each file that is there afterwards.

    Rows without a client_id take no part, in either table. Of the changes of a client the one with the highest seq, then change_id counts, then, of rows that tie, the one
    that is greatest by op, source, segment, city, balance; null is least. A null op is no D, and a null change_id deletes nothing by itself. Balances that are no
    numbers or infinite count 0 cents. Repeated client_ids are sorted together, and a change of them is made in their home. Further columns of clients are kept, those of changes ignored;
    without a starting file there is no home, and the result is empty.
    """
    spark = clients.sparkSession
    scratch = Scratch(spark, "upsert")
    text = lambda c: c.cast("string").cast("binary")
    most = 1 + clients.count() // 1000
    table = start_table(clients.where(F.crc32(text(F.col("client_id"))) % 7 > 3), "client_id", most, scratch)
    if not table.names:
        return spark.createDataFrame([], _DIGEST)
    values = ["source", "segment", "city", "balance"]
    rows = client_changes.where("client_id is not null").select(F.col("client_id").cast("long").alias("k"), F.struct("seq", "change_id", "op", *values).alias("c"))
    h = F.crc32(text(F.col("at.first"))) % 16
    rows = rows.withColumn("at", table.home(F.col("k"))).withColumn("h", h).where("h <= 7")
    last = rows.groupBy("k", F.col("at.home").alias("home"), F.col("at.inside").alias("inside"), "h").agg(F.max("c").alias("c"))
    gone = F.coalesce(F.col("c.op") == "D", F.lit(False)) | F.coalesce(F.crc32(text(F.col("c.change_id"))) % 8 < F.col("h"), F.lit(False))
    changes = last.select("k", "home", "inside", gone.alias("gone"), F.struct(*[F.col(f"c.{c}").cast(clients.schema[c].dataType).alias(c) for c in values]).alias("set"))
    started = set(table.names)
    upsert(table, changes, values, most, scratch)
    paths = table.paths()
    if not paths:
        return spark.createDataFrame([], _DIGEST)
    known = footers(spark, paths, "client_id").select("file", "path", "columns", (~F.col("file").isin(list(started))).alias("rewritten"))
    balance = F.col("balance").cast("double")
    cents = F.when(balance.isNull() | F.isnan(balance) | (F.abs(balance) == float("inf")), F.lit(0)).otherwise(F.floor(100 * balance + 0.5)).cast("long")
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "segment", "city")])
    read = spark.read.schema(table.schema).parquet(table.folder)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.col("client_id").cast("string").alias("id")))), lambda x: x["id"]), ",")
    each = read.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("i"), "client_id", cents.alias("c"), F.crc32(line.cast("binary")).alias("r"))
    told = each.groupBy("file").agg(F.min_by("client_id", "i").cast("long").alias("first_id"), F.count("*").alias("n_rows"), F.sum("c").alias("cents"), F.sum("r").alias("rows_crc"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"))
    return told.join(known, "file").select(*[c.split()[0] for c in _DIGEST.split(", ")])
