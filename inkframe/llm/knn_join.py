"""Exact top-k by inner product as a Voronoi join.

Vectors and queries are grouped by their nearest pivot. The summary of a group of vectors is its pivot p,
its size and its radius r, the greatest distance of a member from p. For a query q every member x has
q.p - |q| r <= q.x <= q.p + |q| r. Each query is first solved in one group, that of the pivot with the greatest product. The
k-th best score of q is at least the k-th best there, at least the k-th best among a bounded set of real vectors, and at
least what the groups' lower bounds promise; a group whose upper bound is below that cannot matter to q. Then each query
goes only to the other groups that can, meets their vectors block by block, and all answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .scratch import Scratch

#: Pivots grow as the square root of the vectors, from and up to these numbers; probe vectors. The driver and each task hold them.
PIVOTS, PROBES = (64, 4096), 1024
BLOCK, QUERY_BLOCK = 4096, 1024
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _clean(table: DataFrame) -> DataFrame:
    good = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null").where(good & (F.size("embedding") > 0))
    return rows.select("vec_id", F.transform("embedding", lambda v: F.floor(v * 256).cast("long")).alias("vector"))


def _integers(col: pa.Array) -> np.ndarray:
    """Rows of a list column; all have one length."""
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(col), -1)


def _matrix(col: pa.Array) -> np.ndarray:
    """The same as doubles, for bounds."""
    return _integers(col).astype(np.float64)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: as doubles below 2^53, as 64-bit integers below 2^63, else as Python's."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * q.shape[1]
    if most < 1 << 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 62:
        return q @ x.T
    return q.astype(object) @ x.T.astype(object)


def _grouped(pivots: np.ndarray):
    norm = (pivots**2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"))
            d = (x**2).sum(1)[:, None] + norm - 2 * (x @ pivots.T)
            g = d.argmin(1)
            # differences of large numbers lose digits: the radius must not be less than it is
            least = np.maximum(d[np.arange(len(g)), g], 0) + 1e-12 * ((x**2).sum(1) + norm[g])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(g, pa.int32()), pa.array(least)], ["vec_id", "vector", "grp", "d2"])

    return run


def _packed(label: str, most: int):
    """Rows sorted by (grp, salt) into blocks of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grp, salt = (batch.column(c).to_numpy() for c in ("grp", "salt"))
            edges = np.flatnonzero(np.r_[True, (grp[1:] != grp[:-1]) | (salt[1:] != salt[:-1]), True])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for i in range(a, b, most):
                    part = batch.slice(i, min(most, b - i))
                    ids = part.column("vec_id").to_numpy().astype("<i8").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([grp[a]], pa.int32()), pa.array([salt[a]], pa.int32()), pa.array([ids], pa.binary()), pa.array([_integers(part.column("vector")).astype("<i8").tobytes()], pa.binary())], ["grp", "salt", f"{label}_ids", f"{label}_vectors"])

    return run


def _sent(pivots: np.ndarray, radius: np.ndarray, size: np.ndarray, salts: np.ndarray, probes: np.ndarray, probe_ids: np.ndarray, k: int, first: bool):
    """Each query with every (group, salt) that its bounds leave, or first with those of one group alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, ids = _matrix(batch.column("vector")), batch.column("vec_id").to_numpy()
            length = np.sqrt((q**2).sum(1))
            middle, reach = q @ pivots.T, length[:, None] * radius
            slack = 1e-3 + 1e-10 * length * (np.sqrt((pivots**2).sum(1)).max() + radius.max())
            middle[:, size == 0] = -np.inf
            own = middle.argmax(axis=1)
            # floors of what the k-th best can be: from real vectors, and from the groups' own lower bounds
            got = np.where(probe_ids == ids[:, None], -np.inf, q @ probes.T)
            floor = np.partition(got, -k, axis=1)[:, -k] if got.shape[1] >= k else np.full(len(q), -np.inf)
            if not first:
                floor = np.fmax(floor, batch.column("floor").to_numpy(zero_copy_only=False))
            low = middle - reach
            order = np.argsort(-low, axis=1)
            enough = (np.cumsum(size[order], axis=1) > k).argmax(1)  # one more, as a query is not its own answer
            if size.sum() > k:
                floor = np.maximum(floor, np.take_along_axis(low, order, 1)[np.arange(len(q)), enough])
            who, grp = (np.arange(len(q)), own) if first else np.nonzero((middle + reach >= (floor - slack)[:, None]) & (size > 0) & (np.arange(len(size)) != own[:, None]))
            many = salts[grp]
            who, grp, salt = np.repeat(who, many), np.repeat(grp, many), np.concatenate([np.arange(m) for m in many]) if len(many) else np.zeros(0)
            for i in range(0, len(who), 8192):
                w = pa.array(who[i : i + 8192])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(w), batch.column("vector").take(w), pa.array(grp[i : i + 8192], pa.int32()), pa.array(salt[i : i + 8192], pa.int32())], ["vec_id", "vector", "grp", "salt"])

    return run


def _solved(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                xi, qi = np.frombuffer(row["x_ids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
                x, q = np.frombuffer(row["x_vectors"], "<i8").reshape(len(xi), -1), np.frombuffer(row["q_vectors"], "<i8").reshape(len(qi), -1)
                order = np.argsort(xi, kind="stable")
                xi, x = xi[order], x[order]
                out = []
                for i in range(0, len(qi), 128):
                    score = products(q[i : i + 128], x)
                    # one more than k, as the query may be among them; ties: smaller id first
                    best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                    other = xi[best] != qi[i : i + 128, None]
                    other &= np.cumsum(other, axis=1) <= k
                    some, rank = np.nonzero(other)
                    top = np.take_along_axis(score, best, 1)[some, rank]
                    wide = ["" if LEAST <= v <= MOST else str(v) for v in top.tolist()] if top.dtype == object else [""] * len(top)
                    top = np.array([min(max(v, LEAST), MOST) for v in top.tolist()], np.int64)
                    out.append((qi[i : i + 128][some], xi[best[some, rank]], top, np.array(wide, object)))
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                wide = pa.array([v or None for v in cols[3]], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], pa.int64()), wide], ["query_id", "vec_id", "score", "wide"])

    return run


def knn_join(table: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k best rows of table (vec_id, embedding) for each query, a row whose vec_id is divisible by `every`.

    Components x become floor(256 x), taken to the nearest 64-bit integer; the score is the exact integer inner product, ties go to
    the smaller vec_id, and a query is not its own answer. Scores beyond 64 bits are ranked exactly up to 38 digits and returned as the nearest 64-bit
    integer. Returns query_id, rank, vec_id, score. Vectors that are null or empty, or hold null
    or non-finite components, and rows with a null id take part on neither side. Vectors of different lengths have no inner
    product: each length is a join of its own. Of rows that repeat a vec_id, the one that sorts first by its vector counts.
    An empty table gives an empty result. Other columns are ignored.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "knn")
    rows = _clean(table).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = scratch.write(rows, "rows")
    sizes = [(r["d"], r["count"]) for r in rows.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect()]  # a row per length
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for d, n in sizes:
        one = _joined(rows.where(F.size("vector") == d), n, every, k, scratch, str(d))
        out = one if len(sizes) == 1 else out.unionByName(one)
    return out


def _joined(rows: DataFrame, n: int, every: int, k: int, scratch: Scratch, tag: str) -> DataFrame:
    """The join of n vectors of one length."""
    probe = rows.orderBy(F.xxhash64("vec_id")).limit(PROBES + PIVOTS[1]).toArrow() if n > PROBES else rows.orderBy(F.xxhash64("vec_id")).toArrow()
    held, held_ids = _matrix(probe.column("vector").combine_chunks()), probe.column("vec_id").to_numpy()
    probes, probe_ids = held[:PROBES], held_ids[:PROBES]
    pivots = np.unique(held, axis=0)
    pivots = pivots[np.random.default_rng(0).permutation(len(pivots))[: int(np.clip(np.sqrt(n), *PIVOTS))]]
    near = scratch.write(rows.mapInArrow(_grouped(pivots), "vec_id long, vector array<long>, grp int, d2 double"), f"near-{tag}")
    radius, size = np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in near.groupBy("grp").agg(F.max("d2").alias("d2"), F.count("*").alias("n")).collect():  # a row per pivot
        radius[r["grp"]], size[r["grp"]] = np.sqrt(r["d2"]) * (1 + 1e-9) + 1e-6, r["n"]
    salts = np.maximum(1, np.ceil(size / BLOCK)).astype(np.int64)
    many = F.element_at(F.expr(f"cast(split('{','.join(map(str, salts.tolist()))}', ',') as array<int>)"), F.col("grp") + 1)
    data = near.withColumn("salt", F.pmod(F.xxhash64("vec_id"), many).cast("int")).drop("d2")
    kind = "grp int, salt int, {0}_ids binary, {0}_vectors binary"
    data = data.repartition("grp", "salt").sortWithinPartitions("grp", "salt").mapInArrow(_packed("x", BLOCK), kind.format("x"))
    asked = near.where(F.col("vec_id") % every == 0).select("vec_id", "vector").repartition(F.xxhash64("vec_id"))
    over = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("wide").try_cast("decimal(38,0)").desc(), "vec_id")

    def answers(queries: DataFrame, first: bool) -> DataFrame:
        sent = queries.mapInArrow(_sent(pivots, radius, size, salts, probes, probe_ids, k, first), "vec_id long, vector array<long>, grp int, salt int")
        sent = sent.repartition("grp", "salt").sortWithinPartitions("grp", "salt").mapInArrow(_packed("q", QUERY_BLOCK), kind.format("q"))
        return data.join(sent, ["grp", "salt"]).select("x_ids", "x_vectors", "q_ids", "q_vectors").mapInArrow(_solved(k), "query_id long, vec_id long, score long, wide string")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= k)

    found = scratch.write(best(answers(asked, True)), f"first-{tag}")
    # a score at the lower end of 64 bits may be less than that
    floors = found.where((F.col("rank") == k) & (F.col("score") > LEAST)).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    rest = answers(asked.join(floors, "vec_id", "left"), False)
    return best(found.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")
