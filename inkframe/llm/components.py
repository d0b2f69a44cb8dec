"""Connected components of an edge table by alternating star contractions.

Each round is a constant number of aggregations and joins over edges; labels never reach the driver.
A large star hangs the larger neighbours of every node on its smallest one, a small star does so with
the smaller neighbours. Both keep connectivity, and the edges end as one star per component. Up to FEW edges, a size at which
a round costs more than the work in it, one executor's task finds the components by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


#: 16 MB of edges.
FEW = 1 << 20


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All components of the edges of one task: labels fall to the least of neighbours, and of labels' labels."""
    parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    ends = [np.concatenate(c) for c in zip(*parts, strict=True)]
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
    a, b = at[: len(ends[0])], at[len(ends[0]) :]
    label = np.arange(len(nodes))
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    for i in range(0, len(nodes), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + 50_000]), pa.array(nodes[label[i : i + 50_000]])], ["node", "root"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with a > b. One star step; the result is distinct and again has a > b."""
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    told = sides.join(least, "u")
    if large:
        told = told.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        told = told.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return told.where("a > b").distinct()


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """edges (a long, b long), any order, loops and repeats allowed -> (node, root), root the least node.

    Nodes without an edge to another node are not listed. An empty edge table gives an empty result.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, sign, step = scratch.write(now, f"{tag}-0"), None, 0
    if now.count() <= FEW:
        return now.coalesce(1).mapInArrow(_alone, "node long, root long")
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == sign or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        sign, step = seen, step + 1
        now = scratch.write(_star(_star(now, True), False), f"{tag}-{step}")
        scratch.drop(f"{tag}-{step - 1}")
