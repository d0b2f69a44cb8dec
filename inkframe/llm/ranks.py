"""The place of every row in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .scratch import Scratch

_IN_TASK = (1 << 33) - 1


def ranked(rows: DataFrame, order: list[str], scratch: Scratch, table: str, name: str = "rank") -> DataFrame:
    """rows, written once in the order of the columns `order`, with the place of each in that order, from 0.

    Rows are dealt out by ranges of the order and sorted inside them; a row's place is the number of rows in the ranges before, of which there are
    as many as shuffle partitions, and its place in its own. Ties are ordered in any way: a last column that tells rows
    apart also spreads a frequent value over ranges. Everything stays in generated code.
    """
    inner = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = scratch.write(dealt.select("*", F.spark_partition_id().alias("__range"), inner.alias("__row")), table)
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))  # a row for each range
    ahead = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.join(F.broadcast(sizes.select("__range", ahead.alias("__ahead"))), "__range").withColumn(name, F.col("__ahead") + F.col("__row")).drop("__range", "__row", "__ahead")
