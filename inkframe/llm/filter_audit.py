"""How quality filters of documents overlap, for every order in which they can be applied.

Words are a relation: texts are exploded into words, counted by (document, word), and then by document for totals and distinct words. The other
failures join those rows, each document gets a mask of the filters that it fails, and 32 conditional counts by part
say all there is to know: what a filter removes at a step of an order is the sum of the counts of the masks that hold it and none of the filters
before it. The 120 orders are then read off those counts; documents are not looked at again.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
GAP = r"[\x20\x09-\x0D]+"
#: A word that no text has; each row brings it once.
ROW = " "


def word_totals(docs: DataFrame) -> DataFrame:
    """docs (doc_id, th, text) -> (doc_id, th, n_words, n_distinct). th tells the texts of one doc_id apart; rows equal in both are
    counted once. Texts are dealt out by document before they are exploded: both counts then need no exchange of words, which are more bytes."""
    words = docs.repartition("doc_id", "th").select("doc_id", "th", F.explode(F.concat(F.array(F.lit(ROW)), F.split("text", GAP))).alias("word"))
    counts = words.groupBy("doc_id", "th", "word").agg(F.count("*").alias("n"))
    real = ~F.col("word").isin("", ROW)
    rows = F.sum(F.when(F.col("word") == ROW, F.col("n")))
    total = F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0))
    return counts.groupBy("doc_id", "th").agg((total / rows).cast("long").alias("n_words"), F.count_if(real).alias("n_distinct"))


def failures(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text, source): doc_id, part, fails (bit i: filter i of FILTERS).

    A: under 200 words; B: fewer than half of the words are distinct; C: over 2 % of code points are A-Z; D: a character of #$%&*|; E: a row of
    a smaller doc_id has the same text. Words are runs without white space, whatever their case. Null texts are empty, a null source
    is the part ''. A row with a null doc_id has no smaller one and is smaller than none; rows of one doc_id are judged each by its text.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("th"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))
    flat = scratch.write(rows.select("doc_id", "part", "th", F.md5("text").alias("digest"), (100 * capitals > 2 * F.length("text")).alias("C"), F.col("text").rlike("[#$%&*|]").alias("D")), "flat")
    totals = word_totals(rows.select("doc_id", "th", "text"))
    # a row per text that several rows have: a frequent text is one row here, and many on the side that a join can split
    first = flat.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    told = flat.join(first, "digest", "left").select("doc_id", "part", "th", "C", "D", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"))
    told, totals = told.alias("t"), totals.alias("w")
    both = told.join(totals, F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.th") == F.col("w.th")), "left")
    n, distinct = (F.coalesce(c, F.lit(0)) for c in ("n_words", "n_distinct"))
    fails = [n < 200, 100 * distinct < 50 * n, F.col("C"), F.col("D"), F.col("E")]
    return both.select("t.doc_id", "part", sum(F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)).alias("fails"))


def audit(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """failed (doc_id, part, fails) and labels (doc_id, quality, toxic) -> part, filter_order, step and the counts of documents.

    A row for each part, order of filters and step. Of several labels of a doc_id any counts; rows without a label are neither good nor toxic.
    """
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = failed.join(told, F.col("doc_id") == F.col("l_id"), "left")
    masks = rows.groupBy("part", "fails").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    columns = [F.coalesce(F.sum(F.when(F.col("fails") == m, F.col(c))), F.lit(0)).alias(f"{c}{m}") for m in range(MASKS) for c in ("n", "good", "toxic")]
    wide = masks.groupBy("part").agg(*columns)
    each = F.array(*[F.struct(F.lit(m).alias("mask"), *[F.col(f"{c}{m}").alias(c) for c in ("n", "good", "toxic")]) for m in range(MASKS)])
    counts = wide.select("part", F.explode(each).alias("c")).select("part", "c.*")
    return counts.join(F.broadcast(_steps(failed.sparkSession)), "mask").groupBy("part", "f", "before").agg(
        *[F.sum(F.when(F.col(role), F.col(c)).otherwise(0)).alias(name) for name, role, c in (("kept", "passes", "n"), ("removed", "here", "n"), ("redundant", "earlier", "n"), ("unique_fails", "alone", "n"), ("good_lost", "here", "good"), ("toxic_lost", "here", "toxic"))],
        F.sum(F.col("first_in") * F.col("n")).alias("shapley"),
    ).join(F.broadcast(_orders(failed.sparkSession)), ["f", "before"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _steps(spark) -> DataFrame:
    """A row for each filter (f, as a mask), set of filters before it and mask of failures, with what the step means for documents of the mask."""
    n = len(FILTERS)
    rows = spark.range(n * MASKS * MASKS).selectExpr(f"cast(shiftleft(1, cast(id div {MASKS * MASKS} as int)) as int) f", f"cast(id div {MASKS} % {MASKS} as int) before", f"cast(id % {MASKS} as int) mask").where("before & f = 0")
    # a filter is the first of the k that a mask holds in one of k orders
    return rows.selectExpr("f", "before", "mask", "mask & (f | before) = 0 passes", "mask & f <> 0 and mask & before = 0 here", "mask & f <> 0 and mask & before <> 0 earlier", "mask = f alone", f"case when mask & f <> 0 then {factorial(n)} div bit_count(mask) else 0 end first_in")


def _orders(spark) -> DataFrame:
    rows = [(o, k + 1, 1 << FILTERS.index(o[k]), sum(1 << FILTERS.index(f) for f in o[:k])) for o in map("".join, permutations(FILTERS)) for k in range(len(o))]
    return spark.createDataFrame(rows, "filter_order string, step int, f int, before int")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the filters of failures(). An empty table of documents gives an empty result; other columns are ignored."""
    return audit(failures(docs), labels)
