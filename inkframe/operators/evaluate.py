"""Retrieval scores: R@k of ranked answers against frame ranges, and their means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import to_unsigned

CUTS = (1, 5, 20, 50, 100)


def hit_kis(video: Column, frame: Column, truth_video: Column, start: Column, end: Column) -> Column:
    return F.when((video == truth_video) & frame.between(start, end), 1.0).otherwise(0.0)


def hit_qa(kis: Column, answer: Column, text_unsigned: Column, entities: Column) -> Column:
    """A frame hit whose text or an entity of which holds the answer's search form; an empty answer is always held. entities: the search forms of
    the values, joined by line breaks, which no search form of an answer spans."""
    found = F.coalesce(text_unsigned.contains(answer), F.lit(False)) | F.coalesce(entities.contains(answer), F.lit(False))
    return F.when((kis == 1.0) & ((answer == "") | found), 1.0).otherwise(0.0)


def entity_forms(entities: Column) -> Column:
    """The search forms of all values of an array of entities, joined by line breaks."""
    return to_unsigned(F.array_join(F.transform(entities, lambda e: e.value), "\n"))


def evaluate(hits: DataFrame, truth: DataFrame) -> DataFrame:
    """hits (qid, rank, video_id, frame_idx[, text_unsigned, entities]), truth (qid, type, video, start, end, answer) -> per
    query R@k for the cuts, final_score (their mean) and best_rank (null: not found). Queries without hits have zeros.

    Questions (type QA) can only be scored if hits have text_unsigned and entities; without, a question that has hits is an error.
    """
    t = truth.select("qid", F.col("type").alias("_type"), F.col("video").alias("_v"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.regexp_replace(to_unsigned(F.col("answer")), r"\s*\n\s*", " ").alias("_a"))
    whole = {"text_unsigned", "entities"} <= set(hits.columns)
    hits = hits.where(F.col("rank") <= max(CUTS))
    rows = t.join(hits.withColumn("_forms", entity_forms(F.col("entities"))) if whole else hits, "qid", "left")
    kis = F.when(F.col("rank").isNull(), 0.0).otherwise(hit_kis(F.col("video_id"), F.col("frame_idx"), F.col("_v"), F.col("_s"), F.col("_e")))
    qa = hit_qa(kis, F.col("_a"), F.col("text_unsigned"), F.col("_forms")) if whole else F.when(F.col("rank").isNull(), 0.0).otherwise(F.raise_error(F.lit("hits of a question need text_unsigned and entities")).cast("double"))
    rows = rows.withColumn("r", F.when(F.col("_type") == "QA", qa).otherwise(kis))
    cuts = [F.coalesce(F.max(F.when(F.col("rank") <= k, F.col("r"))), F.lit(0.0)).alias(f"r_at_{k}") for k in CUTS]
    out = rows.groupBy("qid").agg(*cuts, F.min(F.when(F.col("r") > 0, F.col("rank"))).alias("best_rank"))
    return out.withColumn("final_score", F.round(sum(F.col(f"r_at_{k}") for k in CUTS) / len(CUTS), 4))


def benchmark_means(scores: DataFrame, seconds: float | None = None) -> DataFrame:
    """Means over the queries, zeros if there is none. seconds: what the batch of searches took; latency_ms is a query's share."""
    cols = [f"r_at_{k}" for k in CUTS] + ["final_score"]
    n = F.greatest(F.count("*"), F.lit(1))
    means = [(F.coalesce(F.sum(c), F.lit(0.0)) / n).alias(c) for c in cols]
    latency = [] if seconds is None else [F.round(F.lit(seconds * 1000.0) / n, 3).alias("latency_ms")]
    return scores.agg(F.count("*").alias("n_queries"), *means, *latency)
