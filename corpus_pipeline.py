"""The corpus pipeline: language, near duplicates, benchmark leaks, mixing, token shards.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Stages are written
as Parquet and read again by the next one. Empty tables pass through all stages. A row with a null doc_id is kept or goes with
the others of null doc_id in stages that decide by doc_id; rows that share a doc_id but not a text share its decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from inkframe.llm.decontaminate import contamination
from inkframe.llm.jaccard_join import jaccard_groups
from inkframe.llm.language_id import predict_language, train_language_model
from inkframe.llm.mixing import apply_mix, plan_mix
from inkframe.llm.queries import tokenizer_path
from inkframe.llm.scratch import Scratch
from inkframe.llm.token_store import token_store

#: Texts whose language is less certain than this are rejected, as are those without letters.
LEAST_LANGUAGE_SCORE = 0.3
#: A source is repeated at most so often as the largest one.
MOST_REPEATS = 1.5


def _kept(docs: DataFrame, told: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id told keeps. Both sides are split by doc_id; nothing is collected."""
    ids = told.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["__id"]), "left_semi")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep rows with a recognised language. Training uses the labelled rows of docs itself. Null texts, texts without a letter and, if no
    row has a label, all rows go."""
    model = train_language_model(docs)
    told = predict_language(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return _kept(docs, told)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least doc_id of each group that Jaccard links of five-word shingles at 0.8 connect. Texts without words link to nothing and
    stay; rows with a null doc_id are in no group; of rows equal in doc_id and text one stays."""
    groups = jaccard_groups(docs, words=5, similarity=(80, 100))
    ids = groups.where("component_id = doc_id").select(F.col("doc_id").alias("__id")).distinct()
    # texts are dealt out by doc_id once: what shares doc_id and text is then together; a comparison that takes nulls as equal would deal them out anew
    kept = docs.join(ids.hint("shuffle_hash"), docs["doc_id"] == ids["__id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id is null").dropDuplicates(["doc_id", "text"]))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts with a ten-word window of the benchmark, or a whole shorter item. Null and empty texts stay, as all do with an empty benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _kept(docs, contamination(docs, benchmark, size=10).where("not contaminated"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat small sources towards equal weights, at most MOST_REPEATS times; every row is used at least once. A null source is a source."""
    plan = Scratch(spark, "pipeline-mix").write(plan_mix(docs, entropy=1.0, repeats=MOST_REPEATS, keep_all=True), "plan")
    return apply_mix(docs, plan)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token shards and return their directory, read back from the files. Null texts are the end id alone."""
    return token_store(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("leaks", leaks), ("mixing", mixing), ("tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir).drop("file")
