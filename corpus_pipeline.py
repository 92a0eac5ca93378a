"""Corpus cleaning in five stages: quality, near-duplicates, repeated passages, benchmark overlap, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its result is written as Parquet and
read again for the next one. All but the last return the columns of ``documents``. Null texts are empty texts: they are
scored like others, link with nothing, repeat nothing and have no tokens. A stage first drops what earlier jobs left on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwell.llm import bpe, decontaminate, near_dup, quality, repeats
from offerwell.llm.queries import table, vocabulary
from offerwell.session import cut_lineage, release


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    release(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))  # scored from the texts: they are not written once more beside the features
    return quality.score(docs, model).where("NOT rejected").select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    release(spark)
    gone = near_dup.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    release(spark)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages of 50 words and more that an earlier document has; others stay as they are."""
    release(spark)
    found = repeats.remove_repeats(docs).withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with the benchmark."""
    release(spark)
    return decontaminate.match_items(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts, with the check that they decode to the text."""
    release(spark)
    rows = bpe.encode_decode(docs, vocabulary("byte_bpe_50k.json"))
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_group),
    ("repeats", cut_repeats),
    ("decontamination", keep_unseen),
    ("tokens", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


ORACLE_SQL = None  # the classifier and the signatures have no SQL form; the stages are tested against brute force

QUERIES = {"pipeline": run}
CHECKS: dict[str, str] = {}
