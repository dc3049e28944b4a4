"""A corpus pipeline of five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm import mixing, near_dedup, pieces, pii, quality_classifier
from kinfold.llm.common import small, steps, table, written

#: Words of a shingle in the near-duplicate stage.
SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. Trusted positives: all good labels."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    scored = quality_classifier.scored(docs, quality_classifier.trained(docs, good))
    return scored.where("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; where rows repeat its doc_id, one row."""
    verdicts = written(near_dedup.deduplicated(docs, SHINGLE_WORDS), "pipeline-verdicts")
    stay = small(verdicts.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct())
    repeated = small(verdicts.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    kept = docs.join(stay, "doc_id", "left_semi")
    once = kept.join(repeated, "doc_id", "left_anti")
    order = Window.partitionBy("doc_id").orderBy(F.length("text").desc(), F.xxhash64("text"), F.xxhash64(*[c for c in docs.columns if c != "text"]))
    first = kept.join(repeated, "doc_id", "left_semi").withColumn("__row", F.row_number().over(order)).where("__row = 1")
    return once.select(*docs.columns).union(first.select(*docs.columns)).union(docs.where("doc_id IS NULL").select(*docs.columns))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and disclosing terms generalised."""
    return pii.sanitize(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more: small sources are repeated, up to half as often again."""
    return mixing.mix(docs, max_epochs=1.5)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, token_ids."""
    return pieces.encoded(docs).select("doc_id", "source", "n_tokens", "token_ids")


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("pii", private),
    ("mixing sources", mixed),
    ("sentencepiece encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        place = "pipeline-" + name.replace(" ", "-")
        with steps(spark, place):
            docs = written(stage(spark, docs, sf_dir), place)
    return docs


#: The classifier's fit and the encoding have no SQL.
ORACLE_SQL = None
