"""The trained matcher: split by entity, boosted trees, scores, importances, saving."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.pairs import FEATURES

BANNED = ("entity_id", "source1", "candidate")


def feature_columns(columns: list[str]) -> list[str]:
    """Those of the canonical features that are there, in canonical order."""
    return [c for c in FEATURES if c in columns]


def assert_no_ids(columns: list[str]) -> None:
    bad = [c for c in columns if any(b in c for b in BANNED)]
    if bad:
        raise ValueError(f"ids among the features: {bad}")


def numeric(df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Every feature as a number: 0 where it is absent, null or no number."""
    return df.select(*[c for c in df.columns if c not in columns], *[(F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(c) for c in columns])


def split_entities(matrix: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """`validation`: whether a row's first-source entity is held out, by a hash of it.

    All rows of an entity are on one side, whatever the order of rows. The hash is the first 32
    bits of an MD5, which any engine has.
    """
    h = F.conv(F.left(entity_hash(seed), F.lit(8)), 16, 10).cast("long")
    return matrix.withColumn("validation", h % 10_000 < int(share * 10_000))


def entity_hash(seed: int):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), "s1_id").cast("binary"))


def split_exact(matrix: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """As split_entities, with exactly max(1, int(n * share)) entities held out: those of least
    hash. The cutoff comes from a sorted list of one number an entity, never from the driver."""
    ids = matrix.select("s1_id").distinct().withColumn("h", entity_hash(seed))
    n = ids.count()
    cut = ids.orderBy("h", "s1_id").limit(max(1, int(n * share))).agg(F.max(F.struct("h", "s1_id")).alias("c")).first()["c"]
    h = entity_hash(seed)
    return matrix.withColumn("validation", (h < cut["h"]) | ((h == cut["h"]) & (F.col("s1_id") <= cut["s1_id"]))) if cut else matrix.withColumn("validation", F.lit(False))


def train(matrix: DataFrame, iterations: int = 500, depth: int = 6, rate: float = 0.05, seed: int = 42) -> PipelineModel:
    """Boosted trees on labelled rows with `validation`; positives weigh as much as negatives.

    Trees are grown until the held-out rows gain no more.
    """
    columns = feature_columns(matrix.columns)
    assert_no_ids(columns)
    counts = matrix.where(~F.col("validation")).agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).first()
    weight = F.when(F.col("label") == 1, counts["n"] / max(counts["p"], 1)).otherwise(1.0)
    df = matrix.withColumn("weight", weight.cast("double")).withColumn("label", F.col("label").cast("double"))
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    trees = GBTClassifier(maxIter=iterations, maxDepth=depth, stepSize=rate, subsamplingRate=0.8, featureSubsetStrategy="0.8", weightCol="weight", validationIndicatorCol="validation", seed=seed)
    data = assembler.transform(df)
    return PipelineModel([assembler, trees.fit(data)])


def score(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """prediction_probability and prediction_at_0_5 beside the ids and label."""
    out = model.transform(matrix.withColumn("label", F.col("label").cast("double")) if "label" in matrix.columns else matrix)
    p = vector_to_array("probability")[1]
    keep = [c for c in ("s1_id", "cand_id", "label", "validation") if c in matrix.columns]
    return out.select(*keep, p.alias("prediction_probability"), (p >= 0.5).cast("int").alias("prediction_at_0_5"))


def importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """feature, importance; the greatest first."""
    names, values = model.stages[0].getInputCols(), model.stages[1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, values, strict=True)), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save(model: PipelineModel, path: str, seed: int = 42, share: float = 0.2, threshold: float | None = None) -> None:
    """The model, and beside it a one-row JSON table of what it was made with."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    about = {"feature_cols": model.stages[0].getInputCols(), "random_seed": seed, "val_fraction": share, "threshold": threshold}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(path: str) -> tuple[PipelineModel, dict]:
    spark = SparkSession.getActiveSession()
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/about").first()["value"])
