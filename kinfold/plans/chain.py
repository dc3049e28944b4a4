"""The stages from files to results. Each reads Parquet of the ones before and writes its own."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators import blocking, metrics, model, pairs, records, rules, validate
from kinfold.sources import tsv


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def normalize(spark: SparkSession, sources: dict[str, str], out: str, clause_aware: bool = False) -> DataFrame:
    entities = tsv.read_sources(spark, sources)
    records.assert_unique_ids(entities)
    return stored(records.normalized(entities, clause_aware), f"{out}/records")


def block(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    r = spark.read.parquet(f"{out}/records")
    return stored(blocking.block_names(r), f"{out}/candidates_name"), stored(blocking.block_addresses(r), f"{out}/candidates_address")


def featurize(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    r = spark.read.parquet(f"{out}/records")
    ids = lambda track: spark.read.parquet(f"{out}/candidates_{track}").select("s1_id", "cand_id")
    return stored(pairs.with_name_features(ids("name"), r), f"{out}/features_name"), stored(pairs.with_address_features(ids("address"), r), f"{out}/features_address")


def merge(spark: SparkSession, out: str, truth: str | None = None) -> DataFrame:
    """The matrix, with labels where there is a ground truth. Never taken over from a former run."""
    t = tsv.read_ground_truth(spark, truth)[0] if truth else None
    return stored(pairs.merged(spark.read.parquet(f"{out}/features_name"), spark.read.parquet(f"{out}/features_address"), t), f"{out}/matrix")


def train(spark: SparkSession, out: str, truth: str, iterations: int = 500) -> dict:
    """Fits, scores the held-out entities, stores model, predictions and importances."""
    m = stored(model.split_exact(model.numeric(spark.read.parquet(f"{out}/matrix"))), f"{out}/split")
    fitted = model.train(m, iterations=iterations)
    model.save(fitted, f"{out}/trained")
    held = stored(model.score(fitted, m.where("validation")), f"{out}/validation_predictions")
    stored(model.importances(fitted, spark), f"{out}/importances")
    true, _ = tsv.read_ground_truth(spark, truth)
    return metrics.macro_f05(held.withColumn("probability", F.col("prediction_probability")), true).first().asDict()


def tune(spark: SparkSession, out: str, truth: str) -> float:
    """The sweep over thresholds on the held-out predictions, and the best."""
    held = spark.read.parquet(f"{out}/validation_predictions").withColumn("probability", F.col("prediction_probability"))
    true, _ = tsv.read_ground_truth(spark, truth)
    sweep = stored(metrics.threshold_sweep(held, true), f"{out}/thresholds")
    best = metrics.best_threshold(sweep).first()["threshold"]
    spark.createDataFrame([(json.dumps({"threshold": best}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/best_threshold")
    return best


def report(spark: SparkSession, out: str, truth: str) -> dict[str, dict]:
    """Recall of either track and of both."""
    r, (true, _) = spark.read.parquet(f"{out}/records"), tsv.read_ground_truth(spark, truth)
    n, a = (spark.read.parquet(f"{out}/candidates_{t}") for t in ("name", "address"))
    frames = {"name": metrics.blocking_report(n, true, r, per_all=False), "address": metrics.blocking_report(a, true, r, per_all=True), "combined": metrics.combined_recall(n, a, true)}
    return {k: v.first().asDict() for k, v in frames.items()}


def match(spark: SparkSession, out: str, matches: str, candidates: str, by_model: bool = False, source1: str = "") -> None:
    """Both result files, by the rules, or by the trained model at the tuned threshold."""
    r = spark.read.parquet(f"{out}/records")
    first = r.where("source = 'S1'").select("entity_id", "pos")
    records.assert_scoring_universe(first, source1)
    if by_model:
        fitted, _ = model.load(f"{out}/trained")
        threshold = json.loads(spark.read.text(f"{out}/best_threshold").first()["value"])["threshold"]
        found = stored(model.score(fitted, model.numeric(spark.read.parquet(f"{out}/matrix").drop("label"))).withColumn("match", F.col("prediction_probability") >= threshold), f"{out}/matched")
    else:
        found = stored(rules.rule_pairs(r), f"{out}/matched")
    tsv.write_submission(first, found.where("match"), found, matches, candidates)


def check(spark: SparkSession, matches: str, candidates: str | None, sources: dict[str, str], check_ids: bool = False) -> DataFrame:
    """Violations of the result files, with examples: of the files as such, of their lists, of
    the rows' order, and the fifteen points where both files can be read."""
    universe = tsv.in_file_order(tsv.read_entities(spark, sources["S1"], "S1").select("entity_id"), "pos")
    first = universe.select(F.col("entity_id").alias("s1_id")).distinct()
    known = tsv.read_ids(spark, sources["S2"]).union(tsv.read_ids(spark, sources["S3"])).select(F.col("entity_id").alias("cand_id")) if check_ids or "S2" in sources and "S3" in sources else None
    found, tables = None, {}
    for name, path, column in (("matches", matches, "matched_entity_ids"), ("candidates", candidates, "candidate_entity_ids")):
        if not path:
            continue
        lines = tsv.in_file_order(spark.read.text(path))
        bad, readable = validate.file_violations(lines, ["source1_entity_id", column])
        if readable:
            rows = validate.parsed(lines, column)
            tables[name] = rows
            order = validate.out_of_order(tsv.in_file_order(rows.orderBy("row").select("source1_entity_id"), "pos"), universe)
            bad = bad.unionByName(order.select(F.lit("out of order").alias("rule"), F.coalesce("got", "want").alias("id"), F.lit(validate.HARD).alias("severity")))
        bad = bad.withColumn("file", F.lit(name))
        found = bad if found is None else found.unionByName(bad)
    if "matches" in tables:
        c = tables.get("candidates")
        if c is not None or not candidates:
            found = found.unionByName(validate.validate(tables["matches"], c, first, known if check_ids else None))
        else:
            found = found.unionByName(validate.list_violations(tables["matches"], "matched_entity_ids", first, known if check_ids else None).withColumn("file", F.lit("matches")))
        if c is not None and known is not None:
            points = validate.fifteen_points(tables["matches"], c, first, known).where("NOT passed")
            found = found.unionByName(points.select(F.concat(F.lit("point "), "rule", F.lit(": "), "what").alias("rule"), F.lit("").alias("id"), F.lit(validate.SOFT).alias("severity"), F.lit("both").alias("file")))
    return validate.examples(found)
