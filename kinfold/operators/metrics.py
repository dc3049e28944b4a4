"""Scores and reports, each one row or one row for a threshold, country or column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.sources.tsv import require_columns

BETA2 = 0.25
#: 0.10, 0.11, ... 0.90
THRESHOLDS = [round(0.10 + 0.01 * k, 2) for k in range(81)]


def f_beta(p: Column, r: Column, beta2: float = BETA2) -> Column:
    den = beta2 * p + r
    return F.when(den == 0, F.lit(0.0)).otherwise((1 + beta2) * p * r / den)


def actual_of(truth: DataFrame) -> DataFrame:
    return truth.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count("*").alias("actual"))


def entity_scores(scored: DataFrame, truth: DataFrame, by: list[str], universe: DataFrame | None = None) -> DataFrame:
    """Precision, recall and F of every first-source entity, for each of `by`.

    scored: s1_id, predicted, correct (counts), and actual if it is known. Entities are those of
    `scored`, or all of `universe`.
    """
    actual = actual_of(truth)
    df = scored if "actual" in scored.columns else scored.join(actual, "s1_id", "left").na.fill(0, ["actual"])
    if universe is not None:
        keys = scored.select(*by).distinct() if by else None
        rest = universe.select("s1_id").distinct().join(scored.select("s1_id").distinct(), "s1_id", "left_anti").join(actual, "s1_id", "left").na.fill(0, ["actual"]).withColumn("predicted", F.lit(0)).withColumn("correct", F.lit(0))
        if keys is not None:
            rest = rest.join(F.broadcast(keys), how="cross")  # 81 thresholds at most
        df = df.unionByName(rest.select(*df.columns))
    p = F.when(F.col("predicted") > 0, F.col("correct") / F.col("predicted")).otherwise(F.when(F.col("actual") == 0, 1.0).otherwise(0.0))
    r = F.when(F.col("actual") > 0, F.col("correct") / F.col("actual")).otherwise(1.0)
    f = F.when(F.col("actual") == 0, F.when(F.col("predicted") == 0, 1.0).otherwise(0.0)).otherwise(f_beta(F.col("p"), F.col("r")))
    return df.withColumn("p", p).withColumn("r", r).withColumn("f", f)


def macro(scores: DataFrame, by: list[str]) -> DataFrame:
    total = lambda c, n: F.coalesce(F.sum(c), F.lit(0)).alias(n)
    return scores.groupBy(*by).agg(F.avg("f").alias("f05"), F.avg("p").alias("precision"), F.avg("r").alias("recall"), total("predicted", "n_predicted"), total("actual", "n_actual"), total("correct", "n_correct"))


def macro_f05(pairs: DataFrame, truth: DataFrame, threshold: float = 0.5, universe: DataFrame | None = None) -> DataFrame:
    """One row of macro scores. pairs: s1_id, label, probability."""
    hit = F.col("probability") >= threshold
    scored = pairs.groupBy("s1_id").agg(F.count_if(hit).alias("predicted"), F.count_if(hit & (F.col("label") == 1)).alias("correct"))
    return macro(entity_scores(scored, truth, [], universe), [])


def threshold_sweep(pairs: DataFrame, truth: DataFrame, thresholds: list[float] = THRESHOLDS, universe: DataFrame | None = None) -> DataFrame:
    """A row for each threshold, all from one grouping of the pairs (s1_id, label, probability).

    A pair counts from the lowest threshold up to its probability, so entities are first
    summed by the highest threshold a pair passes: 81 numbers an entity, no pair repeated.
    """
    require_columns(pairs, ["s1_id", "label", "probability"], "predictions")
    ts = F.array(*map(F.lit, thresholds))
    passed = F.size(F.filter(ts, lambda t: F.col("probability") >= t))
    steps = pairs.groupBy("s1_id", passed.alias("passed")).agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("c"))
    lists = steps.groupBy("s1_id").agg(F.collect_list(F.struct("passed", "n", "c")).alias("x"))
    at = F.transform(
        F.sequence(F.lit(1), F.lit(len(thresholds))),
        lambda k: F.struct(
            F.element_at(ts, k).alias("threshold"),
            F.aggregate("x", F.lit(0).cast("long"), lambda acc, s: acc + F.when(s["passed"] >= k, s["n"]).otherwise(0)).alias("predicted"),
            F.aggregate("x", F.lit(0).cast("long"), lambda acc, s: acc + F.when(s["passed"] >= k, s["c"]).otherwise(0)).alias("correct"),
        ),
    )
    # true pairs are counted in before there are 81 rows of an entity, which a join would sort
    lists = lists.join(actual_of(truth), "s1_id", "left").na.fill(0, ["actual"])
    scored = lists.select("s1_id", "actual", F.explode(at).alias("t")).select("s1_id", "t.threshold", "t.predicted", "t.correct", "actual")
    return macro(entity_scores(scored, truth, ["threshold"], universe), ["threshold"])


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold of highest F, the lowest on ties."""
    return sweep.orderBy(F.desc("f05"), "threshold").limit(1)


def blocking_report(pairs: DataFrame, truth: DataFrame, records: DataFrame, per_all: bool, by_country: bool = False) -> DataFrame:
    """Recall ceiling, reduction and entity-level recall of candidate pairs.

    avg_candidates divides by all first-source entities (per_all) or by those with candidates.
    """
    p = pairs.select("s1_id", "cand_id").distinct()
    t = truth.select("s1_id", "cand_id").distinct()
    found = t.join(p.withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count("*").alias("true"), F.count("hit").alias("captured"))
    first = records.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "country")
    n_rest = records.where("source <> 'S1'").select(F.count("*").alias("n_rest"))
    each = first.join(p.groupBy("s1_id").agg(F.count("*").alias("cands")), "s1_id", "left").join(found, "s1_id", "left").na.fill(0, ["cands", "true", "captured"])
    has = F.col("true") > 0
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    entities = F.count("*") if per_all else F.count_if(F.col("cands") > 0)
    out = each.groupBy(*(["country"] if by_country else [])).agg(
        F.count("*").alias("total_s1"), F.sum("cands").alias("candidate_pairs"), F.sum("true").alias("true_pairs"), F.sum("captured").alias("captured_pairs"), share(F.sum("captured"), F.sum("true")).alias("recall_ceiling"),
        share(F.sum("cands"), entities).alias("avg_candidates"), F.count_if(has).alias("entities_with_truth"), F.count_if(has & (F.col("captured") == F.col("true"))).alias("full_recall"), F.count_if(has & (F.col("captured") > 0) & (F.col("captured") < F.col("true"))).alias("partial_recall"), F.count_if(has & (F.col("captured") == 0)).alias("zero_recall"),
    )
    return out.join(F.broadcast(n_rest), how="cross").withColumn("reduction_ratio", 1 - share(F.col("candidate_pairs"), F.col("total_s1") * F.col("n_rest"))).drop("n_rest")  # a one-row side


def runner_ratios(names: DataFrame, addresses: DataFrame, records: DataFrame) -> DataFrame:
    """track, total_s1, total_cands, total_pairs, avg_candidates, reduction_ratio as each track
    counts them itself: names only over records with a country, addresses over all first-source
    records, and over candidates with a country."""
    own, country = F.col("source") == "S1", F.trim("country") != ""
    sides = records.agg(F.count_if(own & country).alias("n1"), F.count_if(own).alias("a1"), F.count_if(~own & country).alias("cands"))
    count = lambda df, n: df.agg(F.count("*").alias(n))
    one = sides.join(count(names, "np"), how="cross").join(count(addresses, "ap"), how="cross")  # one row each
    rows = one.select("cands", F.explode(F.array(F.struct(F.lit("name").alias("track"), F.col("n1").alias("s1"), F.col("np").alias("p")), F.struct(F.lit("address").alias("track"), F.col("a1").alias("s1"), F.col("ap").alias("p")))).alias("x"))
    s1, p = F.col("x.s1"), F.col("x.p")
    return rows.select(
        "x.track", s1.alias("total_s1"), F.col("cands").alias("total_cands"), p.alias("total_pairs"),
        (p / F.greatest(s1, F.lit(1))).alias("avg_candidates"), (1 - p / F.greatest(s1 * F.col("cands"), F.lit(1))).alias("reduction_ratio"),
    )


def side_by_side(truth: DataFrame, entities: DataFrame, n: int = 25) -> DataFrame:
    """The first n true pairs in input order, with both names cut for display."""
    shown = lambda c, longest, cut: F.when(F.length(c) > longest, F.concat(F.left(c, F.lit(cut)), F.lit("..."))).otherwise(c)
    a = entities.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "pos", "country", F.col("business_name").alias("a"))
    b = entities.where("source <> 'S1'").select(F.col("entity_id").alias("cand_id"), F.col("business_name").alias("b"))
    both = truth.select("s1_id", "cand_id").distinct().join(a, "s1_id").join(b, "cand_id", "left").orderBy("pos", "cand_id").limit(n)
    b_name = F.coalesce(F.col("b"), F.lit("UNKNOWN"))
    return both.select("s1_id", "country", shown(F.col("a"), 35, 32).alias("s1_name"), "cand_id", F.when(F.col("cand_id").startswith("S2-"), "S2").otherwise("S3").alias("source"), shown(b_name, 40, 40).alias("cand_name"))


def combined_recall(names: DataFrame, addresses: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs captured by either track, by both, by one only, by none."""
    flag = lambda df, c: df.select("s1_id", "cand_id").distinct().withColumn(c, F.lit(1))
    t = truth.select("s1_id", "cand_id").distinct().join(flag(names, "n"), ["s1_id", "cand_id"], "left").join(flag(addresses, "a"), ["s1_id", "cand_id"], "left")
    return captured(t.select(F.col("n").isNotNull().alias("n"), F.col("a").isNotNull().alias("a")))


def missed_pairs(names: DataFrame, addresses: DataFrame, truth: DataFrame) -> DataFrame:
    seen = names.select("s1_id", "cand_id").union(addresses.select("s1_id", "cand_id"))
    return truth.select("s1_id", "cand_id").distinct().join(seen, ["s1_id", "cand_id"], "left_anti")


def true_in_lists(names: DataFrame, addresses: DataFrame, truth: DataFrame) -> DataFrame:
    """s1_id, cand_id of each true pair, and whether either track (s1_id, ids) has it (n, a)."""
    t = truth.groupBy("s1_id").agg(F.collect_set("cand_id").alias("t"))
    df = t.join(names.withColumnRenamed("ids", "ns"), "s1_id", "left").join(addresses.withColumnRenamed("ids", "as_"), "s1_id", "left")
    has = lambda ids, x: F.coalesce(F.array_contains(ids, x), F.lit(False))
    found = F.transform("t", lambda x: F.struct(x.alias("cand_id"), has("ns", x).alias("n"), has("as_", x).alias("a")))
    return df.select("s1_id", F.inline(found))


def captured(found: DataFrame) -> DataFrame:
    n, a = F.col("n"), F.col("a")
    return found.agg(F.count("*").alias("total"), F.count_if(n).alias("by_name"), F.count_if(a).alias("by_address"), F.count_if(n & a).alias("by_both"), F.count_if(n & ~a).alias("name_only"), F.count_if(~n & a).alias("address_only"), F.count_if(~n & ~a).alias("missed"))


def provenance_counts(matrix: DataFrame) -> DataFrame:
    """Pairs by track, positives, negatives and their ratio."""
    n, a, y = F.col("from_name") == 1, F.col("from_address") == 1, F.col("label") == 1
    return matrix.agg(F.count("*").alias("pairs"), F.count_if(n & ~a).alias("name_only"), F.count_if(~n & a).alias("address_only"), F.count_if(n & a).alias("both"), F.count_if(y).alias("positives"), F.count_if(~y).alias("negatives"), (F.count_if(~y) / F.greatest(F.count_if(y), F.lit(1))).alias("ratio"))


def length_stats(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Count, and mean, least, median (exact) and greatest of lengths and word counts."""
    c = F.coalesce(column, F.lit(""))
    words = F.size(F.filter(F.split(c, r"\s+"), lambda t: t != ""))
    x = df.withColumn("chars", F.length(c)).withColumn("words", words)
    return x.groupBy(*by).agg(F.count("*").alias("n"), *[f(v).cast("double").alias(f"{n}_{v}") for v in ("chars", "words") for n, f in (("mean", F.avg), ("min", F.min), ("median", F.median), ("max", F.max))])


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null or blank values of each column, each counted once."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull() | (F.trim(F.col(c)) == "")).alias(f"missing_{c}") for c in columns])


def pattern_counts(df: DataFrame, column: str, patterns: dict[str, str], by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(F.col(column).rlike(p), F.lit(False))).alias(n) for n, p in patterns.items()])


def common_words(df: DataFrame, column: str, n: int = 40) -> DataFrame:
    """The n commonest words of a column, ties by word."""
    words = df.select(F.explode(F.filter(F.split(F.lower(F.coalesce(column, F.lit(""))), r"\s+"), lambda t: t != "")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(n)
