"""Pairs of two tracks: union with provenance, features, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import fixed
from kinfold.functions.similarity import address_features, name_features
from kinfold.operators import blocking
from kinfold.sources.tsv import require_columns

PAIR = ["s1_id", "cand_id"]
ADDRESS_COLUMNS = [f"addr_{n}" for n in fixed.ADDRESS_FEATURES]
FEATURES = [*fixed.NAME_FEATURES, *ADDRESS_COLUMNS]


def union_tracks(names: DataFrame, addresses: DataFrame) -> DataFrame:
    """Distinct pairs of both tracks with from_name and from_address (1 or 0)."""
    flag = lambda df, n: df.select(*PAIR).distinct().withColumn(n, F.lit(1))
    return flag(names, "from_name").join(flag(addresses, "from_address"), PAIR, "outer").na.fill(0, ["from_name", "from_address"])


def tracks_of_lists(names: DataFrame, addresses: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """union_tracks, and `label` if there is truth, of tracks with a row for each entity (s1_id,
    ids): lists meet by entity, and pairs are not dealt again."""
    df = names.withColumnRenamed("ids", "n").join(addresses.withColumnRenamed("ids", "a"), "s1_id", "outer")
    none = F.array().cast("array<string>")
    n, a = F.coalesce("n", none), F.coalesce("a", none)
    rows = lambda ids, x, y: F.transform(ids, lambda c: F.struct(c.alias("cand_id"), F.lit(x).alias("from_name"), F.lit(y).alias("from_address")))
    label = []
    if truth is not None:
        df = df.join(blocking.listed(truth).withColumnRenamed("ids", "t"), "s1_id", "left")
        label = [F.coalesce(F.array_contains("t", F.col("cand_id")), F.lit(False)).cast("int").alias("label")]
    parts = F.concat(rows(F.array_except(n, a), 1, 0), rows(F.array_intersect(n, a), 1, 1), rows(F.array_except(a, n), 0, 1))
    kept = ["s1_id", *(["t"] if label else [])]
    return df.select(*kept, F.inline(parts)).select(*PAIR, "from_name", "from_address", *label)


def both_records(pairs: DataFrame, records: DataFrame, columns: list[str]) -> DataFrame:
    """pairs with the named columns of either record, prefixed a_ and b_ (empty if unknown)."""
    one = last_of_each(records, columns)
    side = lambda key, p: one.select(F.col("entity_id").alias(key), *[F.col(c).alias(p + c) for c in columns])
    out = pairs.join(side("s1_id", "a_"), "s1_id", "left").join(side("cand_id", "b_"), "cand_id", "left")
    return out.na.fill("", [p + c for p in ("a_", "b_") for c in columns])


def last_of_each(records: DataFrame, columns: list[str]) -> DataFrame:
    """One record for each id: of those that repeat it, the last in input order."""
    if "pos" not in records.columns:
        return records.dropDuplicates(["entity_id"])
    return records.groupBy("entity_id").agg(F.max_by(F.struct(*columns), "pos").alias("r")).select("entity_id", "r.*")


def with_name_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    # only texts go through the joins: grams would be many times as long
    df = both_records(pairs, records, ["name_norm"])
    return df.select(*pairs.columns, *name_features(F.col("a_name_norm"), F.col("b_name_norm")).values())


def name_classes(records: DataFrame, with_sound: bool = True) -> tuple[DataFrame, DataFrame]:
    """(s1_id and class of every entity; class, cand_id and name features): as equal names have
    equal candidates and features, these are found once for each class."""
    members, best = blocking.name_track(records, with_sound=with_sound, last=last_of_each(records, ["name_norm"]).select("entity_id", "name_norm"))
    # a class goes by the id of one of its entities
    found = with_name_features(best.select(F.col("class").alias("s1_id"), "cand_id"), records)
    return members, found.withColumnRenamed("s1_id", "class")


def of_members(members: DataFrame, found: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """The pairs of all members of the classes in `found`; with `label` if there is truth. True
    pairs are few an entity and come to it as a list, before its pairs are written out."""
    if truth is None:
        return members.join(found, "class").drop("class")
    true = blocking.listed(truth).withColumnRenamed("ids", "t")
    label = F.coalesce(F.array_contains("t", F.col("cand_id")), F.lit(False)).cast("int")
    return members.join(true, "s1_id", "left").join(found, "class").withColumn("label", label).drop("class", "t")


def with_address_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    df = both_records(pairs, records, ["address_norm", "pincode", "city_norm", "country", "landmark"])
    return df.select(*pairs.columns, *address_features("a_", "b_").values())


def merged(names: DataFrame, addresses: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """The matrix: pairs of either track, features of the track that saw them, else zeros.

    names and addresses: pairs with their track's features. truth: true pairs; `label` is 1
    for these.
    """
    require_columns(names, [*PAIR, *fixed.NAME_FEATURES], "name features")
    require_columns(addresses, [*PAIR, *fixed.ADDRESS_FEATURES], "address features")
    a = addresses.select(*PAIR, *[F.col(n).alias(f"addr_{n}") for n in fixed.ADDRESS_FEATURES], F.lit(1).alias("from_address"))
    n = names.select(*PAIR, *fixed.NAME_FEATURES, F.lit(1).alias("from_name"))
    # each track is read once: flags and features come from one join
    out = n.dropDuplicates(PAIR).join(a.dropDuplicates(PAIR), PAIR, "outer").na.fill(0, ["from_name", "from_address"])
    out = out.select(*PAIR, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES], "from_name", "from_address")
    return labelled(out, truth) if truth is not None else out


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """`label` anew, whatever the pairs had."""
    t = truth.select(*PAIR).distinct().withColumn("__true", F.lit(1))
    return pairs.drop("label").join(t, PAIR, "left").withColumn("label", F.coalesce("__true", F.lit(0))).drop("__true")
