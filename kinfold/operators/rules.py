"""The rule matcher: equal addresses with compatible names, then equal names with shared words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import fixed
from kinfold.functions.similarity import ngram_cosine
from kinfold.functions.text import tokens


def content(name: Column) -> Column:
    """Words of three characters or more that aren't stopwords, as a set."""
    return F.array_distinct(F.filter(tokens(name), lambda t: (F.length(t) >= 3) & ~t.isin(fixed.NAME_STOPWORDS)))


def names_compatible(a: Column, b: Column) -> Column:
    """Equal, one within the other, a common content word, four equal characters in front, or
    trigram cosine; never if either is empty. The dear test comes last and is skipped."""
    cheap = (a == b) | F.contains(a, b) | F.contains(b, a) | F.arrays_overlap(content(a), content(b)) | ((F.length(a) >= 4) & (F.length(b) >= 4) & (F.left(a, F.lit(4)) == F.left(b, F.lit(4))))
    return F.when((a == "") | (b == ""), F.lit(False)).when(cheap, F.lit(True)).otherwise(ngram_cosine(a, b) >= fixed.COSINE_LEAST)


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = records.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "country", F.col("name_norm").alias("s1_name"), F.col("address_norm").alias("s1_address"))
    rest = records.where("source <> 'S1'").where(~F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("cand_id"), "source", "pos", "country", F.col("name_norm").alias("c_name"), F.col("address_norm").alias("c_address"))
    return first, rest


def address_hits(first: DataFrame, rest: DataFrame) -> DataFrame:
    """Pairs of equal country and address; `match` where the names agree too."""
    joined = rest.where("c_address <> ''").join(first.where("s1_address <> ''").withColumnRenamed("s1_address", "c_address"), ["country", "c_address"])
    return joined.select("s1_id", "cand_id", "source", "pos", names_compatible(F.col("s1_name"), F.col("c_name")).alias("match"))


def name_hits(first: DataFrame, rest: DataFrame) -> DataFrame:
    """For records whose address no first-source record has: equal country and name, and a
    common word in the addresses; `match` from two common words on."""
    known = first.where("s1_address <> ''").select("country", F.col("s1_address").alias("c_address")).distinct()
    # words are found once for each record, below the join: a name has many pairs
    left = rest.join(known, ["country", "c_address"], "left_anti").where("c_name <> ''").select("cand_id", "source", "pos", "country", "c_name", content(F.col("c_address")).alias("c_words"))
    right = first.where(F.length("s1_name") >= 3).select("s1_id", "country", F.col("s1_name").alias("c_name"), content(F.col("s1_address")).alias("s1_words"))
    common = F.size(F.array_intersect("s1_words", "c_words"))
    # exploded, the number is not made again for the filter
    counted = left.join(right, ["country", "c_name"]).select("s1_id", "cand_id", "source", "pos", F.explode(F.array(common)).alias("common"))
    return counted.where("common > 0").select("s1_id", "cand_id", "source", "pos", (F.col("common") >= 2).alias("match"))


def all_hits(first: DataFrame, rest: DataFrame) -> DataFrame:
    """address_hits and name_hits, with `rest` read once: a record whose address is known is
    looked up by it, any other by its name. For a `rest` that is dear to make, as a stream's."""
    known = first.where("s1_address <> ''").select("country", F.col("s1_address").alias("c_address")).distinct().withColumn("known", F.lit(True))
    by_address = F.col("known").isNotNull()
    one = rest.join(known, ["country", "c_address"], "left").select("cand_id", "source", "pos", "country", "c_name", content(F.col("c_address")).alias("c_words"), F.when(by_address, "address").otherwise("name").alias("kind"), F.when(by_address, F.col("c_address")).otherwise(F.col("c_name")).alias("text")).where("text <> ''")
    side = lambda kind, text: first.select("s1_id", "country", "s1_name", content(F.col("s1_address")).alias("s1_words"), F.lit(kind).alias("kind"), F.col(text).alias("text"))
    two = side("address", "s1_address").where("text <> ''").unionByName(side("name", "s1_name").where(F.length("text") >= 3))
    common = F.when(F.col("kind") == "name", F.size(F.array_intersect("s1_words", "c_words")))
    counted = one.join(two, ["country", "kind", "text"]).select("s1_id", "cand_id", "source", "pos", "kind", "s1_name", "c_name", F.explode(F.array(common)).alias("common"))
    match = F.when(F.col("kind") == "name", F.col("common") >= 2).otherwise(names_compatible(F.col("s1_name"), F.col("c_name")))
    return counted.where("common IS NULL OR common > 0").select("s1_id", "cand_id", "source", "pos", match.alias("match"))


def rule_pairs(records: DataFrame, cap: int = fixed.RULE_CAP) -> DataFrame:
    """s1_id, cand_id, match: candidates in order of arrival up to the cap, and all matches."""
    first, rest = sides(records)
    # dealt by s1_id once: both groupings and the window keep to that
    hits = address_hits(first, rest).unionByName(name_hits(first, rest)).repartition("s1_id").groupBy("s1_id", "cand_id").agg(F.min(F.struct("source", "pos")).alias("at"), F.max("match").alias("match"))
    order = Window.partitionBy("s1_id").orderBy("at", "cand_id")
    return hits.withColumn("place", F.row_number().over(order)).where((F.col("place") <= cap) | F.col("match")).select("s1_id", "cand_id", "match")


def rule_lists(records: DataFrame, cap: int = fixed.RULE_CAP) -> DataFrame:
    """source1_entity_id, matched_entity_ids, candidate_entity_ids for every first-source record."""
    pairs = rule_pairs(records, cap)
    ids = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    lists = pairs.groupBy("s1_id").agg(ids(F.when(F.col("match"), F.col("cand_id"))).alias("matched_entity_ids"), ids("cand_id").alias("candidate_entity_ids"))
    universe = records.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"))
    return universe.join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"), F.coalesce("candidate_entity_ids", F.lit("")).alias("candidate_entity_ids"))
