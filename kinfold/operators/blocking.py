"""Candidate pairs: equi-joins of derived keys within a country, capped, scored, ranked.

Both sides are exploded into postings (country, pass, key). Caps are applied to postings,
before the join, so that the join's fan-out is bounded; country is part of every key, so no
country is a task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import fixed
from kinfold.functions.metaphone import sounds
from kinfold.functions.text import distinctive, tokens

KEY = ["country", "pass", "key"]
#: All passes in alphabetical order; a pair's set of passes is a number with a bit for each.
PASSES = ["city", "exact", "phonetic", "pincode", "prefix", "token"]
#: The pass of least weight on addresses; its keys come up after all others of a record.
WEAK, WEAK_EVENT = "prefix", 1_000_000


def posted(records: DataFrame, passes: list[tuple[str, Column, int]], more: tuple[str, ...] = ()) -> DataFrame:
    """A row for each key occurrence: id, source, pos, KEY, weight, event, and `more` of the record.

    passes: (name, array of (key, event) structs, weight). `event` is the order in which one
    record's keys come up; it breaks ties of score.
    """
    all_ = F.concat(*[F.transform(keys, _as_row(name, weight)) for name, keys, weight in passes])
    own = ["entity_id", "source", "pos", "country", *more]
    return records.where("country <> ''").select(*own, F.explode(all_).alias("x")).select(*own, "x.pass", "x.key", "x.weight", "x.event")


def _as_row(name: str, weight: int):
    return lambda k: F.struct(F.lit(name).alias("pass"), k["key"].alias("key"), F.lit(weight).alias("weight"), k["event"].alias("event"))


def single(key: Column, ok: Column, event: int) -> Column:
    one = F.array(F.struct(key.alias("key"), F.lit(event).alias("event")))
    return F.when(ok, one).otherwise(F.array().cast("array<struct<key:string,event:int>>"))


def each(words: Column, first: int, step: int) -> Column:
    return F.transform(words, lambda w, i: F.struct(w.alias("key"), (i * step + first).cast("int").alias("event")))


def phonetic(records: DataFrame, words: str = "words") -> DataFrame:
    """`codes`: the sound keys of `words`, in their order."""
    codes = F.split(sounds(F.array_join(words, " ")), " ")
    return records.withColumn("codes", F.when(F.size(words) > 0, codes).otherwise(F.array().cast("array<string>")))


def name_postings(records: DataFrame, first_side: bool, with_sound: bool = True) -> DataFrame:
    name = F.col("name_norm")
    df = records.withColumn("words", distinctive(tokens(name), fixed.NAME_STOPWORDS))
    passes = [("prefix", single(F.substring(name, 1, 5), name != "" if first_side else F.length(name) >= 3, 0), 1), ("token", each(F.col("words"), 1, 2), 1)]
    if with_sound:
        df = phonetic(df)
        passes.append(("phonetic", F.filter(each(F.col("codes"), 2, 2), lambda k: k["key"] != ""), 1))
    return posted(df, passes)


def address_postings(records: DataFrame) -> DataFrame:
    return strong_postings(records).drop("weak").unionByName(weak_postings(records))


def strong_postings(records: DataFrame) -> DataFrame:
    """Of all passes but the weak one; `weak`: the record's key there, null if it has none."""
    a, w = F.col("address_norm"), fixed.ADDRESS_WEIGHTS
    df = records.withColumn("words", distinctive(tokens(F.col("address_core")), fixed.ADDRESS_STOPWORDS)).withColumn("weak", F.when(has_weak(), weak_key()))
    passes = [
        ("exact", single(a, a != "", 0), w["exact"]),
        ("pincode", single(F.col("pincode"), F.col("pincode") != "", 1), w["pincode"]),
        ("city", single(F.col("city_norm"), F.length("city_norm") >= 3, 2), w["city"]),
        ("token", each(F.col("words"), 3, 1), w["token"]),
    ]
    return posted(df, passes, ("weak",))


def weak_postings(records: DataFrame) -> DataFrame:
    return posted(records, [(WEAK, single(weak_key(), has_weak(), WEAK_EVENT), fixed.ADDRESS_WEIGHTS[WEAK])])


def weak_key() -> Column:
    return F.substring("address_norm", 1, 6)


def has_weak() -> Column:
    return F.length("address_norm") >= 6


def in_bucket_order(postings: DataFrame) -> DataFrame:
    """rank: a posting's place in its bucket, by source, position and occurrence."""
    return postings.withColumn("rank", F.row_number().over(Window.partitionBy(*KEY).orderBy("source", "pos", "event")))


def truncated(postings: DataFrame, bucket: int) -> DataFrame:
    """The first `bucket` postings of each bucket; Spark prunes the rest before the shuffle."""
    return in_bucket_order(postings).where(F.col("rank") <= bucket)


def dropped(postings: DataFrame, bucket: int, spared: str = "exact") -> DataFrame:
    """Postings of buckets no larger than `bucket`; the spared pass keeps all.

    A bucket is too large if it has a posting of the next rank; Spark prunes those after it
    before the shuffle.
    """
    ranked = truncated(postings.where(F.col("pass") != spared), bucket + 1)
    small = ranked.withColumn("size", F.max("rank").over(Window.partitionBy(*KEY))).where(F.col("size") <= bucket).drop("size")
    return small.unionByName(in_bucket_order(postings.where(F.col("pass") == spared)))


def hits_of(first: DataFrame, candidates: DataFrame, *more: Column) -> DataFrame:
    """The joined postings (a, b): s1_id, cand_id, source, weight, bit, at, and `more`; dealt by
    s1_id once, for the sums and for the ranking. at: (event, rank) as one number."""
    bit = sum((F.when(F.col("pass") == p, 1 << i).otherwise(0) for i, p in enumerate(PASSES)), F.lit(0))
    gone = ["source", "pos", "entity_id"]
    a = first.withColumns({"s1_id": F.col("entity_id"), "event": F.col("event").cast("long") * (1 << 32), "bit": bit}).drop(*gone)
    b = candidates.withColumn("cand_id", F.col("entity_id")).drop("pos", "entity_id", "weight", "event")
    return a.alias("a").join(b.alias("b"), KEY).select("s1_id", "cand_id", "source", "weight", "bit", (F.col("event") + F.col("rank")).alias("at"), *more).repartition("s1_id")


def summed(hits: DataFrame, *more: Column) -> DataFrame:
    return hits.groupBy("s1_id", "cand_id", "source").agg(F.sum("weight").alias("score"), F.count("*").alias("hits"), F.min("at").alias("first"), F.bit_or("bit").alias("passes"), *more)


def pairs_of(first: DataFrame, candidates: DataFrame) -> DataFrame:
    """s1_id, cand_id, source, score, hits, first, passes of the joined postings.

    first: the least (event, rank); passes: bits. As numbers, sums need no sort.
    """
    return summed(hits_of(first, candidates))


def top_pairs(pairs: DataFrame, cap: int) -> DataFrame:
    """Each first-source entity's `cap` best: by score, ties by first encounter; with the names
    of their passes."""
    order = Window.partitionBy("s1_id").orderBy(F.desc("score"), "first", "cand_id")
    best = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap)
    return best.withColumn("block_reason", reason()).drop("passes")


def reason() -> Column:
    return F.concat_ws("+", *[F.when(F.col("passes").bitwiseAND(1 << i) != 0, p) for i, p in enumerate(PASSES)])


def by_name(first: DataFrame, last: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(a record for each class of entities with equal countries and names, under the least of
    their ids; s1_id and class of every entity). Equal names have equal postings, and so the
    same candidates: a class is looked up once, however many it holds. An entity with several
    records has all their names. last: entity_id and a text that must be equal in a class too."""
    names = first.where("country <> ''").groupBy("entity_id").agg(F.sort_array(F.collect_list(F.struct("country", "name_norm"))).alias("names"))
    same = ["names"]
    if last is not None:
        names, same = names.join(last.toDF("entity_id", "last"), "entity_id"), ["names", "last"]
    classes = names.groupBy(*same).agg(F.min("entity_id").alias("class"))
    members = names.join(classes, same).select(F.col("entity_id").alias("s1_id"), "class")
    return classes.select(F.col("class").alias("entity_id"), F.lit("S1").alias("source"), F.lit(0).cast("long").alias("pos"), F.inline("names")), members


def name_track(records: DataFrame, cap: int = fixed.NAME_CAP, bucket: int = fixed.NAME_BUCKET, with_sound: bool = True, last: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(s1_id and class of every entity; each class's pairs). Joined by class they are the
    track's pairs; what is equal in a class is best done before."""
    classes, members = by_name(records.where("source = 'S1'"), last)
    first = name_postings(classes, True, with_sound)
    rest = name_postings(records.where("source <> 'S1'"), False, with_sound)
    best = top_pairs(pairs_of(first, truncated(rest, bucket)), cap)
    return members, best.withColumnRenamed("s1_id", "class")


def block_names(records: DataFrame, cap: int = fixed.NAME_CAP, bucket: int = fixed.NAME_BUCKET, with_sound: bool = True) -> DataFrame:
    members, best = name_track(records, cap, bucket, with_sound)
    return members.join(best, "class").drop("class")


def name_lists(records: DataFrame, cap: int = fixed.NAME_CAP, bucket: int = fixed.NAME_BUCKET, with_sound: bool = True) -> DataFrame:
    """s1_id and the set of its name candidates (ids): block_names as a row for each entity."""
    members, best = name_track(records, cap, bucket, with_sound)
    return members.join(listed(best, "class"), "class").select("s1_id", "ids")


def listed(pairs: DataFrame, key: str = "s1_id") -> DataFrame:
    """key and its set of candidates (ids)."""
    return pairs.groupBy(key).agg(F.collect_set("cand_id").alias("ids"))


def block_addresses(records: DataFrame, cap: int = fixed.ADDRESS_CAP, bucket: int = fixed.ADDRESS_BUCKET) -> DataFrame:
    first, rest = records.where("source = 'S1'"), records.where("source <> 'S1'")
    if repeats_ids(records):
        return top_pairs(pairs_of(address_postings(first), dropped(address_postings(rest), bucket)), cap)
    rows = best_addresses(first, rest, cap, bucket).select("s1_id", F.posexplode("best").alias("i", "x")).select("s1_id", "x.*", (F.col("i") + 1).alias("place"))
    return rows.withColumn("score", -F.col("below")).withColumn("block_reason", reason()).drop("below", "passes")


def address_lists(records: DataFrame, cap: int = fixed.ADDRESS_CAP, bucket: int = fixed.ADDRESS_BUCKET) -> DataFrame:
    """s1_id and the set of its address candidates (ids): block_addresses as a row for each entity."""
    if repeats_ids(records):
        return listed(block_addresses(records, cap, bucket))
    best = best_addresses(records.where("source = 'S1'"), records.where("source <> 'S1'"), cap, bucket)
    return best.select("s1_id", F.col("best.cand_id").alias("ids"))


def repeats_ids(records: DataFrame) -> bool:
    """Whether an id comes twice among the first-source records, or twice among the others."""
    own = (F.col("source") == "S1").alias("own")
    return bool(records.groupBy(own, "entity_id").count().where("count > 1").limit(1).collect())


def best_addresses(first: DataFrame, rest: DataFrame, cap: int, bucket: int) -> DataFrame:
    """s1_id and `best`, its block_addresses as an array, for records of unique ids.

    A pair that only the weak pass finds scores below all others, and of these an entity takes
    the first of its bucket. As an entity with `cap` other pairs takes none, and one with fewer
    meets these at most among the first `cap` of its bucket, no later ones are looked up. Whether
    a pair of another pass has the weak key in common, both of its postings tell.
    """
    weight, bit = fixed.ADDRESS_WEIGHTS[WEAK], 1 << PASSES.index(WEAK)
    same = F.coalesce(F.col("a.weak") == F.col("b.weak"), F.lit(False)).alias("same")
    pairs = summed(hits_of(strong_postings(first), dropped(strong_postings(rest), bucket), same), F.max("same").alias("same"))
    strong = pairs.groupBy("s1_id").agg(F.collect_list(F.struct("score", "first", "cand_id", "source", "hits", "passes", "same")).alias("s"))
    buckets = dropped(weak_postings(rest), bucket).where(F.col("rank") <= cap).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("rank", F.col("entity_id").alias("cand_id"), "source"))).alias("w"))
    weak = weak_postings(first).join(buckets, KEY).select(F.col("entity_id").alias("s1_id"), "w")
    both = strong.join(weak, "s1_id", "outer")
    # a bucket that was dropped gives no pass to anyone
    of_weak = lambda x, n: F.when(x["same"] & F.col("w").isNotNull(), n).otherwise(0)
    row = lambda below, first, x, hits, passes: F.struct(below.cast("long").alias("below"), first.cast("long").alias("first"), x["cand_id"].alias("cand_id"), x["source"].alias("source"), hits.cast("long").alias("hits"), passes.cast("int").alias("passes"))
    strong = F.transform("s", lambda x: row(-x["score"] - of_weak(x, weight), x["first"], x, x["hits"] + of_weak(x, 1), x["passes"] + of_weak(x, bit)))
    others = F.when(F.col("s").isNull(), F.col("w")).when(F.size("s") < cap, F.filter("w", lambda x: ~F.array_contains(F.col("s.cand_id"), x["cand_id"])))
    weak = F.transform(others, lambda x: row(F.lit(-weight), F.lit(WEAK_EVENT << 32) + x["rank"], x, F.lit(1), F.lit(bit)))
    kind = "array<struct<below:bigint,first:bigint,cand_id:string,source:string,hits:bigint,passes:int>>"
    none = F.array().cast(kind)
    return both.select("s1_id", F.slice(F.sort_array(F.concat(F.coalesce(strong, none), F.coalesce(weak, none))), 1, cap).alias("best"))


def capped_lookups(records: DataFrame, bucket: int = fixed.NAME_BUCKET, with_sound: bool = True) -> DataFrame:
    """One row: how many lookups met a bucket larger than the cap."""
    first = name_postings(records.where("source = 'S1'"), True, with_sound)
    large = name_postings(records.where("source <> 'S1'"), False, with_sound).groupBy(*KEY).agg(F.count("*").alias("size")).where(F.col("size") > bucket)
    return first.join(large, KEY).agg(F.count("*").alias("capped_lookups"))
