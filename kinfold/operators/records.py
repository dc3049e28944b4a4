"""Normalized records of all sources, one select over the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions import text


def normalized(entities: DataFrame, clause_aware: bool = False) -> DataFrame:
    """entity_id, source, pos, country, business_name, name_norm, address_norm, city_norm,
    pincode, landmark, address_core, name_tokens, address_tokens.

    Accents go once for each text; all else derives from that in the JVM. With `clause_aware`
    the address core loses only the landmark clauses of the raw text.
    """
    raw = F.coalesce("business_address", F.lit(""))
    df = entities.withColumn("country", F.trim(F.coalesce("country", F.lit("")))).withColumn("plain_address", text.strip_accents(raw)).withColumn("plain_name", text.strip_accents(text.name_core(F.col("business_name"))))
    plain = F.col("plain_address")
    df = df.withColumn("name_norm", text.name_form(F.col("plain_name"))).withColumn("address_norm", text.address_form(text.strip_text(plain))).withColumn("landmark", text.landmark(plain))
    df = df.withColumn("address_core", text.address_core(F.col("address_norm"), F.col("landmark") if clause_aware else None))
    return df.select(
        "entity_id", "source", "pos", "country", "business_name", "name_norm", "address_norm", text.city(plain).alias("city_norm"), text.pincode(text.strip_text(plain), F.col("country")).alias("pincode"), "landmark", "address_core",
        text.tokens(F.col("name_norm")).alias("name_tokens"), text.tokens(F.col("address_norm")).alias("address_tokens"),
    )


def assert_unique_ids(entities: DataFrame) -> None:
    """Raises if a source repeats an id: one aggregate, one row to the driver."""
    row = entities.groupBy("source", "entity_id").count().where("count > 1").limit(1).collect()
    if row:
        raise ValueError(f"source {row[0]['source']} repeats entity_id {row[0]['entity_id']}")


def assert_scoring_universe(first: DataFrame, path: str = "") -> int:
    """Refuses training files, repeated ids, and ids that look like the training set's."""
    if "train" in path.rsplit("/", 1)[-1].lower():
        raise ValueError(f"{path} is a training file")
    r = first.agg(F.count("*").alias("n"), F.count_distinct("entity_id").alias("d"), F.coalesce(F.avg(F.col("entity_id").startswith("S1-TR").cast("int")), F.lit(0.0)).alias("tr")).first()
    if r["n"] != r["d"]:
        raise ValueError(f"entity ids repeat: {r['n']} rows, {r['d']} ids")
    if r["tr"] > 0.5:
        raise ValueError("most ids are those of a training set")
    return r["n"]
