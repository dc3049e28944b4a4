"""Tab-separated sources and sinks at the edges; between stages tables are Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]
NEGATIVES = "index int, s1_id string, cand_id string, label int, provenance string, val_prob double, s1_name string, s1_addr string, cand_name string, cand_addr string, name_feats map<string,double>, addr_feats map<string,double>"


def require_columns(df: DataFrame, columns: list[str], path: str = "table") -> DataFrame:
    """df, or an error that names the columns it lacks: columns are found by name, wherever they stand."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {lacking}; it has {df.columns}")
    return df


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, quoted: bool = False) -> DataFrame:
    """All columns (or those named, which must be there) as text, empty for what is missing.

    Quotes are characters unless `quoted`. Bytes that are no UTF-8 are replaced by U+FFFD.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"' if quoted else "").option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    df = reader.csv(path)
    if columns:
        df = require_columns(df, columns, path).select(*columns)
    return df.na.fill("")


def read_entities(spark: SparkSession, path: str, source: str, quoted: bool = False) -> DataFrame:
    """Records of one source with `source` and `pos`, their place in the file.

    Rows without an id are dropped; ids and countries are stripped, names and addresses not.
    """
    raw = read_tsv(spark, path, ENTITY, quoted).withColumn("pos", F.monotonically_increasing_id())
    out = raw.withColumn("entity_id", F.trim("entity_id")).withColumn("country", F.trim("country"))
    return out.where("entity_id <> ''").withColumn("source", F.lit(source))


def read_sources(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All sources in one table, e.g. {"S1": ..., "S2": ..., "S3": ...}."""
    frames = [read_entities(spark, p, s) for s, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def id_list(c: str):
    """A comma list as an array of trimmed ids."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def ground_truth(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(true pairs, all first-source ids) of a ground-truth table."""
    t = wide.select(F.trim("source1_entity_id").alias("s1_id"), id_list("matched_entity_ids").alias("ids")).where("s1_id <> ''")
    return t.select("s1_id", F.explode("ids").alias("cand_id")).distinct(), t.select("s1_id").distinct()


def read_ground_truth(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return ground_truth(read_tsv(spark, path, TRUTH))


def in_file_order(df: DataFrame, name: str = "row") -> DataFrame:
    """`name`: 0, 1, 2, ... for the rows of a file in its order. Only the partitions' sizes,
    a number each, go through the driver."""
    at = df.withColumn("__at", F.monotonically_increasing_id())
    part, within = F.shiftright("__at", 33).cast("int"), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["p"], r["n"]) for r in at.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    offsets, total = {}, 0
    for p, n in sizes:
        offsets[p], total = total, total + n
    if not offsets:
        return df.withColumn(name, F.lit(0).cast("long"))
    before = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), part)
    return at.withColumn(name, (before + within).cast("long")).drop("__at")


def candidate_pairs(df: DataFrame) -> DataFrame:
    """(s1_id, cand_id) of a candidate table in the long or the wide form."""
    if "candidate_entity_ids" in df.columns:
        return df.select(F.col("source1_entity_id").alias("s1_id"), F.explode(id_list("candidate_entity_ids")).alias("cand_id"))
    return df.select(F.col("source1_entity_id").alias("s1_id"), F.col("candidate_entity_id").alias("cand_id"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path).select(F.trim("entity_id").alias("entity_id")).where("entity_id <> ''").distinct()


def read_negatives(spark: SparkSession, path: str) -> DataFrame:
    """The reviewed pairs of a JSON list."""
    return spark.read.schema(NEGATIVES).option("multiLine", True).json(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """A folder of part files, in as many as the table has partitions."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_single_tsv(df: DataFrame, path: str, order: str) -> None:
    """One file in the given order, put in place by a rename; through Spark's file system."""
    put_in_place(df.sparkSession, [(staged(df, path, order), path)])


def staged(df: DataFrame, path: str, order: str) -> str:
    """The folder beside `path` that holds df as one file, in the given order."""
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    write_tsv(df.orderBy(order).drop(order).coalesce(1), tmp)
    return tmp


def put_in_place(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Renames the one file of each staged folder over its target. Each rename replaces the
    target in one step: at no time is there none, or half of one."""
    fs, hadoop = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    for tmp, path in moves:
        folder = fs.Path(tmp)
        store = folder.getFileSystem(hadoop)
        part = next(s.getPath() for s in store.listStatus(folder) if s.getPath().getName().startswith("part-"))
        target = store.makeQualified(fs.Path(path))
        fs.FileContext.getFileContext(target.toUri(), hadoop).rename(store.makeQualified(part), target, overwrite)
        store.delete(folder, True)


def write_submission(universe: DataFrame, matches: DataFrame, candidates: DataFrame, matches_path: str, candidates_path: str) -> None:
    """Both result files, a row for each first-source id in its input order. Both are whole
    before either is put in place."""
    files = [(matches, "matched_entity_ids", matches_path), (candidates, "candidate_entity_ids", candidates_path)]
    moves = [(staged(wide_lists(universe, pairs, name), path, "pos"), path) for pairs, name, path in files]
    put_in_place(universe.sparkSession, moves)


def wide_lists(universe: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """source1_entity_id, `name` (sorted comma list, maybe empty), pos."""
    lists = pairs.where(F.col("cand_id").startswith("S2-") | F.col("cand_id").startswith("S3-")).groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_set("cand_id")), ",").alias(name))
    return universe.select(F.col("entity_id").alias("s1_id"), "pos").join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(name, F.lit("")).alias(name), "pos")
