"""Checks of result lists: one table of violations, rule by rule, and the fifteen-point check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HARD, SOFT = "error", "warning"


def split_ids(c: str, trim: bool = False) -> Column:
    ids = F.split(c, ",")
    ids = F.transform(ids, lambda x: F.trim(x)) if trim else ids
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.filter(ids, lambda x: x != "") if trim else ids)


def header_errors(line: str, expected: list[str]) -> list[str]:
    """Problems of a header line, '' being an empty file."""
    if not line:
        return ["empty file"]
    if "\t" not in line and "," in line:
        return ["comma-separated, not tab-separated"]
    columns = [c.strip().lower() for c in line.rstrip("\n").split("\t")]
    return [] if columns == expected else [f"unexpected header {columns}"]


def malformed_rows(lines: DataFrame) -> DataFrame:
    """Non-blank lines (column `value`) without a tab."""
    return lines.where((F.trim("value") != "") & ~F.contains("value", F.lit("\t"))).select(F.lit("malformed row").alias("rule"), F.col("value").alias("id"), F.lit(HARD).alias("severity"))


def list_violations(lists: DataFrame, column: str, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """rule, id, severity of one file's rows (source1_entity_id and `column`, a comma list).

    required: s1_id that must have a row, and no others may. known: cand_id that exist
    (not checked if None).
    """
    t = lists.select(F.col("source1_entity_id").alias("s1_id"), split_ids(column).alias("ids"))
    joined = by_entity(t, "").join(required.select("s1_id").distinct().withColumn("needed", F.lit(True)), "s1_id", "outer")
    here = F.col("rows").isNotNull()
    rule = lambda ok, name: F.when(ok, F.struct(F.lit(name).alias("rule"), F.col("s1_id").alias("id")))
    broken = F.array(rule(F.col("rows") > 1, "duplicate row"), rule(F.col("repeats") > 0, "repeated id in list"), rule(~here, "missing entity"), rule(here & F.col("needed").isNull(), "extra entity"))
    of_rows = joined.select(F.explode(broken).alias("x")).where("x IS NOT NULL").select("x.rule", "x.id")
    kind = F.when(own_id(F.col("id")), "self match").when(~other_id(F.col("id")), "wrong prefix").otherwise("unknown id")
    of_ids = t.select(F.explode("ids").alias("id")).distinct().select(kind.alias("rule"), "id")
    if known is None:
        of_ids = of_ids.where("rule <> 'unknown id'")
    else:
        there = known.select(F.col("cand_id").alias("id")).distinct().withColumn("there", F.lit(True))
        of_ids = of_ids.join(there, "id", "left").where("rule <> 'unknown id' OR there IS NULL").select("rule", "id")
    return of_rows.union(of_ids).select("rule", "id", F.lit(HARD).alias("severity"))


def own_id(x: Column) -> Column:
    return x.startswith("S1-")


def other_id(x: Column) -> Column:
    return x.startswith("S2-") | x.startswith("S3-")


def by_entity(t: DataFrame, suffix: str) -> DataFrame:
    """s1_id, and of its rows (s1_id, ids): how many, and how many repeat an id."""
    repeats = F.size("ids") != F.size(F.array_distinct("ids"))
    return t.groupBy("s1_id").agg(F.count("*").alias(f"rows{suffix}"), F.count_if(repeats).alias(f"repeats{suffix}"))


def not_subset(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """First-source ids with matches that aren't among their candidates."""
    m = matches.select("source1_entity_id", split_ids("matched_entity_ids").alias("m"))
    c = candidates.select("source1_entity_id", split_ids("candidate_entity_ids").alias("c"))
    rest = F.array_except("m", F.coalesce("c", F.array().cast("array<string>")))
    return m.join(c, "source1_entity_id", "left").where(F.size(rest) > 0).select(F.lit("match is no candidate").alias("rule"), F.col("source1_entity_id").alias("id"), F.lit(SOFT).alias("severity")).distinct()


def validate(matches: DataFrame, candidates: DataFrame | None, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """All violations of both files; that the candidates are absent, or don't hold a match, warns."""
    out = list_violations(matches, "matched_entity_ids", required, known).withColumn("file", F.lit("matches"))
    if candidates is None:
        gone = matches.sparkSession.range(1).select(F.lit("file absent").alias("rule"), F.lit("").alias("id"), F.lit(SOFT).alias("severity"), F.lit("candidates").alias("file"))
        return out.unionByName(gone)
    out = out.unionByName(list_violations(candidates, "candidate_entity_ids", required, known).withColumn("file", F.lit("candidates")))
    return out.unionByName(not_subset(matches, candidates).withColumn("file", F.lit("matches")))


def examples(violations: DataFrame, n: int = 5) -> DataFrame:
    """For each file and rule: how many, and the first n ids."""
    by = ["file", "rule", "severity"]
    first = violations.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("k") <= n)
    return violations.groupBy(*by).agg(F.count("*").alias("n")).join(first.groupBy(*by).agg(F.sort_array(F.collect_list("id")).alias("examples")), by)


def fifteen_points(matches: DataFrame, candidates: DataFrame, required: DataFrame, known: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """rule (1 to 15), what, passed. Ids are trimmed here; that matches are candidates is hard."""
    spark = matches.sparkSession
    frame = lambda df, c: df.select(F.trim("source1_entity_id").alias("s1_id"), split_ids(c, trim=True).alias("ids"))
    need, have = required.select("s1_id").distinct().withColumn("needed", F.lit(True)), known.select(F.col("cand_id").alias("id")).distinct()
    m, c = frame(matches, "matched_entity_ids"), frame(candidates, "candidate_entity_ids")
    joined = by_entity(m, "_m").join(by_entity(c, "_c"), "s1_id", "outer").join(need, "s1_id", "outer")
    some = lambda ok, name: F.count_if(F.coalesce(ok, F.lit(False))).alias(name)
    sides = [x for k in ("m", "c") for x in (
        F.coalesce(F.sum(f"rows_{k}"), F.lit(0)).alias(f"rows_{k}"), some(F.col(f"rows_{k}").isNotNull(), f"entities_{k}"), some(F.col("needed") & F.col(f"rows_{k}").isNull(), f"missing_{k}"),
        some(F.col("needed").isNull() & F.col(f"rows_{k}").isNotNull(), f"extra_{k}"), some(F.col(f"repeats_{k}") > 0, f"repeats_{k}"),
    )]
    x = joined.agg(*sides, some(F.col("needed"), "needed")).first()
    # every pair of either file once, with the files that hold it
    pair = lambda df, k: df.select("s1_id", F.explode("ids").alias("id"), F.lit(k).alias("file"))
    pairs = pair(m, 1).union(pair(c, 2)).groupBy("s1_id", "id").agg(F.bit_or("file").alias("files"))
    ids = pairs.groupBy("id").agg(F.bit_or("files").alias("files"), F.max((F.col("files") == 1).cast("int")).alias("loose")).join(have.withColumn("there", F.lit(True)), "id", "left")
    unknown = other_id(F.col("id")) & F.col("there").isNull()
    y = ids.agg(
        some(own_id(F.col("id")), "own"), some(~own_id(F.col("id")) & ~other_id(F.col("id")), "odd"), some(F.col("loose") == 1, "loose"),
        some(unknown & (F.col("files").bitwiseAND(1) > 0), "unknown_m"), some(unknown & (F.col("files").bitwiseAND(2) > 0), "unknown_c"),
    ).first()
    n = x["needed"]
    h = headers or {"matches": "source1_entity_id\tmatched_entity_ids", "candidates": "source1_entity_id\tcandidate_entity_ids"}
    rules = [
        ("matches have a row for each entity", x["rows_m"] == n), ("matches miss no entity", x["missing_m"] == 0), ("matches have no other entity", x["extra_m"] == 0), ("matches repeat no entity", x["rows_m"] == x["entities_m"]),
        ("candidates have a row for each entity", x["rows_c"] == n), ("candidates miss and add none", x["missing_c"] == 0 and x["extra_c"] == 0), ("candidates repeat no entity", x["rows_c"] == x["entities_c"]),
        ("no list repeats an id", x["repeats_m"] == 0 and x["repeats_c"] == 0), ("no first-source id is in a list", y["own"] == 0), ("all ids have a known prefix", y["odd"] == 0),
        ("matches are candidates", y["loose"] == 0), ("matched ids exist", y["unknown_m"] == 0), ("candidate ids exist", y["unknown_c"] == 0),
        ("tabs part the columns", all("\t" in line for line in h.values())), ("headers are as expected", not header_errors(h["matches"], ["source1_entity_id", "matched_entity_ids"]) and not header_errors(h["candidates"], ["source1_entity_id", "candidate_entity_ids"])),
    ]
    return spark.createDataFrame([(i + 1, what, bool(ok)) for i, (what, ok) in enumerate(rules)], "rule int, what string, passed boolean")


def file_violations(lines: DataFrame, expected: list[str]) -> tuple[DataFrame, bool]:
    """Violations (rule, id, severity) of a file's lines (columns row, value) as such: its header,
    and lines without a tab; and whether the header lets the rest be checked."""
    first = lines.where("row = 0").select("value").first()
    bad = header_errors(first["value"] if first else "", expected)
    spark = lines.sparkSession
    found = spark.createDataFrame([("header", b, HARD) for b in bad], "rule string, id string, severity string")
    return found.unionByName(malformed_rows(lines.where("row > 0"))), not bad


def parsed(lines: DataFrame, column: str) -> DataFrame:
    """source1_entity_id, `column` and row of a file's lines that have a tab, but the header."""
    tab = F.instr("value", "\t")
    return lines.where(tab > 0).where("row > 0").select(F.substring("value", F.lit(1), tab - 1).alias("source1_entity_id"), F.substring("value", tab + 1, F.length("value")).alias(column), "row")


def out_of_order(written: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows (pos, source1_entity_id) that aren't the universe's at the same place."""
    a = written.select("pos", F.col("source1_entity_id").alias("got"))
    b = universe.select("pos", F.col("entity_id").alias("want"))
    return a.join(b, "pos", "outer").where(~F.col("got").eqNullSafe(F.col("want")))
