"""Mixing sources to target weights by temperature.

A source's weight is proportional to its token share to the power alpha. Bisection finds the
alpha that meets a target entropy or a limit on repetition (see `solve`). The weights are then
realised under a token budget as blocks: each block of a source is a permutation of its documents (by a hash of doc_id and block number); whole blocks come first, and the last
one is cut where the budget ends.

Native throughout: sources, and the place where a source's last block is cut, are found with
grouped sums over a fixed fan-out of hash prefixes, so no task ever holds a source.

Defined results: null texts have no tokens; a null source is a source of its own; rows with
the same doc_id share one place in each permutation and are taken or left together; a source
without tokens has weight 0 and no block, so that the query, which fills a budget of tokens,
gives no row for its documents, while `mix`, which keeps every document, gives each once; an
empty table gives no row; other columns of docs are kept by `mix`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.common import small, table, written

#: Bisection steps on the exponent, taken six at a time (64 candidates to a job).
STEPS = 24
#: Hex digits of the permutation key that each level of the cut search looks at.
LEVEL = 2
DEPTH = 3


def n_tokens(text: str = "text") -> Column:
    r"""Words `[^\x20\x09-\x0D]+` of a text."""
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"[\x20\x09-\x0D]+"))).cast("long")


def key(doc_id: Column, block: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), block.cast("string")).cast("binary"))


def criteria(shares: DataFrame, alphas: list[float]) -> dict[float, dict]:
    """For each exponent: entropy, and the epochs of the source seen most often."""
    grid = shares.select("p", F.explode(F.array(*map(F.lit, alphas))).alias("alpha"))
    sums = grid.groupBy("alpha").agg(
        F.sum(F.pow("p", "alpha")).alias("z"), F.sum(F.pow("p", "alpha") * F.ln("p")).alias("a"), F.max(F.pow(F.col("p"), F.col("alpha") - 1)).alias("most"), F.min(F.pow(F.col("p"), F.col("alpha") - 1)).alias("least")
    )
    rows = sums.select("alpha", (F.ln("z") - F.col("alpha") * F.col("a") / F.col("z")).alias("entropy"), (F.col("most") / F.col("z")).alias("epochs"), (F.col("most") / F.col("least")).alias("spread"), (F.col("z") / F.col("least")).alias("cover")).collect()
    return {r["alpha"]: r.asDict() for r in rows}


def solve(shares: DataFrame, entropy_gain: float | None = None, max_epochs: float | None = None, cover: bool = False) -> tuple[float, float]:
    """(alpha, budget as a multiple of all tokens).

    entropy_gain: of the way from the natural entropy to the even one, how much to go; the
    largest alpha that gets there is taken. max_epochs: the least alpha under which no source
    is repeated more often. With `cover` the budget is such that every source has one whole
    block at least; else it is all tokens once.
    """
    ends = criteria(shares, [0.0, 1.0])
    if not ends or not ends[1.0]["entropy"] or ends[0.0]["entropy"] is None:
        return 1.0, 1.0
    target = ends[1.0]["entropy"] + (entropy_gain or 0.0) * (ends[0.0]["entropy"] - ends[1.0]["entropy"])
    what = "spread" if cover else "epochs"

    def flat_enough(c: dict) -> bool:  # holds up to the alpha sought
        return c["entropy"] >= target - 1e-9 if entropy_gain is not None else c[what] > max_epochs * (1 + 1e-9)

    lo, width = 0.0, 1.0
    if not flat_enough(ends[0.0]):
        alpha = 0.0
    else:
        for _ in range(STEPS // 6):
            got = criteria(shares, [lo + width * k / 64 for k in range(65)])
            width /= 64
            lo = max([lo, *(a for a, c in got.items() if flat_enough(c))])
            if lo >= 1.0:
                break
        # the entropy holds at lo; a limit on epochs holds from the next step on
        alpha = min(1.0, lo if entropy_gain is not None else lo + width)
    return alpha, criteria(shares, [alpha])[alpha]["cover"] if cover else 1.0


def plan(counts: DataFrame, entropy_gain: float | None = None, max_epochs: float | None = None, cover: bool = False) -> DataFrame:
    """source, tokens, weight, epochs, whole, cut: what each source contributes.

    counts: doc_id, source, n. `cut` is the greatest key of the last, partial block that is
    taken (null: none).
    """
    totals = written(counts.groupBy("source").agg(F.sum("n").alias("tokens")).where("tokens > 0"), "mix-totals")
    total = totals.agg(F.sum("tokens").alias("t")).first()["t"] or 1
    shares = totals.withColumn("p", F.col("tokens") / F.lit(float(total)))
    alpha, multiple = solve(shares, entropy_gain, max_epochs, cover)
    z = shares.agg(F.sum(F.pow("p", F.lit(alpha))).alias("z")).first()["z"] or 1.0
    budget = float(total) * multiple
    weighed = shares.withColumn("weight", F.pow("p", F.lit(alpha)) / z).withColumn("epochs", F.col("weight") * budget / F.col("tokens"))
    weighed = weighed.withColumn("whole", F.floor(F.col("epochs") + 1e-9)).withColumn("rest", F.floor(F.col("weight") * budget + 1e-6) - F.col("whole") * F.col("tokens"))
    weighed = written(weighed, "mix-plan")
    of = small(weighed.select(F.col("source").alias("s"), "whole", "rest"))
    rows = counts.join(of, counts["source"].eqNullSafe(of["s"])).where("rest > 0").select("source", "rest", "n", key(F.col("doc_id"), F.col("whole")).alias("key"))
    # the cut: level by level, the prefix within which the running sum passes what is left
    left = weighed.where("rest > 0").select(F.col("source").alias("l_source"), F.lit("").alias("l_prefix"), F.col("rest").alias("left"))
    before = None
    for level in range(1, DEPTH + 1):
        left = small(left)
        inside = rows.join(left, rows["source"].eqNullSafe(left["l_source"]) & (F.substring("key", 1, LEVEL * (level - 1)) == left["l_prefix"]))
        by = F.substring("key", 1, LEVEL * level) if level < DEPTH else F.col("key")
        sums = inside.groupBy(F.col("source"), F.col("left"), by.alias("prefix")).agg(F.sum("n").alias("n"))
        running = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("prefix")))
        # what lies wholly within the budget at this level, and the first prefix that doesn't
        fits = running.where("upto <= left").groupBy("source").agg(F.max("prefix").alias("prefix"))
        fits = fits.select("source", "prefix", F.lit(level).alias("level"))
        before = fits if before is None else before.unionByName(fits)
        if level < DEPTH:
            left = written(running.where("upto > left").groupBy("source").agg(F.min_by(F.struct("prefix", (F.col("left") - F.col("upto") + F.col("n")).alias("left")), "prefix").alias("x")).select(F.col("source").alias("l_source"), F.col("x.prefix").alias("l_prefix"), F.col("x.left").alias("left")), "mix-cut")
    # the greatest key taken: a prefix that fits whole takes all keys up to it and 'g...'
    cuts = before.groupBy("source").agg(F.max_by("prefix", "level").alias("prefix")).select(F.col("source").alias("c_source"), F.concat("prefix", F.lit("g")).alias("cut"))
    return written(weighed.join(cuts, weighed["source"].eqNullSafe(cuts["c_source"]), "left").drop("c_source", "p"), "mix-cuts")


def placed(docs: DataFrame, weights: DataFrame, unweighed: int = 0) -> DataFrame:
    """docs once for each block that takes them, with the columns mix_block and mix_key.
    Documents of sources without tokens come `unweighed` times."""
    p = small(weights.select(F.col("source").alias("mix_source"), F.col("whole").alias("mix_whole"), F.col("cut").alias("mix_cut")))
    taken = F.when(key(F.col("doc_id"), F.col("mix_whole")) <= F.col("mix_cut"), 1).otherwise(0)
    copies = F.col("mix_whole") + taken
    df = docs.join(p, docs["source"].eqNullSafe(p["mix_source"]), "left").withColumn("mix_copies", F.coalesce(copies, F.lit(unweighed).cast("long"))).where("mix_copies > 0")
    df = df.withColumn("mix_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_copies") - 1)))
    return df.withColumn("mix_key", key(F.col("doc_id"), F.col("mix_block"))).drop("mix_source", "mix_whole", "mix_cut", "mix_copies")


def counted(docs: DataFrame) -> DataFrame:
    return written(docs.select("doc_id", "source", n_tokens().alias("n")), "mix-counts")


def mix(docs: DataFrame, max_epochs: float = 1.5) -> DataFrame:
    """docs, every one of them at least once, sources flattened until the smallest is seen
    max_epochs times; a row for each block that takes a document. Columns as they are."""
    own = {c: f"__doc_{c}" for c in docs.columns if c.lower().startswith("mix_")}
    renamed = docs.withColumnsRenamed(own)
    out = placed(renamed, plan(counted(docs), max_epochs=max_epochs, cover=True), unweighed=1)
    return out.drop("mix_block", "mix_key").withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = counted(table(spark, sf_dir, "documents"))
    out = placed(counts, plan(counts, entropy_gain=0.5))
    return out.select("doc_id", "source", F.col("n").alias("n_tokens"), F.col("mix_block").alias("block"), F.col("mix_key").alias("perm_key"))


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce("text", ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS n FROM documents),
s AS (SELECT source, sum(n)::BIGINT AS tokens FROM d GROUP BY source HAVING sum(n) > 0),
t AS (SELECT sum(tokens)::DOUBLE AS total FROM s),
l AS (SELECT list(tokens / total) AS p FROM s, t),
e AS (
  SELECT p, -list_sum(list_transform(p, lambda x: x * ln(x))) AS h1, ln(len(p)) AS h0 FROM l),
b AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS width, p, h1 + 0.5 * (h0 - h1) AS target FROM e
  UNION ALL
  SELECT i + 1,
         CASE WHEN ln(list_sum(list_transform(p, lambda x: x ** (lo + width / 2)))) - (lo + width / 2) * list_sum(list_transform(p, lambda x: x ** (lo + width / 2) * ln(x))) / list_sum(list_transform(p, lambda x: x ** (lo + width / 2))) >= target - 1e-9
              THEN lo + width / 2 ELSE lo END,
         width / 2, p, target
  FROM b WHERE i < 24),
a AS (SELECT lo AS alpha, list_sum(list_transform(p, lambda x: x ** lo)) AS z FROM b WHERE i = 24),
w AS (
  SELECT source, tokens, (tokens / total) ** alpha / z * total AS goal, floor((tokens / total) ** alpha / z * total / tokens + 1e-9)::BIGINT AS whole FROM s, t, a),
k AS (
  SELECT d.doc_id, d.source, n, whole, floor(goal + 1e-6)::BIGINT - whole * tokens AS rest, md5(coalesce(doc_id::VARCHAR, '') || ':' || whole::VARCHAR) AS key
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source),
c AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY key) AS upto FROM k),
r AS (SELECT doc_id, source, n, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM c),
x AS (SELECT doc_id, source, n, unnest(range(copies)) AS block FROM r)
SELECT doc_id, source, n AS n_tokens, block::BIGINT AS block, md5(coalesce(doc_id::VARCHAR, '') || ':' || block::VARCHAR) AS perm_key FROM x
"""
