"""Exact top-k search by inner product, in three phases under a uniform threshold.

Candidates are dealt into buckets by a hash of their id. Phase one: each bucket gives, for
each query, a short list of its best scores. The k-th best entry of all lists is a cutoff no
true answer can fall below. Phase two: the cutoffs go to all buckets, and each collects what
may still reach them: the score over the first half of the components, plus the
Cauchy-Schwarz bound of the rest. Phase three: those scores are resolved exactly and ranked.
Entries compare by (score, then smaller id), so thousands of equal vectors are cut off too.

Queries come in blocks, each a row of a grid with the buckets; a task holds one bucket and one
block, CELL_BYTES of each at most whatever the table's size and the vectors' length, and scores
TILE queries at a time. Every candidate is sent once for each block of queries, and every query
once for each bucket: larger cells mean less traffic.

Defined results: vectors that are null or hold null or non-finite components take no part;
shorter vectors count as padded with zeros; rows that share the query's vec_id are the query's
own and no candidates for it, and a query id that repeats is answered once, for its row of
greatest vector; an empty table gives no row; other columns pass by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm.common import one_thread, table, written

K = 10
SCALE = 1024
QUERY_STEP = 100
QUERY_BLOCK = 16384
BUCKET_ROWS = (256, 16384)
CELL_BYTES = 32 << 20
TILE = 256
#: Each bucket's first list is this much longer than its even share of k.
SPARE = 3


def whole_vectors(df: DataFrame) -> DataFrame:
    """vec_id, v: components as floor(1024 * x), of the vectors that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).withColumn("x", x).where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long"), F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows as float64 where that is exact, else as Python integers."""
    lists = column.combine_chunks()
    flat = np.asarray(lists.flatten(), np.int64)
    lengths = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lengths), width), np.int64)
    if len(lengths) and (lengths == width).all():
        out[:] = flat.reshape(-1, width)
    else:
        for i, part in enumerate(np.split(flat, np.cumsum(lengths)[:-1])):
            out[i, : len(part)] = part
    return out


def widest(*tables: pa.Table) -> int:
    return max((int(np.diff(np.asarray(t.column("v").combine_chunks().offsets)).max(initial=0)) for t in tables if t.num_rows), default=0)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products, as int64 (values beyond it end at its limits)."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    exact = q.astype(object) @ c.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by (score, smaller id)."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


ENTRY = "query_id long, vec_id long, score long"


def entries(rows: list[tuple[int, int, int]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])


def first_lists(r: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        one_thread()
        width = widest(candidates, queries)
        qids, ids = queries.column("vec_id").to_numpy(), candidates.column("vec_id").to_numpy()
        rows = []
        if len(qids) and len(ids):
            c = matrix(candidates.column("v"), width)
            for i in range(0, len(qids), TILE):
                s = products(matrix(queries.column("v").slice(i, TILE), width), c)
                for q, of in zip(qids[i : i + TILE], s, strict=True):
                    other = np.flatnonzero(ids != q)
                    at = other[best(of[other], ids[other], r)]
                    rows += [(int(q), int(ids[j]), int(of[j])) for j in at]
        return entries(rows)

    return run


def above(candidates: pa.Table, queries: pa.Table) -> pa.Table:
    """What may reach the cutoff by its bound, resolved exactly: entries at or above it."""
    one_thread()
    width = widest(candidates, queries)
    qids, ids = queries.column("vec_id").to_numpy(), candidates.column("vec_id").to_numpy()
    if not len(qids) or not len(ids):
        return entries([])
    c = matrix(candidates.column("v"), width)
    half = (width + 1) // 2
    c_rest = np.sqrt((c[:, half:].astype(np.float64) ** 2).sum(1))
    cut, cut_id = (queries.column(n).fill_null(0).to_numpy() for n in ("cut", "cut_id"))
    all_in = queries.column("cut").is_null().to_numpy(zero_copy_only=False)
    rows = []
    for i in range(0, len(qids), TILE):
        q = matrix(queries.column("v").slice(i, TILE), width)
        part = products(q[:, :half], c[:, :half]).astype(np.float64)
        rest = np.sqrt((q[:, half:].astype(np.float64) ** 2).sum(1))[:, None] * c_rest
        bound = part + rest * (1 + 1e-9) + 1 + np.abs(part) * 1e-9
        for k in range(len(q)):
            own, least = qids[i + k], i + k
            at = np.flatnonzero((all_in[least] | (bound[k] >= cut[least])) & (ids != own))
            if not len(at):
                continue
            s = products(q[k : k + 1], c[at])[0]
            keep = all_in[least] | (s > cut[least]) | (s == cut[least]) & (ids[at] <= cut_id[least])
            rows += [(int(own), int(v), int(x)) for v, x in zip(ids[at][keep], s[keep], strict=True)]
    return entries(rows)


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best of all vectors but its own.

    vectors and queries: vec_id, v (array of long).
    """
    vectors, queries = written(vectors, "topk-vectors"), written(queries.groupBy("vec_id").agg(F.max("v").alias("v")), "topk-queries")
    sizes = vectors.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    n, n_queries, fit = sizes["n"], queries.count(), max(1, CELL_BYTES // (8 * max(sizes["width"], 1)))
    per = min(max(n // 64, BUCKET_ROWS[0]), BUCKET_ROWS[1], fit)
    buckets, blocks = max(1, -(-n // per)), max(1, -(-n_queries // min(QUERY_BLOCK, fit)))
    c = vectors.withColumn("bucket", F.pmod(F.xxhash64("vec_id", "v"), F.lit(buckets))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    q = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    deal = lambda df: df.groupBy("bucket", "block")
    lists = deal(c).cogroup(deal(q)).applyInArrow(first_lists(min(k, -(-k // buckets) + SPARE)), ENTRY)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoffs = lists.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).where(F.col("r") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("cut"), F.col("vec_id").alias("cut_id"))
    cutoffs = written(cutoffs, "topk-cutoffs")
    found = deal(c).cogroup(deal(q.join(cutoffs, "vec_id", "left"))).applyInArrow(above, ENTRY)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
