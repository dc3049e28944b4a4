r"""Quality rules: base counts, and a likelihood ratio of hashed n-grams.

Unigrams and bigrams of words are hashed into BUCKETS. Two multinomials, one of the trusted
target (documents labelled good and not toxic) and one of the raw corpus (all documents), are
counted over whole tables; the raw one is smoothed by one, the target towards the raw. A
document's verdict is its mean log(p_target / p_raw) over its n-grams, so length plays no part,
held against a fixed threshold; no document is drawn at random. A trusted document is scored with
a target that counts it too, as every document is with the raw corpus.

Defined results: a null or empty text has no words, fails the base rules and scores 0; with
no trusted document both multinomials are even with the corpus and every score is 0; repeated
rows are scored one by one (and count as often in the corpus); other columns pass by.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import WHITE, small, table, words_of

BUCKETS = 1 << 14
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
THRESHOLD = -0.06
#: Weight of the corpus in the target's smoothing, in n-grams a bucket: where the trusted text
#: is small, rare n-grams of clean documents then don't tell against them.
PRIOR = 10
SYMBOLS = "#*$%&|<>"
#: Words to a step: keeps a task's arrays small whatever the batch.
STEP_WORDS = 400_000


class Ids(dict):
    """word -> running number, with the words' crc32 beside it."""

    def __init__(self):
        self.crc: list[int] = []

    def __missing__(self, w: bytes) -> int:
        n = self[w] = len(self.crc)
        self.crc.append(zlib.crc32(w))
        return n


def steps(texts: list[str | None]):
    """Runs of whole texts of about STEP_WORDS words: (from, to, word lists)."""
    begin, lists, n = 0, [], 0
    for i, t in enumerate(texts):
        lists.append(words_of(t))
        n += len(lists[-1])
        if n >= STEP_WORDS:
            yield begin, i + 1, lists
            begin, lists, n = i + 1, [], 0
    if lists:
        yield begin, len(texts), lists


def numbered(lists: list[list[bytes]], ids: Ids) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 1_000_000:
        ids.clear()
        ids.crc.clear()
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    return np.fromiter((ids[w] for ws in lists for w in ws), np.int64, int(starts[-1])), starts


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def grams(flat: np.ndarray, starts: np.ndarray, crc: list[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the unigrams and of the bigrams; a bigram that would cross texts is -1."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.array(crc, np.uint64)[flat]
    shift = np.uint64(40)
    one = (mixed(h) >> shift).astype(np.int64) % buckets
    two = (mixed(mixed(h[:-1]) + h[1:]) >> shift).astype(np.int64) % buckets
    cut = starts[1:-1] - 1
    two[cut[(cut >= 0) & (cut < len(two))]] = -1
    return one, two


def repeat_words(words: np.ndarray) -> int:
    """Words inside a 3-word window that is found twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    w = words
    if int(w.max()) >= 1 << 21:
        w = np.unique(w, return_inverse=True)[1]
    if int(w.max()) < 1 << 21:
        code = w[:-2] << 42 | w[1:-1] << 21 | w[2:]
    else:
        pairs = np.unique(w[:-1] * (int(w.max()) + 1) + w[1:], return_inverse=True)[1]
        code = pairs[:-1] * (int(w.max()) + 1) + w[2:]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k : n - 2 + k] |= twice
    return int(cover.sum())


def line_stats(text: str) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, raw, target: counts over all documents. Each task sends one row a bucket."""
    marked = docs.select("doc_id", "text").join(small(trusted.select("doc_id").distinct().withColumn("good", F.lit(True))), "doc_id", "left")

    def count(batches):
        raw, target, ids = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64), Ids()
        for b in batches:
            good = np.array(b.column("good").fill_null(False).to_pylist(), bool)
            for i, j, lists in steps(b.column("text").to_pylist()):
                flat, starts = numbered(lists, ids)
                one, two = grams(flat, starts, ids.crc, buckets)
                of = np.repeat(good[i:j], np.diff(starts))
                real = two >= 0
                raw += np.bincount(one, minlength=buckets) + np.bincount(two[real], minlength=buckets)
                target += np.bincount(one[of], minlength=buckets) + np.bincount(two[real & of[:-1]], minlength=buckets)
        k = np.flatnonzero(raw)
        if len(k):
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(raw[k]), pa.array(target[k])], ["bucket", "raw", "target"])

    return marked.select("text", "good").mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log(p_target / p_raw) by bucket. At most `buckets` rows come to the driver."""
    rows = counts.toArrow()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    k = rows.column("bucket").to_numpy()
    raw[k], target[k] = rows.column("raw").to_numpy(), rows.column("target").to_numpy()
    if not target.sum():
        return np.zeros(buckets)
    p_raw = (raw + 1) / (raw.sum() + buckets)
    prior = PRIOR * buckets
    return np.log((target + prior * p_raw) / (target.sum() + prior)) - np.log(p_raw)


OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document: base counts, score and verdict."""
    buckets = len(ratios)
    table_ = np.append(ratios, 0.0)  # -1, no bigram, weighs nothing

    def score(batches):
        ids = Ids()
        for b in batches:
            texts = b.column("text").to_pylist()
            n_words, repeats, scores = [], [], []
            for _, _, lists in steps(texts):
                flat, starts = numbered(lists, ids)
                one, two = grams(flat, starts, ids.crc, buckets)
                total = np.zeros(len(flat) + 1)
                np.cumsum(table_[one] + np.append(table_[two], 0.0)[: len(flat)], out=total[1:])
                n = np.diff(starts)
                scores.append((total[starts[1:]] - total[starts[:-1]]) / np.maximum(2 * n - 1, 1))
                n_words.append(n)
                repeats += [repeat_words(flat[i:j]) for i, j in zip(starts[:-1], starts[1:], strict=True)]
            n, s, r = np.concatenate(n_words or [np.zeros(0, np.int64)]), np.concatenate(scores or [np.zeros(0)]), np.array(repeats, np.int64)
            stats = np.array([line_stats(t or "") for t in texts], np.int64).reshape(-1, 3)
            failed = (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)
            cols = [b.column("doc_id"), pa.array(n), *(pa.array(stats[:, k]) for k in range(3)), pa.array(r), pa.array(failed), pa.array(s), pa.array(~failed & (s >= threshold))]
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in OUT.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, OUT)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, log_ratios(gram_counts(docs, trusted_ids(table(spark, sf_dir, "labels")))))
