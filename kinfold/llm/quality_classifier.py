"""Quality classifier by positive-unlabelled learning.

Features of the text alone (character classes, word and line repetition, word shapes). The
model is logistic in them and minimises the non-negative unbiased risk

    prior * E_pos[l(+)] + max(0, E_unl[l(-)] - prior * E_pos[l(-)])

over trusted positives and unlabelled web text; labelled negatives are never used. The class
prior is estimated from the same two samples (see `class_prior`).

The fit takes at most FIT_ROWS positives and FIT_ROWS unlabelled rows (a documented bound,
chosen by hash of doc_id); every document is scored, over its whole text.

Defined results: null and empty texts are scored too (0 words); without a single positive row
every score is 0.5; repeated rows are scored one by one; other columns pass by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import crc_rest, one_thread, small, table, tidied

#: Bound on the rows of each kind that the model is fitted on.
FIT_ROWS = 20_000
CUT = 0.3

#: Byte classes, each a share of the bytes that aren't white space.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"#*$%&", b"|<>", b"_-/\\@+=~^", b"()[]{}\"'`"]
LOOKUP = np.full(256, len(CLASSES), np.int64)  # bytes of other scripts and accents
for _k, _c in enumerate(CLASSES):
    LOOKUP[list(_c)] = _k
LOOKUP[list(b" \t\n\x0b\x0c\r")] = len(CLASSES) + 1
LOOKUP[[x for x in range(128) if LOOKUP[x] == len(CLASSES)]] = len(CLASSES) + 2
N_CLASSES = len(CLASSES) + 3
FEATURES = N_CLASSES + 10


def features(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES numbers, each of about the size of one, for every text."""
    out = np.zeros((len(texts), FEATURES))
    for row, text in zip(out, texts, strict=True):
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data:
            continue
        bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        kinds = np.bincount(LOOKUP, weights=bytes_, minlength=N_CLASSES)
        white = kinds[len(CLASSES) + 1]
        solid = max(len(data) - white, 1.0)
        row[:N_CLASSES] = np.sqrt(kinds / solid)
        words = data.split()
        n = max(len(words), 1)
        distinct = len(set(words))
        pairs = sum(map(bytes.__eq__, words, words[1:])) if len(words) > 1 else 0
        lines = [x for x in data.split(b"\n") if x.strip()]
        row[N_CLASSES:] = (
            np.log1p(len(words)) / 8,
            solid / n / 8,
            distinct / n,
            np.log1p(n / max(distinct, 1)),
            pairs / n,
            1 - len(set(lines)) / max(len(lines), 1),
            np.sqrt(sum(map(bytes.isupper, words)) / n),
            np.sqrt(sum(map(bytes.isalpha, words)) / n),
            min(len(lines) / n, 1),
            np.sqrt(sum(len(w) == 1 for w in words) / n),
        )
    return out


def sampled(df: DataFrame, rows: int, n: int, salt: str) -> DataFrame:
    """At most `rows` of the `n` rows of df, but for chance, by hash of doc_id: the same rows
    each time. With column `at`, the hash."""
    at = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(salt))
    df = df.withColumn("at", at)
    # a twentieth less than the bound, which is seven times the spread of the sample's size
    return df if n <= rows else df.where(F.col("at") < int(0.95 * rows / n * 2**64) - 2**63)


def gathered(df: DataFrame, rows: int) -> np.ndarray:
    """Features of at most `rows` rows, at the driver (a row takes 180 bytes), in order of `at`."""

    def compute(batches):
        for b in batches:
            x = features(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("at"), pa.array(list(x), pa.list_(pa.float64()))], ["at", "x"])

    got = df.select("at", "text").mapInArrow(lambda b: tidied(compute(b)), "at long, x array<double>").toArrow().combine_chunks()
    x = np.asarray(got.column("x").combine_chunks().flatten(), np.float64).reshape(-1, FEATURES)
    # equal documents have equal hashes: their features break the tie
    return x[np.lexsort((*x.T[::-1], got.column("at").to_numpy()))][:rows]


def class_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """The share of positives among unlabelled rows, from both kinds' scores.

    For every cut, unlabelled share above / positive share above is at least the prior, but for
    chance; the estimate is the least such ratio over cuts that keep at least a tenth of the
    positives. Chance pulls the least of many ratios down, by little on large samples: a low
    prior makes the model stricter with what differs from the trusted text.
    """
    cuts = np.quantile(pos, np.linspace(0.02, 0.9, 45))
    p = np.array([(pos >= c).mean() for c in cuts])
    u = np.array([(unl >= c).mean() for c in cuts])
    return float(np.clip((u / np.maximum(p, 1e-9)).min(), 0.05, 0.95))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def fit_risk(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights (bias last) of least non-negative risk, by full-batch Adam."""
    w = np.zeros(pos.shape[1] + 1)
    a, b = np.c_[pos, np.ones(len(pos))], np.c_[unl, np.ones(len(unl))]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        sp, su = sigmoid(a @ w), sigmoid(b @ w)
        # l(+) = log(1 + e^-z), l(-) = log(1 + e^z)
        negative = np.mean(-np.log1p(-np.minimum(su, 1 - 1e-12))) - prior * np.mean(-np.log1p(-np.minimum(sp, 1 - 1e-12)))
        up = a.T @ (sp - 1) / len(a) * prior
        down = b.T @ su / len(b) - prior * (a.T @ sp) / len(a)
        g = up + down if negative >= 0 else -down
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


class Model:
    """What every task needs to score: scale and weights, some hundred numbers."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return sigmoid(z @ self.weights[:-1] + self.weights[-1])


def fit(pos: np.ndarray, unl: np.ndarray, prior: float | None = None) -> Model:
    if not len(pos) or not len(unl):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1), 0.5)
    mean, scale = unl.mean(0), unl.std(0) + 1e-3
    p, u = np.clip((pos - mean) / scale, -8, 8), np.clip((unl - mean) / scale, -8, 8)
    if prior is None:
        first = fit_risk(p, u, 0.5)
        prior = class_prior(p @ first[:-1] + first[-1], u @ first[:-1] + first[-1])
    return Model(mean, scale, fit_risk(p, u, prior), prior)


def trained(docs: DataFrame, positives: DataFrame, rows: int = FIT_ROWS, prior: float | None = None) -> Model:
    """A model from documents of `positives` (doc_id) and from unlabelled ones."""
    ids = positives.select("doc_id").where("doc_id IS NOT NULL").distinct()
    chosen = small(sampled(ids, rows, ids.count(), "positive"))
    pos = gathered(docs.select("doc_id", "text").join(chosen, "doc_id"), rows)
    unl = gathered(sampled(docs.select("doc_id", "text"), rows, docs.select(F.lit(1)).count(), "unlabelled"), rows)
    return fit(pos, unl, prior)


def scored(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """All columns of docs and score, predicted."""
    cols = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[docs[c] for c in cols]).schema)

    def compute(batches):
        one_thread()
        for b in batches:
            s = model.score(features(b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= cut).astype(np.int32))], [*b.schema.names, "score", "predicted"])

    return docs.select(*[docs[c] for c in cols]).mapInArrow(lambda b: tidied(compute(b)), f"{schema}, score double, predicted int")


def op10_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = crc_rest("doc_id", 5) != 0
    model = trained(docs.where(learned), labels.where(learned & (F.col("quality") == 1)))
    return scored(docs.select("doc_id", "text"), model).select("doc_id", (~learned).alias("held_out"), "score", "predicted")
