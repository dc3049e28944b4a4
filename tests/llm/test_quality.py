import random
from collections import Counter
from math import log

import numpy as np
import pytest

from kinfold.llm import quality_classifier as qc
from kinfold.llm import quality_rules as qr

WHITE = " \t\n\x0b\x0c\r"


def plain_stats(text):
    text = text or ""
    words, w = [], ""
    for c in text + " ":
        if c in WHITE:
            words += [w] if w else []
            w = ""
        else:
            w += c
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    cover = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


TEXTS = [None, "", " \n ", "a", "a b c a b c", "x y z\nx y z\n\nx y z", "a a a a a", "é ü #*$ <>|&% b", "w " * 60, "one two three four five\x85six\x1cseven", "\n".join(["same line"] * 5)]


def test_base_counts(spark):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice("ab\n #é") for _ in range(r.randint(0, 200))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in qr.judge(df, np.zeros(8)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, chars, symbols, dup, rep = plain_stats(t)
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert x.base_failed == (n < 50 or 100 * rep > 50 * n) and x.kept == (not x.base_failed)


def test_many_distinct_words_in_one_text():
    w = np.arange(3_000_000) % 2_500_000
    assert qr.repeat_words(w) == 2 * 500_000


def test_ratio_against_brute_force(spark):
    good = ["the old man and the sea is a fine book " * 6] * 3
    bad = ["*** BUY $$$ now %%% " * 14] * 3
    rows = list(enumerate([*good, *bad, None]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = spark.createDataFrame([(0,), (1,), (1,)], "doc_id long")
    ratios = qr.log_ratios(qr.gram_counts(docs, ids))

    def grams(text):
        flat, starts = qr.numbered([qr.words_of(text)], ids_ := qr.Ids())
        one, two = qr.grams(flat, starts, ids_.crc, qr.BUCKETS)
        return [*one, *two]

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i < 2:
            target.update(grams(t))
    n, m, prior = sum(raw.values()), sum(target.values()), qr.PRIOR * qr.BUCKETS

    def score(t):
        g = grams(t)
        pr = lambda k: (raw[k] + 1) / (n + qr.BUCKETS)
        return sum(log((target[k] + prior * pr(k)) / (m + prior) / pr(k)) for k in g) / len(g) if g else 0.0

    got = {x.doc_id: x.score for x in qr.judge(docs, ratios).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(score(t), abs=1e-9)
    assert got[2] > got[3]


def test_no_trusted_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 60), (1, "a " * 60), (None, "b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert {x.score for x in qr.judge(docs, qr.log_ratios(qr.gram_counts(docs, none))).collect()} == {0.0}
    empty = docs.where("false")
    assert qr.judge(empty, qr.log_ratios(qr.gram_counts(empty, none))).count() == 0


def corpus(n, seed):
    r = random.Random(seed)
    words = ["the", "of", "house", "river", "stone", "and", "walks", "light", "morning", "under"]
    good = lambda: " ".join(r.choice(words) + r.choice(["", "", ",", "."]) for _ in range(r.randint(30, 120)))
    junk = lambda: r.choice([lambda: " ".join(r.choice(words).upper() + "!!" for _ in range(50)), lambda: " ".join(r.choice(words) + "%%%" for _ in range(60)), lambda: ("same " * 50)])()
    return [(i, good() if i % 4 else junk(), int(bool(i % 4))) for i in range(n)]


def test_classifier_ranks_held_out_rows(spark):
    rows = corpus(1200, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows[:800]], "doc_id long, text string")
    pos = spark.createDataFrame([(i,) for i, _, y in rows[:800] if y and i % 2], "doc_id long")
    model = qc.trained(docs, pos)
    assert 0.5 < model.prior < 0.95
    held = spark.createDataFrame([(i, t, "x") for i, t, _ in rows[800:]], "doc_id long, text string, score string")
    got = {x.doc_id: x.predicted for x in qc.scored(held, model).collect()}
    assert sum(got[i] == y for i, _, y in rows[800:]) > 0.95 * 400


def test_risk_never_goes_below_zero_by_fitting():
    r = np.random.default_rng(0)
    pos, unl = r.normal(1, 1, (50, 30)), r.normal(0, 1, (60, 30))
    assert np.isfinite(qc.fit_risk(pos, unl, 0.5, steps=300)).all()


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x " * 50000), (3, "x " * 50000), (None, "\x00#|")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    model = qc.trained(docs, none)
    assert [x.score for x in qc.scored(docs, model).collect()] == [0.5] * 5
    assert qc.scored(docs.where("false"), model).count() == 0
    assert np.isfinite(qc.features([None, "", "a", "퟿" * 3, "é" * 10])).all()


def test_query_against_a_plain_fit(spark, tmp_path):
    from zlib import crc32

    rows = [(i, t, y) for i, t, y in corpus(300, 4)] + [(900, None, 0), (901, "", 0), (902, "the river " * 3000, 1)]
    spark.createDataFrame([(i, t, y) for i, t, y in rows], "doc_id long, text string, score int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y, 0) for i, _, y in rows if i % 2 and i < 900], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    learned = {i for i, _, _ in rows if crc32(str(i).encode()) % 5}
    pos = qc.features([t for i, t, y in rows if i in learned and i % 2 and y and i < 900])
    unl = qc.features([t for i, t, _ in rows if i in learned])
    model = qc.fit(pos, unl)
    got = {x.doc_id: x for x in qc.op10_quality_pu(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        want = model.score(qc.features([t]))[0]
        assert got[i].score == pytest.approx(want, abs=1e-6) and got[i].held_out == (i not in learned)
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_a_sample_keeps_to_its_bound_and_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "concat('text ', id, repeat(' x', id % 7)) as text")
    runs = [qc.gathered(qc.sampled(df.repartition(n), 1000, 20_000, "s"), 1000) for n in (1, 5)]
    assert 800 < len(runs[0]) <= 1000 and (runs[0] == runs[1]).all()
    assert len(qc.gathered(qc.sampled(df, 30_000, 20_000, "s"), 30_000)) == 20_000


def test_queries_without_labels(spark, tmp_path):
    spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {x.score for x in qc.op10_quality_pu(spark, str(tmp_path)).collect()} == {0.5}
    assert {x.score for x in qr.op2_quality_rules(spark, str(tmp_path)).collect()} == {0.0}
