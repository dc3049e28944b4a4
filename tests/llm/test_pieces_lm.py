import itertools
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import gru_lm as lm
from kinfold.llm import pieces

have = Path(pieces.default_model()).exists()
ids_of = lambda b: np.frombuffer(b, np.int32).tolist()


@pytest.fixture(scope="module")
def v():
    if not have:
        pytest.skip("no vocabulary file")
    return pieces.vocabulary(Path(pieces.default_model()).read_bytes())


def odd(n, seed=2, size=60):
    r = random.Random(seed)
    return ["".join(r.choice("ab  \n\té日①thein▁🙂\0|*ﷺ") for _ in range(r.randint(0, size))) for _ in range(n)]


def test_decoding_undoes_encoding(v):
    texts = [*odd(400), "", " ", "  a  ", "▁", "word. " * 300, "x" * 5000, "﷐﷑"]
    for t, e in zip(texts, pieces.encode_all(texts, v), strict=True):
        assert pieces.decode(ids_of(e), v) == t


def test_ids_are_those_of_the_installed_library_on_a_unigram_model(v):
    import sentencepiece

    # the vocabulary file with its model type set to unigram: a later field overrides
    data = Path(pieces.default_model()).read_bytes() + b"\x12\x02\x18\x01"
    u = sentencepiece.SentencePieceProcessor(model_proto=data)
    r = random.Random(11)
    syllables = ["the", "an", "tion", "re", "st", "en", "ou", "li", "ch", "er", "qua", "é", "ing"]
    words = list({"".join(r.choice(syllables) for _ in range(r.randint(1, 5))) for _ in range(3000)})
    last = {i for i in range(u.get_piece_size()) if u.get_score(i) <= pieces.LAST}
    same, n = 0, 0
    for w in words:
        mine, theirs = ids_of(pieces.encode(w, v)), u.encode(w)
        if last.isdisjoint(mine) and last.isdisjoint(theirs):
            n += 1
            same += mine == theirs
            # where they differ, the library has left the better path
            assert mine == theirs or sum(map(u.get_score, mine)) >= sum(map(u.get_score, theirs))
    assert n > 1000 and same > 0.9 * n


def test_ids_that_the_vocabulary_lacks(v):
    a = v.ids["a"]
    assert pieces.decode([a, 10**6, a, -1], v) == "a\ufffda\ufffd" and pieces.decode([], v) == ""


def best_score(s, v):
    """Of all segmentations of a short run."""
    cost = lambda p: v.score.get(p, v.unknown if len(p) == 1 else None)
    out = -math.inf
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(s)]
        parts = [cost(s[a:b]) for a, b in itertools.pairwise(at)]
        if None not in parts:
            out = max(out, sum(parts))
    return out


def test_score_against_brute_force(v):
    runs = [pieces.SPACE + w for w in ["the", "andthe", "hello", "ing.", "é日a", "nation", "qzx|*", "t\nhe"]]
    for s, (score, _) in zip(runs, v.many(runs), strict=True):
        assert score == best_score(s, v) == v.slow(s)[0]


def test_many_runs_as_one_by_one(v):
    runs = list({r for t in odd(300, 5, 40) for r in pieces.runs_of(t)})
    assert v.many(runs) == [v.slow(s) for s in runs]


@pytest.mark.parametrize("chunk", [17, 40, 1000])
def test_chunks_trace_the_same_path(spark, v, chunk):
    texts = [*odd(40, 7, 200), "".join(random.Random(1).choice("thein") for _ in range(3000)), "the nation " * 300]
    rows = [(i if i % 9 else 5, t) for i, t in enumerate(texts) if t]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text, tuple(r.token_ids)) for r in pieces.encoded(docs, giant=20, chunk=chunk).collect())
    assert got == Counter((i, t, tuple(ids_of(pieces.encode(t, v)))) for i, t in rows)


def test_max_plus_scan_is_the_plain_product():
    r = np.random.default_rng(0)
    ms = [np.where(r.random((3, 3)) < 0.3, pieces.NONE, r.integers(-9, 9, (3, 3))) for _ in range(9)]
    want = [ms[0]]
    for m in ms[1:]:
        want.append(pieces.product(want[-1], m))
    assert all((a == b).all() for a, b in zip(pieces.scan(ms), want, strict=True))


def test_encoded_edges(spark, v):
    docs = spark.createDataFrame([(1, None, 7), (2, "", 8), (None, "a b", 9), (None, "a b", 9)], "doc_id long, text string, n_tokens int")
    got = pieces.encoded(docs).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 2, 2]
    assert {r.decoded for r in pieces.decoded(pieces.encoded(docs)).collect()} == {"", "a b"}
    assert pieces.encoded(docs.where("false")).count() == 0


def test_decoding_many_at_once_is_decoding_one_by_one(v, monkeypatch):
    import pyarrow as pa

    data = Path(pieces.default_model()).read_bytes()
    r = random.Random(6)
    lists = [ids_of(pieces.encode(t, v)) for t in odd(60, 3)] + [[], None, [10**6, 5, -3], [r.randrange(32000) for _ in range(50)], [v.first_byte[0xE6], v.first_byte[0x97]]]
    want = [None if x is None else pieces.decode(x, v) for x in lists]
    for step in (1, 30, 10**6):
        monkeypatch.setattr(pieces, "DECODE_IDS", step)
        assert pieces.decode_all(pa.array(lists, pa.list_(pa.int32())), data).to_pylist() == want
    assert pieces.decode_all(pa.array([], pa.list_(pa.int32())), data).to_pylist() == []


def test_query_decodes_what_it_encodes(spark, v, tmp_path):
    rows = [(i, t, "d") for i, t in enumerate([*odd(60, 9, 90), None, "", "the nation " * 20_000])] + [(3, "again", "e")]
    spark.createDataFrame(rows, "doc_id long, text string, decoded string").write.parquet(f"{tmp_path}/documents.parquet")
    got = pieces.op9_pieces(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(x.round_trip for x in got)
    spark.createDataFrame([(1, [10**6], "x")], "doc_id long, token_ids array<int>, decoded string").write.parquet(f"{tmp_path}/ids.parquet")
    assert pieces.decoded(spark.read.parquet(f"{tmp_path}/ids.parquet")).first()["decoded"] == "\ufffd"


def test_longer_pieces_hang_over_a_cut():
    # a vocabulary whose longest piece has 40 characters, in chunks of 25
    word = "abcdefghijklmnopqrstuvwxyzabcdefghijklmn"
    v = pieces.Vocabulary([*"abcdefghijklmnopqrstuvwxyz", pieces.SPACE, word], [-5] * 27 + [-1], list(range(256)))
    v.ids = {p: i for i, p in enumerate(v.score)}
    s = pieces.SPACE + (word + "xyz") * 5
    assert v.longest == 40
    chunks = [(s[i : i + 25 + v.longest - 1], min(25, len(s) - i)) for i in range(0, len(s), 25)]
    ms = [pieces.transfer(x, n, v) for x, n in chunks]
    total = pieces.scan(ms)[-1][0, 0]
    assert total == v.forward(s, {0: 0})[0][-1]


def plain_base(rows, held):
    c = Counter()
    for (_, t), h in zip(rows, held, strict=True):
        if not h:
            c.update([*lm.lower_az(t or "").split(), b"\n"])
    n, d = sum(c.values()), len(c)
    out = []
    for _, t in rows:
        w = [*lm.lower_az(t or "").split(), b"\n"]
        out.append((len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + d + 1)) for x in w)))
    return out


@pytest.mark.parametrize("head", [5, 1000])
def test_base_and_model_scores(spark, head):
    r = random.Random(3)
    text = lambda: " ".join(f"{r.choice('AbCdé')}{r.randint(0, 40)}" for _ in range(r.randint(1, 60)))
    rows = [(i, text()) for i in range(60)] + [(60, None), (61, ""), (62, "unseen words only"), (3, "twice"), (None, "a1")]
    held = [i is not None and i % 7 == 2 for i, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.likelihoods(df, F.coalesce(F.col("doc_id") % 7 == 2, F.lit(False)), head).collect()
    assert len(got) == len(rows)
    want = Counter((i, h, *x[:3], round(x[3], 6)) for (i, _), h, x in zip(rows, held, plain_base(rows, held), strict=True))
    assert Counter((g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == want
    assert all(math.isfinite(g.score) and g.score < 0 for g in got)


def corpus(seed, n=70):
    r = random.Random(seed)
    words = [f"{r.choice('AbCdéñ')}{i}{r.choice(['ing', 'ed', 'ção', ''])}" for i in range(1500)]
    return [(i, " ".join(words[min(int(r.expovariate(0.0025)), 1499)] for _ in range(r.randint(1, 120)))) for i in range(n)]


def plain_score(text, m, counts):
    """The model's log10 probability of a text, a step at a time in plain float64, and counts."""
    side = len(m.bc)
    bands_at = side * (side - 1)
    ranked = [w for w, _ in sorted(((w, c) for w, c in counts.items() if w != b"\n"), key=lambda x: (-x[1], x[0]))]
    own = {w: i + 1 for i, w in enumerate(ranked[: bands_at - 1])} | {b"\n": 0}
    band = Counter()
    for w in ranked[bands_at - 1 :]:
        band[lm.band_of(w, side)] += counts[w] + 1
    g = {n: getattr(m, n).astype(float) for n in lm.Gru.NAMES}
    k, sig = len(g["u"]), lambda x: 1 / (1 + np.exp(-x))
    h, last, total = np.zeros(k), 0, 0.0
    for w in [*lm.lower_az(text or "").split(), b"\n"]:
        x, a = g["wx"][last], h @ g["u"]
        reset, z = sig(x[:k] + a[:k]), sig(x[k : 2 * k] + a[k : 2 * k])
        new = np.tanh(x[2 * k :] + reset * (a[2 * k :] + g["bn"]))
        h = (1 - z) * new + z * h
        out = own.get(w, bands_at + lm.band_of(w, side))
        cls, place = divmod(out, side)
        p, q = h @ g["wc"] + g["bc"], h @ g["wo"][cls] + g["bo"][cls]
        total += (p[cls] - np.log(np.exp(p).sum()) + q[place] - np.log(np.exp(q).sum())) / math.log(10)
        if out >= bands_at:
            total += math.log10((counts[w] + 1) / (band[lm.band_of(w, side)] + 1))
        last = out
    return total


@pytest.mark.parametrize(("head", "often"), [(300, 50), (5000, 50), (5000, 3)])
def test_scores_are_those_of_a_plain_model(spark, head, often, monkeypatch):
    monkeypatch.setattr(lm, "OFTEN", often)
    made = []
    inner = lm.trained
    monkeypatch.setattr(lm, "trained", lambda *a: made.append(inner(*a)) or made[-1])
    rows = corpus(8, 250) + [(900, None), (901, "never seen before these wordsing"), (902, "b1ing " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {g.doc_id: g.score for g in lm.likelihoods(df, F.col("doc_id") % 7 == 2, head).collect()}
    counts = Counter(w for i, t in rows if i % 7 != 2 for w in [*lm.lower_az(t or "").split(), b"\n"])
    assert len(made[0].bc) > lm.LEAST_SIDE or often == 50
    for i, t in rows:
        assert got[i] == pytest.approx(plain_score(t, made[0], counts), rel=1e-4)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 1000)
    monkeypatch.setattr(lm, "START_TOKENS", 800)
    rows = corpus(9, 90) + [(5, "a twin of five")]
    runs = []
    for n in (1, 3, 8):
        df = spark.createDataFrame(random.Random(n).sample(rows, len(rows)), "doc_id long, text string").repartition(n)
        runs.append(sorted((g.doc_id, g.n_tokens, g.score) for g in lm.likelihoods(df, F.col("doc_id") % 7 == 2).collect()))
    for other in runs[1:]:
        assert [x[:2] for x in other] == [x[:2] for x in runs[0]]
        assert [x[2] for x in other] == pytest.approx([x[2] for x in runs[0]], rel=1e-5)


def test_other_columns_may_clash(spark):
    df = spark.createDataFrame([(1, "a b c", "x", 1), (2, "a b", "y", 2)], "doc_id long, text string, row string, ids int")
    assert lm.likelihoods(df, F.lit(False)).count() == 2


def test_no_documents(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = lm.likelihoods(df, F.lit(True)).first()
    assert none.train_tokens == 0 and none.n_known == 0 and none.base_score == 0 and math.isfinite(none.score)
    assert lm.likelihoods(df.where("false"), F.lit(False)).count() == 0


def test_gradients():
    m = lm.Gru.fresh(8, 1, 4)
    r = np.random.default_rng(0)
    tok, tgt, h0 = r.integers(0, 64, (5, 3)), r.integers(0, 64, (5, 3)), r.normal(size=(4, 3)).astype(np.float32)
    reset = np.ones((5, 3), np.float32)
    reset[2, 1] = 0
    for n in lm.Gru.NAMES:
        setattr(m, n, (getattr(m, n) * 5).astype(np.float64))
    h0 = h0.astype(np.float64)
    old, lm.f32 = lm.f32, np.float64
    try:
        loss = lambda: -m.logs(m.run(tok, reset, h0)[0][1:].transpose(0, 2, 1).reshape(-1, 4), tgt.ravel()).sum()
        hs, kept = m.run(tok, reset, h0)
        g: dict = {}
        m.logs(hs[1:].transpose(0, 2, 1).reshape(-1, 4), tgt.ravel(), g)
        m.back(hs, reset, kept, np.ascontiguousarray(g.pop("h").reshape(5, 3, 4).transpose(0, 2, 1)), g)
        for n in ("u", "bn", "wc", "bc", "wo", "bo"):
            w = getattr(m, n)
            for _ in range(4):
                i = tuple(r.integers(0, s) for s in w.shape)
                at = w[i]
                w[i] = at + 1e-5
                up = loss()
                w[i] = at - 1e-5
                down = loss()
                w[i] = at
                assert g[n][i] == pytest.approx((up - down) / 2e-5, abs=1e-5)
    finally:
        lm.f32 = old


def test_state_is_carried_and_lanes_do_not_matter():
    m = lm.Gru.fresh(32, 2)
    r = np.random.default_rng(1)
    ids = [np.append(r.integers(1, 900, n), 0).astype(np.int32) for n in (1, 300, 7, 50, 2, 90)]
    a = lm.in_lanes(m, ids, window=5, lanes=2)
    assert a == pytest.approx(lm.in_lanes(m, ids, window=400, lanes=6), rel=1e-5)
    assert a == pytest.approx([lm.in_lanes(m, [x])[0] for x in ids], rel=1e-5)


def test_outputs_sum_to_one():
    m = lm.Gru.fresh(16, 3)
    h = np.random.default_rng(2).normal(size=(1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(256)
    assert np.exp(m.logs(np.repeat(h, len(every), 0), every)).sum() == pytest.approx(1, abs=1e-4)


def test_training_learns_order():
    ids = [np.array([1, 2, 3, 4, 5, 6, 0] * 30, np.int32) for _ in range(40)]
    m = lm.Gru.fresh(8)
    before = lm.in_lanes(m, ids).sum()
    sums = lm.adagrad(m)
    for _ in range(15):
        lm.in_lanes(m, ids, sums, lanes=8)
    assert lm.in_lanes(m, ids).sum() > before / 5


FAULTS = """
import resource
import numpy as np, pyarrow as pa
from kinfold.llm import gru_lm as g

r = np.random.default_rng(1)
ids = [np.r_[r.integers(1, 2256, 399), 0].astype(np.int16).tobytes() for _ in range(500)]
t = pa.table({"doc_id": pa.array(range(500)), "mark": pa.array(range(500)), "ids": pa.array(ids, pa.binary()), "shard": pa.array([0] * 500, pa.int64())})
model = g.Gru.fresh(48)
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
g.trained_rows(model, g.packed(model, g.adagrad(model)), 4, g.LANES, 1, False)(t)
print(resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before)
"""


def test_training_takes_no_pages_anew_for_each_window():
    import subprocess
    import sys

    out = subprocess.run([sys.executable, "-c", FAULTS], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 40_000
