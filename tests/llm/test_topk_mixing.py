import math
import random
from collections import defaultdict

import pytest

from kinfold.llm import mixing, topk


def plain(rows, k=10):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return out


def search(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    v = topk.whole_vectors(df)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(v, v.where("vec_id % 100 = 0"), k).collect())


def test_against_brute_force(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(16)], "a") for i in range(700)]
    rows += [(i, [0.5] * 16, "hot") for i in range(700, 1100)]
    assert search(spark, rows) == sorted(plain([x[:2] for x in rows]))


def test_vector_edges(spark):
    rows = [(0, [0.1, 0.2], ""), (100, [1e10, -1e10], ""), (1, None, ""), (2, [None, 1.0], ""), (3, [float("nan"), 1.0], ""), (4, [float("inf"), 1.0], ""), (5, [0.3], ""), (6, [0.3, 0.0, 9.0], ""), (None, [1.0, 1.0], ""), (200, [], "")]
    assert search(spark, rows) == sorted(plain([x[:2] for x in rows]))
    assert search(spark, rows[:1]) == [] and search(spark, []) == []


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "CELL_BYTES", 40 * 9)
    r = random.Random(3)
    rows = [(i * 20, [r.gauss(0, 1) for _ in range(5)], "") for i in range(60)]
    assert search(spark, rows, 3) == sorted(plain([x[:2] for x in rows], 3))


def test_queries_in_tiles():
    import pyarrow as pa

    r = random.Random(5)
    t = pa.table({"vec_id": pa.array(range(1000), pa.int64()), "v": pa.array([[r.randint(-9, 9) for _ in range(4)] for _ in range(1000)], pa.list_(pa.int64()))})
    got = topk.first_lists(3)(t, t.slice(100, 2 * topk.TILE + 7)).to_pylist()
    v = t.column("v").to_pylist()
    for q in (100, 355, 356, 618):
        want = sorted((-sum(a * b for a, b in zip(v[q], x, strict=True)), i) for i, x in enumerate(v) if i != q)[:3]
        assert [(-x["score"], x["vec_id"]) for x in got if x["query_id"] == q] == want


def sources(spark, sizes, extra=()):
    rows = [(i, f"{s}", n) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    return spark.createDataFrame([*rows, *extra], "doc_id long, source string, n long")


def solve_plain(p, h):
    lo, hi = 0.0, 1.0
    for _ in range(60):
        a = (lo + hi) / 2
        w = [x**a for x in p]
        z = sum(w)
        e = -sum(x / z * math.log(x / z) for x in w)
        lo, hi = (a, hi) if e >= h else (lo, a)
    return lo


def test_exponent_meets_the_entropy(spark):
    c = sources(spark, {"a": [10] * 50, "b": [10] * 5, "c": [10]})
    p = [500 / 560, 50 / 560, 10 / 560]
    h1, h0 = -sum(x * math.log(x) for x in p), math.log(3)
    alpha = solve_plain(p, h1 + 0.5 * (h0 - h1))
    got = {r.source: r for r in mixing.plan(c, entropy_gain=0.5).collect()}
    z = sum(x**alpha for x in p)
    for s, x in zip("abc", p, strict=True):
        assert got[s].weight == pytest.approx(x**alpha / z, abs=1e-5)


def test_blocks_are_permutations_under_the_budget(spark):
    r = random.Random(4)
    c = sources(spark, {"a": [r.randint(1, 30) for _ in range(300)], "b": [r.randint(1, 30) for _ in range(40)], "c": [7]})
    w = mixing.plan(c, entropy_gain=0.7)
    plan = {x.source: x for x in w.collect()}
    blocks = defaultdict(list)
    for x in mixing.placed(c, w).collect():
        blocks[x.source, x.mix_block].append((x.mix_key, x.doc_id, x.n))
    total = sum(x.tokens for x in plan.values())
    size = {s: sum(1 for x in c.collect() if x.source == s) for s in "abc"}
    for s, x in plan.items():
        whole = [b for (src, b) in blocks if src == s and len(blocks[src, b]) == size[s]]
        assert len(whole) >= x.whole and set(range(int(x.whole))) <= set(whole)
        placed = sum(n for (src, _), rows in blocks.items() if src == s for _, _, n in rows)
        assert placed <= x.weight * total + 1e-6
        if x.whole < max((b for (src, b) in blocks if src == s), default=-1) + 1:
            last = sorted(blocks.get((s, x.whole), []))
            everyone = sorted((mixing_key(d, x.whole), n) for d, n in ((y.doc_id, y.n) for y in c.collect() if y.source == s))
            assert [k for k, _, _ in last] == [k for k, _ in everyone[: len(last)]]
            if len(last) < len(everyone):
                assert placed + everyone[len(last)][1] > x.weight * total - 1


def mixing_key(doc_id, block):
    import hashlib

    return hashlib.md5(f"{'' if doc_id is None else doc_id}:{block}".encode()).hexdigest()


def test_mix_keeps_every_document(spark):
    rows = [(i, f"w{i} w w", "big" if i < 200 else "small", "k") for i in range(230)] + [(500, "x y z", None, "k"), (501, None, "big", "k"), (7, "w7 w w", "big", "k"), (None, "q r s", "small", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_block string")
    out = mixing.mix(docs, max_epochs=1.5)
    assert out.columns == docs.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r.doc_id, r.source] += 1
    assert {i for i, *_ in rows} <= {i for i, _ in seen}
    assert max(seen[i, "small"] for i in range(200, 230)) == 2 and all(seen[i, "big"] == 1 for i in range(200) if i != 7)


def test_mix_edges(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0
    one = spark.createDataFrame([(1, "a b", "s"), (2, "", "s")], "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in mixing.mix(one).collect()) == [1, 2]
    silent = spark.createDataFrame([(1, "", "s"), (2, None, "t")], "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in mixing.mix(silent).collect()) == [1, 2]
    assert mixing.placed(mixing.counted(silent), mixing.plan(mixing.counted(silent), entropy_gain=0.5)).count() == 0
