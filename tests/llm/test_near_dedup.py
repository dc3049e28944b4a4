import random
from collections import defaultdict

import pytest

from kinfold.llm import components, near_dedup


def plain(rows, n=4):
    """component of each id, by comparing all pairs."""
    sets = defaultdict(set)
    links = []
    texts = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
        texts.append((i, s))
        sets[i] |= s
    par = {i: i for i, _ in rows if i is not None}

    def top(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, (i, s) in enumerate(texts):
        for j, t in texts[:a]:
            if s and t and i is not None and j is not None and 100 * len(s & t) >= 80 * len(s | t):
                links.append((i, j))
    for i, j in links:
        x, y = top(i), top(j)
        par[max(x, y)] = min(x, y)
    return {i: top(i) for i in par}, {i: len(s) for i, s in texts}


def check(spark, rows, n=4):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.deduplicated(df, n).collect()
    assert len(got) == len(rows)
    comp, size = plain(rows, n)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == comp[r.doc_id] and r.kept == (r.doc_id == comp[r.doc_id])
    return got


def edited(r, words, k):
    out = list(words)
    for i in r.sample(range(len(out)), k):
        out[i] = f"x{r.randint(0, 10**9)}"
    return " ".join(out)


def test_groups_near_the_threshold(spark):
    r = random.Random(5)
    base = [f"w{r.randint(0, 5000)}" for _ in range(120)]
    rows = [(i, edited(r, base, r.randint(0, 8))) for i in range(60)]
    quoted = " ".join(f"q{i}" for i in range(40))
    rows += [(100 + i, quoted + " " + " ".join(f"z{r.randint(0, 10**6)}" for _ in range(100))) for i in range(40)]
    check(spark, rows)


@pytest.mark.parametrize("seed", range(4))
def test_long_lists_are_posted_by_what_sets_members_apart(spark, monkeypatch, seed):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "HUBS", 2)
    monkeypatch.setattr(near_dedup, "LIST", 16)
    seen = []
    inner = near_dedup.field_links

    def watched(rows, docs, n):
        out = inner(rows, docs, n)
        seen.append((rows.count(), out.count()))
        return out

    monkeypatch.setattr(near_dedup, "field_links", watched)
    r = random.Random(seed)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, edited(r, base, r.randint(2, 9))) for i in range(70)]
    rows += [(100 + i, edited(r, base[: r.randint(60, 99)], r.randint(0, 5))) for i in range(40)]
    # chains away from the rest: edits upon edits
    words = base
    for i in range(25):
        words = edited(r, words, 2).split()
        rows.append((200 + i, " ".join(words)))
    r.shuffle(rows)
    check(spark, rows)
    assert seen[0][0] > 0


def test_edges(spark):
    long = " ".join(f"l{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A\tB"), (6, "a b c d"), (7, "a b c"), (8, "same text as the next one here"), (8, "same text as the next one here"), (9, "same text as the next one here"), (None, "same text as the next one here"), (10, long), (11, long + " end")]
    got = check(spark, rows)
    sizes = {r.doc_id: r.n_shingles for r in got}
    assert sizes[1] == sizes[2] == sizes[3] == 0 and sizes[4] == 1 and sizes[10] == 29997


def test_a_repeated_id_ties_its_texts(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "g h i j k l"), (3, "g h i j k l")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in near_dedup.deduplicated(df).collect()} == {1}


def test_empty(spark):
    assert near_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string, component_id string")).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 60)]])
def test_components(spark, links):
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    par = {}
    for a, b in links:
        par.setdefault(a, a), par.setdefault(b, b)
    for _ in par:
        for a, b in links:
            par[a] = par[b] = min(par[a], par[b])
    assert got == {k: v for k, v in par.items() if k != v}


def test_written_tables_can_be_released(spark):
    from pathlib import Path

    from kinfold.llm import common

    df = common.written(spark.range(5).toDF("a"), "kept")
    assert df.count() == 5
    place = df.inputFiles()[0].removeprefix("file:").replace("///", "/")
    assert Path(place).exists() and common.release(spark) >= 1 and not Path(place).exists()
