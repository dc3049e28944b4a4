"""Each query of the reference operators against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from kinfold.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents part customer supplier".split()


@pytest.fixture(scope="module")
def duck():
    if not Path(SF).exists():
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def shown(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name, monkeypatch):
    if name == "boosted_scores":  # 500 trees take minutes; that the query asks for them is tested below
        from kinfold.plans import registry

        inner = registry.model.train
        monkeypatch.setattr(registry.model, "train", lambda m: inner(m, iterations=5))
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    q = duck.execute(ORACLES[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(shown(r[names.index(c)]) for c in cols) for r in q.fetchall())


def test_boosted_scores_takes_the_operator_s_defaults(spark, monkeypatch):
    from kinfold.plans import registry

    got = []
    monkeypatch.setattr(registry.model, "train", lambda m, **kw: got.append(kw))
    monkeypatch.setattr(registry.model, "score", lambda fitted, m: m)
    registry.boosted_scores(spark, SF)
    assert got == [{}]


def test_queries_that_build_on_all_name_passes(spark, monkeypatch):
    from kinfold.plans import registry

    columns = "entity_id string, source string, pos long, country string, name_norm string, address_norm string, city_norm string, pincode string, landmark string, address_core string"
    rows = [("S1-1", "S1", 1, "US", "philips", "", "", "", "", ""), ("S2-1", "S2", 2, "US", "filips", "", "", "", "", "")]
    df = spark.createDataFrame(rows, columns)
    monkeypatch.setattr(registry, "records", lambda s, d: df)
    monkeypatch.setattr(registry, "truth", lambda s, d: spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cand_id string"))
    for name in ("labels_sound", "name_features_sound", "merged_matrix_sound", "name_ratios_sound"):
        assert [(r.s1_id, r.cand_id) for r in registry.QUERIES[name](spark, "").collect()] == [("S1-1", "S2-1")]
    assert registry.missed_pairs(spark, "", registry.block_names_sound).count() == 0 and registry.QUERIES["entity_split_sound"](spark, "").first()["rows"] == 1
    assert registry.QUERIES["union_tracks"](spark, "").count() == 0


def test_entities_reach_every_branch_of_normalization(spark):
    from kinfold.functions import fixed
    from kinfold.plans import adapter

    e = [r.asDict() for r in adapter.entities(spark, SF).collect()]
    r = [x.asDict() for x in adapter.records(spark, SF).collect()]
    names, places = " | ".join(x["business_name"].lower() for x in e), " | ".join(x["business_address"].lower() for x in e)
    forms = {f.strip() for _, f in fixed.LEGAL_FORMS}
    norm = " | ".join(f" {x['name_norm']} " for x in r)
    # what a shorter form has taken already is not left for a longer one
    assert {f for f in forms if f" {f} " not in norm} <= {"pllc"}
    assert all(a.lower() + " " in names for a in adapter.ALIASES) and all(f"{h.lower()} " in names for h in adapter.HONORIFICS)
    assert "(id: " in names and "[#" in names and "é" in names and "[" in names
    assert all(m.split()[0].lower() in places for m in adapter.LANDMARKS) and sum(x["landmark"] != "" for x in r) > 50
    assert all(w in places for w in ("plot no", "h.no", "s. no", "p.o. box", "#", "côte"))
    for country in ("US", "India", "France", ""):
        own = [x for x in r if x["country"] == country]
        assert any(x["pincode"] for x in own) and any(x["city_norm"] for x in own)
    assert any(not x["pincode"] and x["address_norm"] for x in r) and any("-" in x["pincode"] for x in r)
    assert any(x["business_address"] == "" for x in e) and any(x["business_name"] == "" for x in e)


def test_entry_and_oracles_name_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
