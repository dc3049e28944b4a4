"""That pairs of both tracks meet by entity, and what is equal in a class of names is done once."""

import pytest

from kinfold.operators import blocking, metrics, pairs
from tests.test_size import plan, table

TRUTH = [("S1-0", "S2-1"), ("S1-0", "S2-none"), ("S1-3", "S3-2"), ("S1-8", "S2-1")]


@pytest.fixture
def two(spark):
    rows = [(f"S1-{k}", "S1", k, "US", "amber bakers", "") for k in range(5)]
    rows += [("S1-0", "S1", 9, "US", "birch foundry", ""), ("S1-1", "S1", 8, "", "amber", ""), ("S1-7", "S1", 7, "", "amber bakers", "")]
    rows += [("S2-1", "S2", 1, "US", "amber vintners", ""), ("S3-2", "S3", 2, "US", "birch bakers", ""), ("S3-2", "S3", 3, "US", "amber bakers", "")]
    return table(spark, rows), spark.createDataFrame(TRUTH, "s1_id string, cand_id string")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_features_are_found_once_a_class(spark, two):
    r, truth = two
    members, found = pairs.name_classes(r, with_sound=False)
    want = pairs.labelled(pairs.with_name_features(blocking.block_names(r, with_sound=False).select("s1_id", "cand_id"), r), truth)
    got = pairs.of_members(members, found, truth)
    assert rows(got) == rows(want) and members.count() == 5 and found.count() < want.count()
    assert members.select("class").distinct().count() == 3  # S1-0 has two names, the last of S1-1 is another
    assert "hashpartitioning(s1_id, cand_id" not in plan(got).replace("#", "")


def test_a_sweep_counts_true_pairs_before_its_rows_multiply(spark, two):
    _, truth = two
    scored = spark.createDataFrame([("S1-0", "S2-1", 1, 0.5), ("S1-0", "S3-2", 0, 0.2), ("S1-4", "S2-1", 0, 0.9)], "s1_id string, cand_id string, label int, probability double")
    p = plan(metrics.threshold_sweep(scored, truth), "optimizedPlan")
    assert "Join" not in p.split("Generate explode")[0]
    at = {x.threshold: x for x in metrics.threshold_sweep(scored, truth).collect()}
    assert (at[0.5].n_actual, at[0.5].n_predicted, at[0.5].n_correct) == (2, 2, 1)


def test_a_query_of_names_normalizes_no_addresses(spark, monkeypatch):
    from kinfold.plans import adapter, registry

    kept, inner = [], adapter.stored
    monkeypatch.setattr(adapter, "stored", lambda df, name: kept.append(df.columns) or inner(df, name))
    registry.QUERIES["block_names"](spark, "/root/testdata/sf0.001")
    assert kept == [registry.NAMED]  # and its pairs are not stored beside the result


def lists(spark):
    names = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"])], "s1_id string, ids array<string>")
    addresses = spark.createDataFrame([("a", ["y", "z"]), ("c", ["x", "w"])], "s1_id string, ids array<string>")
    truth = spark.createDataFrame([("a", "y"), ("a", "q"), ("b", "x"), ("b", "x"), ("c", "z"), ("d", "x")], "s1_id string, cand_id string")
    return names, addresses, truth


def flat(df):
    return df.selectExpr("s1_id", "explode(ids) AS cand_id")


def test_tracks_meet_by_entity(spark):
    n, a, t = lists(spark)
    got = pairs.tracks_of_lists(n, a, t)
    assert rows(got) == rows(pairs.labelled(pairs.union_tracks(flat(n), flat(a)), t)) and got.count() == 6
    assert rows(pairs.tracks_of_lists(n, a)) == rows(pairs.union_tracks(flat(n), flat(a)))
    assert "cand_id" not in "".join(x for x in plan(got).split("\n") if "Exchange" in x)


def test_boosted_scores_reads_a_stored_matrix(spark, monkeypatch):
    from kinfold.plans import registry

    monkeypatch.setattr(registry, "merged_matrix", lambda s, d, names: s.createDataFrame([("a", "x", 1)], "s1_id string, cand_id string, label int"))
    got = []
    monkeypatch.setattr(registry.model, "train", lambda m: got.append(m))
    monkeypatch.setattr(registry.model, "score", lambda fitted, m: m)
    assert registry.boosted_scores(spark, "").columns[-1] == "validation"
    assert "Scan parquet" in plan(got[0]) and "Project" not in plan(got[0])


def test_true_pairs_are_looked_up_in_lists(spark):
    n, a, t = lists(spark)
    found = metrics.true_in_lists(n, a, t)
    assert rows(metrics.captured(found)) == rows(metrics.combined_recall(flat(n), flat(a), t))
    assert rows(found.where("NOT n AND NOT a").select("s1_id", "cand_id")) == rows(metrics.missed_pairs(flat(n), flat(a), t))
    assert found.where("n").count() == 2 and found.where("a").count() == 1


#: Queries that read each track once.
ONCE = [
    "macro_f05", "provenance_counts", "runner_ratios", "union_tracks", "best_threshold_sound", "block_names", "combined_recall_sound", "entity_split", "entity_split_sound", "labels_sound", "macro_f05_sound", "missed_pairs", "name_features_sound",
]


@pytest.mark.parametrize("name", ONCE)
def test_candidates_that_are_read_once_are_not_stored(spark, monkeypatch, name):
    from kinfold.plans import adapter, registry

    columns = "entity_id string, source string, pos long, country string, name_norm string, address_norm string, city_norm string, pincode string, landmark string, address_core string"
    df = spark.createDataFrame([("S1-1", "S1", 1, "US", "amber", "", "", "", "", ""), ("S2-1", "S2", 2, "US", "amber", "", "", "", "", "")], columns)
    monkeypatch.setattr(registry, "records", lambda s, d: df)
    monkeypatch.setattr(registry, "truth", lambda s, d: spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cand_id string"))
    made = []
    monkeypatch.setattr(adapter, "stored", lambda x, n: made.append(n) or x)
    registry.QUERIES[name](spark, "")
    assert made == []


ADDRESSES = "entity_id string, source string, pos long, country string, address_norm string, address_core string, city_norm string, pincode string"


def places(spark, more=()):
    """Of the weak key '12 ced': 40 candidates, some of them found by other passes too; of another, 9."""
    rows = [(f"S1-{k}", "S1", k, "US", f"12 cedar {k}", f"cedar word{k % 7}", "tyler" if k == 3 else "", "70100" if k % 2 else "") for k in range(8)]
    rows += [("S1-8", "S1", 8, "US", "77 mill", "", "", ""), ("S1-9", "S1", 9, "", "12 cedar 1", "", "", "")]
    rows += [(f"S2-{k}", "S2", k, "US", f"12 cedar {k * 3}", f"word{k % 9}", "tyler" if k > 35 else "", "70100" if k % 5 == 0 else "") for k in range(40)]
    rows += [(f"S3-{k}", "S3", k, "US", f"77 mill {k}", f"cedar word{k}" if k < 4 else "", "", "") for k in range(9)]
    return spark.createDataFrame([*rows, *more], ADDRESSES)


@pytest.mark.parametrize("cap, bucket", [(1, 40), (3, 40), (3, 39), (6, 8), (25, 500)])
def test_weak_pairs_are_looked_up_to_the_cap(spark, cap, bucket):
    r = places(spark)
    sides = r.where("source = 'S1'"), r.where("source <> 'S1'")
    want = blocking.top_pairs(blocking.pairs_of(blocking.address_postings(sides[0]), blocking.dropped(blocking.address_postings(sides[1]), bucket)), cap)
    got = blocking.block_addresses(r, cap, bucket)
    assert rows(got) == rows(want) and got.count() > 0
    assert {(x.s1_id, i) for x in blocking.address_lists(r, cap, bucket).collect() for i in x.ids} == {(x.s1_id, x.cand_id) for x in want.collect()}
    assert any(x.lstrip(" :+-").startswith("Filter") and "rank#" in x and f"<= {cap})" in x for x in plan(got, "optimizedPlan").split("\n"))


def test_records_that_repeat_an_id_are_looked_up_whole(spark):
    r = places(spark, [("S1-0", "S1", 20, "US", "77 mill road", "", "", ""), ("S2-39", "S2", 90, "US", "12 cedar 99", "", "", "")])
    want = blocking.top_pairs(blocking.pairs_of(blocking.address_postings(r.where("source = 'S1'")), blocking.dropped(blocking.address_postings(r.where("source <> 'S1'")), 100)), 3)
    assert rows(blocking.block_addresses(r, 3, 100)) == rows(want)
    assert want.where("s1_id = 'S1-0'").count() == 3


#: Queries on both tracks, without features.
TRACKS = ["provenance_counts", "runner_ratios", "union_tracks", "combined_recall", "combined_recall_sound", "entity_split", "entity_split_sound", "labels_sound", "missed_pairs"]


@pytest.mark.parametrize("name", TRACKS)
def test_queries_of_tracks_make_no_columns_of_features(name):
    from kinfold.plans import registry

    assert registry.NEEDS[name] == [*registry.NAMED, "address_norm", "address_core", "city_norm", "pincode"]


def test_white_space_goes_as_the_pattern_says(spark):
    from pyspark.sql import functions as F

    from kinfold.functions import text

    odd = ["", " ", "　a b \n", "\x85x\r\n", "a \n", "\x1ca\x1f", "​a ", "é ", None, "\n\n"]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    assert df.where(~F.regexp_replace("x", r"(?U)^\s+|\s+$", "").eqNullSafe(text.strip_text(F.col("x")))).count() == 0
