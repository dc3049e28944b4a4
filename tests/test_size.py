"""That queries over many pairs do each dear step once; results are compared elsewhere."""

from kinfold.operators import blocking, pairs

SF = "/root/testdata/sf0.001"
COLUMNS = "entity_id string, source string, pos long, country string, name_norm string, address_norm string"


def plan(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_a_query_normalizes_its_records_once(spark, monkeypatch):
    from kinfold.plans import adapter, registry

    made, inner = [], adapter.normalized
    monkeypatch.setattr(adapter, "normalized", lambda e: made.append(1) or inner(e))
    registry.QUERIES["merged_matrix"](spark, SF)
    assert len(made) == 1
    registry.QUERIES["normalized_names"](spark, SF)  # another query has tables of its own
    assert len(made) == 2


def test_grams_stay_out_of_the_pairs_joins(spark):
    r = table(spark, [("S1-1", "S1", 1, "US", "amber bakers", "")])
    ids = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, cand_id string")
    assert "struct<g:" not in pairs.with_name_features(ids, r)._jdf.queryExecution().analyzed().schema().toString()
    assert "sequence(" not in plan(pairs.with_name_features(ids, r))


def test_equal_names_are_looked_up_once(spark):
    rows = [(f"S1-{k}", "S1", k, "US", "amber bakers", "") for k in range(5)] + [("S1-0", "S1", 9, "India", "birch foundry", ""), ("S2-1", "S2", 1, "US", "amber vintners", ""), ("S2-2", "S2", 2, "India", "birch optics", "")]
    r = table(spark, rows)
    classes, members = blocking.by_name(r.where("source = 'S1'"))
    assert classes.count() == 3 and members.count() == 5  # S1-0 has two records, the four others one name
    got = {(x.s1_id, x.cand_id, x.block_reason) for x in blocking.block_names(r, with_sound=False).collect()}
    assert got == {(f"S1-{k}", "S2-1", "prefix+token") for k in range(5)} | {("S1-0", "S2-2", "prefix+token")}


def test_checks_read_the_lists_from_a_table(spark):
    from kinfold.plans import registry

    assert "ArrowEvalPython" not in plan(registry.QUERIES["violations"](spark, SF))


def test_sound_keys_need_no_join(spark):
    from kinfold.functions.metaphone import metaphone

    lists = [["philips", "1234", "knitwear"], ["1234"], [], ["amber", "amber"]]
    df = blocking.phonetic(spark.createDataFrame([(f"S1-{i}", "S1", w) for i, w in enumerate(lists)], "entity_id string, source string, words array<string>"))
    assert [r.codes for r in df.orderBy("entity_id").collect()] == [[metaphone(w) for w in ws] for ws in lists]
    assert "Join" not in plan(df) and "Exchange" not in plan(df)
