import pytest
from pyspark.sql import functions as F

from kinfold.operators import metrics, model, pairs, validate
from kinfold.operators.records import assert_scoring_universe, assert_unique_ids
from kinfold.sources import tsv


@pytest.mark.parametrize(("p", "r", "f"), [(1, 1, 1), (0, 1, 0), (1, 0, 0), (0, 0, 0), (0.8, 0.6, 0.75)])
def test_f(spark, p, r, f):
    assert spark.range(1).select(metrics.f_beta(F.lit(float(p)), F.lit(float(r)))).first()[0] == pytest.approx(f)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_macro_and_sweep(spark):
    pairs = frame(spark, [("a", 1, 0.9), ("a", 0, 0.6), ("b", 0, 0.2), ("c", 1, 0.4)], "s1_id string, label int, probability double")
    truth = frame(spark, [("a", "x"), ("c", "y"), ("d", "z")], "s1_id string, cand_id string")
    m = metrics.macro_f05(pairs, truth, 0.5).first()
    # a: P 1/2 R 1; b: singleton, none predicted; c: nothing predicted of one
    assert m.precision == pytest.approx((0.5 + 1 + 0) / 3) and m.recall == pytest.approx((1 + 1 + 0) / 3) and m.f05 == pytest.approx((1.25 * 0.5 / 1.125 + 1 + 0) / 3)
    whole = metrics.macro_f05(pairs, truth, 0.5, universe=frame(spark, [("a",), ("d",), ("e",)], "s1_id string")).first()
    assert whole.f05 == pytest.approx((1.25 * 0.5 / 1.125 + 1 + 0 + 0 + 1) / 5)
    sweep = {r.threshold: r for r in metrics.threshold_sweep(pairs, truth).collect()}
    assert len(sweep) == 81
    for t in (0.1, 0.4, 0.41, 0.9):
        assert sweep[t].f05 == pytest.approx(metrics.macro_f05(pairs, truth, t).first().f05)
    best = metrics.best_threshold(metrics.threshold_sweep(pairs, truth)).first()
    assert best.threshold == min(t for t, r in sweep.items() if r.f05 == max(x.f05 for x in sweep.values()))


def test_singleton_scores(spark):
    none = frame(spark, [], "s1_id string, cand_id string")
    one = lambda p: metrics.macro_f05(frame(spark, [("a", 0, p)], "s1_id string, label int, probability double"), none).first().f05
    assert one(0.1) == 1 and one(0.9) == 0


def test_validation_rules(spark):
    lists = frame(spark, [("S1-1", "S2-1,S2-1"), ("S1-1", ""), ("S1-2", "S1-1,X-1,S3-9"), ("S1-8", "")], "source1_entity_id string, matched_entity_ids string")
    need = frame(spark, [("S1-1",), ("S1-2",), ("S1-3",)], "s1_id string")
    known = frame(spark, [("S2-1",)], "cand_id string")
    got = {(r.rule, r.id) for r in validate.list_violations(lists, "matched_entity_ids", need, known).collect()}
    assert got == {("duplicate row", "S1-1"), ("repeated id in list", "S1-1"), ("self match", "S1-1"), ("wrong prefix", "X-1"), ("unknown id", "S3-9"), ("missing entity", "S1-3"), ("extra entity", "S1-8")}
    cands = frame(spark, [("S1-1", "S2-1"), ("S1-2", "")], "source1_entity_id string, candidate_entity_ids string")
    v = validate.validate(lists, cands, need, known)
    assert {r.id for r in v.where("severity = 'warning'").collect()} == {"S1-2"}
    assert validate.validate(lists, None, need).where("rule = 'file absent'").count() == 1
    e = {(r.file, r.rule): r for r in validate.examples(v).collect()}
    assert e["matches", "duplicate row"].n == 1 and e["matches", "duplicate row"].examples == ["S1-1"]
    points = {r.rule: r.passed for r in validate.fifteen_points(lists, cands, need, known).collect()}
    assert len(points) == 15 and not points[2] and not points[9] and not points[11] and points[14]
    assert validate.header_errors("a,b\n", ["a"]) and validate.header_errors("", ["a"]) and not validate.header_errors("A\tb\n", ["a", "b"])


def test_files_round_trip(spark, tmp_path):
    src = tmp_path / "s1.tsv"
    src.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Open\t 5 Oak \tUS \nS1-2\tNA\t\t\n\tx\ty\tz\nS1-3\tZ\n', encoding="utf-8")
    e = tsv.read_entities(spark, str(src), "S1")
    assert [tuple(r) for r in e.select("entity_id", "business_name", "business_address", "country").orderBy("pos").collect()] == [("S1-1", '"Open', " 5 Oak ", "US"), ("S1-2", "NA", "", ""), ("S1-3", "Z", "", "")]
    assert_unique_ids(e)
    assert assert_scoring_universe(e) == 3
    with pytest.raises(ValueError):
        assert_scoring_universe(e, "x/train_source1.tsv")
    with pytest.raises(ValueError):
        assert_unique_ids(e.union(e))
    m = frame(spark, [("S1-1", "S3-2"), ("S1-1", "S2-9"), ("S1-1", "S1-2")], "s1_id string, cand_id string")
    tsv.write_submission(e, m, m, str(tmp_path / "m.tsv"), str(tmp_path / "c.tsv"))
    assert (tmp_path / "m.tsv").read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-9,S3-2\nS1-2\t\nS1-3\t\n"
    pairs, universe = tsv.read_ground_truth(spark, str(tmp_path / "m.tsv"))
    assert pairs.count() == 2 and universe.count() == 3
    assert tsv.candidate_pairs(tsv.read_tsv(spark, str(tmp_path / "c.tsv"))).count() == 2
    ids = [r.entity_id for r in e.orderBy("pos").collect()]
    universe = frame(spark, list(enumerate(ids)), "pos long, entity_id string")
    back = tsv.read_tsv(spark, str(tmp_path / "m.tsv")).withColumn("pos", F.monotonically_increasing_id())
    assert validate.out_of_order(back, universe).count() == 0
    assert validate.out_of_order(back.withColumn("pos", 2 - F.col("pos")), universe).count() == 2


def test_split_train_score_save(spark, tmp_path):
    rows = [(f"S1-{i // 10}", f"S2-{i}", float(i % 10 == 0), float(i % 7) / 7, int(i % 10 == 0)) for i in range(1000)]
    m = frame(spark, rows, "s1_id string, cand_id string, levenshtein_sim double, token_jaccard double, label int")
    for split in (model.split_entities, model.split_exact):
        s = split(m)
        sides = s.groupBy("s1_id").agg(F.count_distinct("validation").alias("n")).where("n > 1").count()
        assert sides == 0 and split(m.orderBy(F.desc("cand_id"))).where("validation").count() == s.where("validation").count()
    assert model.split_exact(m).where("validation").select("s1_id").distinct().count() == 20
    s = model.split_exact(m)
    fitted = model.train(s, iterations=5, depth=2)
    out = model.score(fitted, s).agg(F.avg((F.col("prediction_at_0_5") == F.col("label")).cast("int"))).first()[0]
    assert out > 0.99
    assert model.importances(fitted, spark).first().feature == "levenshtein_sim"
    model.save(fitted, str(tmp_path / "m"))
    again, about = model.load(str(tmp_path / "m"))
    assert about["feature_cols"] == ["levenshtein_sim", "token_jaccard"] and model.score(again, s).count() == 1000


def test_features_and_guards(spark):
    assert model.feature_columns(["token_jaccard", "x", "levenshtein_sim"]) == ["levenshtein_sim", "token_jaccard"]
    with pytest.raises(ValueError):
        model.assert_no_ids(["source1_x"])
    df = frame(spark, [("a", "0.5", None), ("b", "odd", "2")], "s1_id string, levenshtein_sim string, token_jaccard string")
    got = model.numeric(df).orderBy("s1_id").collect()
    assert [(r.levenshtein_sim, r.token_jaccard, r.addr_landmark_sim) for r in got] == [(0.5, 0, 0), (0, 2, 0)]


def test_blocking_reports(spark):
    rec = frame(spark, [("S1-1", "S1", "US"), ("S1-2", "S1", "US"), ("S1-3", "S1", "FR"), ("S2-1", "S2", "US"), ("S2-2", "S2", "US")], "entity_id string, source string, country string")
    pairs = frame(spark, [("S1-1", "S2-1"), ("S1-1", "S2-2")], "s1_id string, cand_id string")
    truth = frame(spark, [("S1-1", "S2-1"), ("S1-2", "S2-2")], "s1_id string, cand_id string")
    r = metrics.blocking_report(pairs, truth, rec, per_all=True).first()
    assert (r.total_s1, r.candidate_pairs, r.captured_pairs, r.full_recall, r.zero_recall) == (3, 2, 1, 1, 1)
    assert r.avg_candidates == pytest.approx(2 / 3) and r.reduction_ratio == pytest.approx(1 - 2 / 6)
    assert metrics.blocking_report(pairs, truth, rec, per_all=False).first().avg_candidates == 2
    assert metrics.missing_counts(frame(spark, [(None,), (" ",), ("x",)], "a string"), ["a"]).first().missing_a == 2


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes(b"country\tentity_id\textra\tbusiness_name\tbusiness_address\nUS\tS1-1\tx\tCaf\xe9\t5 Oak\n")
    row = tsv.read_entities(spark, str(tmp_path / "a.tsv"), "S1").first()
    assert (row.entity_id, row.business_name, row.business_address, row.country) == ("S1-1", "Caf\ufffd", "5 Oak", "US")
    (tmp_path / "b.tsv").write_text("entity_id\tname\nS1-1\tx\n")
    with pytest.raises(ValueError, match="business_name"):
        tsv.read_entities(spark, str(tmp_path / "b.tsv"), "S1")
    with pytest.raises(ValueError, match="probability"):
        metrics.threshold_sweep(frame(spark, [("a", 1)], "s1_id string, label int"), frame(spark, [], "s1_id string, cand_id string"))
    with pytest.raises(ValueError, match="token_jaccard"):
        none = frame(spark, [], "s1_id string, cand_id string, levenshtein_sim double")
        pairs.merged(none, none)


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = spark.read.text(str(tmp_path / "a.txt"))
        assert df.rdd.getNumPartitions() > 3
        got = tsv.in_file_order(df.where("value NOT LIKE '%7'")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in sorted(got, key=lambda r: r.row)] == [f"line {i}" for i in range(5000) if i % 10 != 7] and {r.row for r in got} == set(range(4500))


def test_results_are_replaced_not_removed(spark, tmp_path):
    e = frame(spark, [("S1-1", 0), ("S1-2", 1)], "entity_id string, pos long")
    for cand in ("S2-1", "S2-2"):
        m = frame(spark, [("S1-1", cand)], "s1_id string, cand_id string")
        tsv.write_submission(e, m, m, str(tmp_path / "m.tsv"), str(tmp_path / "c.tsv"))
        assert (tmp_path / "m.tsv").read_text().split()[2:] == ["S1-1", cand, "S1-2"]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["c.tsv", "m.tsv"]


def test_the_last_of_repeated_records_counts(spark):
    rec = frame(spark, [("S1-1", 0, "old name"), ("S1-1", 5, "new name"), ("S2-1", 1, "new name")], "entity_id string, pos long, name_norm string")
    row = pairs.with_name_features(frame(spark, [("S1-1", "S2-1")], "s1_id string, cand_id string"), rec).first()
    assert row.exact_match == 1


def test_ratios_of_either_track_and_pairs_side_by_side(spark):
    rec = frame(spark, [("S1-1", "S1", "US"), ("S1-2", "S1", " "), ("S2-1", "S2", "US"), ("S2-2", "S2", ""), ("S3-1", "S3", "FR")], "entity_id string, source string, country string")
    one = frame(spark, [("S1-1", "S2-1")], "s1_id string, cand_id string")
    got = {r.track: r for r in metrics.runner_ratios(one, one, rec).collect()}
    assert (got["name"].total_s1, got["address"].total_s1, got["name"].total_cands) == (1, 2, 2)
    assert got["name"].reduction_ratio == pytest.approx(1 - 1 / 2) and got["address"].reduction_ratio == pytest.approx(1 - 1 / 4) and got["address"].avg_candidates == pytest.approx(0.5)
    e = frame(spark, [("S1-1", "S1", 0, "US", "x" * 36), ("S2-1", "S2", 0, "US", "y" * 41)], "entity_id string, source string, pos long, country string, business_name string")
    shown = metrics.side_by_side(one.union(frame(spark, [("S1-1", "S3-9")], "s1_id string, cand_id string")), e).collect()
    assert [(r.s1_name, r.source, r.cand_name) for r in shown] == [("x" * 32 + "...", "S2", "y" * 40 + "..."), ("x" * 32 + "...", "S3", "UNKNOWN")]
