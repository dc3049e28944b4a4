import random
from collections import Counter
from math import sqrt

import pytest
from pyspark.sql import functions as F

from kinfold.functions import similarity as sim

#: lev, jaccard, cosine, sort, set, exact of recorded pairs.
GOLDEN = [
    ("soify inc", "inc soify", (0.1111, 1.0, 0.5714, 1.0, 1.0, 0)),
    ("board of aging", "board of services", (0.5882, 0.5, 0.5217, 0.5161, 0.7273, 0)),
    ("lekha baer corp", "corp lekha bbner", (0.25, 0.5, 0.5189, 0.9032, 0.9032, 0)),
    ("club de lecole", "club de lecole", (1, 1, 1, 1, 1, 1)),
    ("", "x", (0, 0, 0, 0, 0, 0)),
]


def test_recorded_name_features(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(GOLDEN)], "i int, a string, b string")
    got = df.select("i", *sim.name_features(F.col("a"), F.col("b")).values()).orderBy("i").collect()
    for row, (_, _, want) in zip(got, GOLDEN, strict=True):
        assert tuple(row)[1:] == pytest.approx(want, abs=1e-4)


def plain_cosine(a, b, n=3):
    g = lambda s: Counter([s] if 0 < len(s) < n else [s[i : i + n] for i in range(len(s) - n + 1)])
    x, y = g(a), g(b)
    if not x or not y:
        return 0.0
    return sum(c * y[k] for k, c in x.items()) / (sqrt(sum(c * c for c in x.values())) * sqrt(sum(c * c for c in y.values())))


def test_cosine_and_ratios_against_plain_ones(spark):
    r = random.Random(3)
    pairs = [("".join(r.choice("abé ") for _ in range(r.randint(0, 14))), "".join(r.choice("abé ") for _ in range(r.randint(0, 14)))) for _ in range(150)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", sim.ngram_cosine(F.col("a"), F.col("b"))).orderBy("i").collect()
    for row, (a, b) in zip(got, pairs, strict=True):
        assert row[1] == pytest.approx(plain_cosine(a, b), abs=1e-12)

    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    assert all(sim.lcs(a, b) == lcs(a, b) for a, b in pairs)


def features(spark, a, b, **more):
    from kinfold.functions.similarity import GRAMS, gram_counts

    base = {"pincode": "", "city_norm": "", "country": "US", "landmark": ""}
    row = [{**base, **x} for x in (a, b)]
    cols = list(base) + ["address_norm"]
    df = spark.createDataFrame([tuple(row[k][c] for k in (0, 1) for c in cols)], ", ".join(f"{p}_{c} string" for p in "ab" for c in cols))
    df = df.withColumns({f"{p}_address_grams": gram_counts(F.col(f"{p}_address_norm")).cast(GRAMS) for p in "ab"})
    return df.select(*sim.address_features("a_", "b_").values()).first().asDict()


def test_address_features(spark):
    same = features(spark, {"address_norm": "1 a a road 1"}, {"address_norm": "1 a a road 1"})
    assert same["token_overlap_count"] == 5 and same["digit_overlap_ratio"] == 1 and same["char_ngram_cos"] == same["tfidf_cosine"] == 1 and same["house_number_match"] == 1
    other = features(spark, {"address_norm": "1 a a road 1", "landmark": "near x | y", "pincode": "1"}, {"address_norm": "1 a lane 2", "landmark": "near z | y", "country": "us"})
    assert other["token_overlap_count"] == 2 and other["digit_overlap_ratio"] == 0.5 and other["exact_country_match"] == 1 and other["exact_pincode_match"] == 0
    assert other["landmark_sim"] == 0.6 and other["address_len_ratio"] == round(10 / 12, 4)
    none = features(spark, {"address_norm": ""}, {"address_norm": "x"})
    assert all(v == 0 for k, v in none.items() if k != "exact_country_match")
