"""Similarities of a pair of normalized names or addresses, as Column expressions.

Two ratios need the longest common subsequence, which Spark hasn't: Arrow batches. So does the
trigram cosine of many pairs, which costs the JVM a nested loop for each.
"""

from __future__ import annotations

import functools
from collections import Counter
from math import sqrt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from kinfold.functions import fixed
from kinfold.functions.text import let, tokens


def four(c: Column) -> Column:
    return F.round(c, 4)


def levenshtein_sim(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 0 if either is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


GRAMS = "array<struct<g:string,c:int>>"


def gram_counts(c: Column, n: int = 3) -> Column:
    """array<struct<g, c>> of character n-grams; a shorter text is one gram, an empty has none."""
    grams = F.when(F.length(c) < n, F.array(c)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n))))
    counted = let(grams, lambda gs: F.transform(F.array_distinct(gs), lambda g: F.struct(g.alias("g"), F.size(F.filter(gs, lambda x: x == g)).alias("c"))))
    return F.when(c != "", counted).otherwise(F.array().cast(GRAMS))


def gram_cosine(ga: Column, gb: Column) -> Column:
    """Cosine of two gram_counts."""
    dot = let(F.map_from_entries(gb), lambda m: F.aggregate(ga, F.lit(0).cast("long"), lambda acc, x: acc + x["c"] * F.coalesce(F.element_at(m, x["g"]), F.lit(0))))
    norm = lambda g: F.sqrt(F.aggregate(g, F.lit(0).cast("long"), lambda acc, x: acc + x["c"] * x["c"]).cast("double"))
    return F.when((F.size(ga) > 0) & (F.size(gb) > 0), dot / (norm(ga) * norm(gb))).otherwise(F.lit(0.0))


def ngram_cosine(a: Column, b: Column, n: int = 3) -> Column:
    return gram_cosine(gram_counts(a, n), gram_counts(b, n))


@functools.lru_cache(20_000)
def counted(text: str) -> tuple[dict[str, int], float]:
    """gram_counts of a text as a dictionary, and their norm."""
    grams = Counter([text] if len(text) < 3 else [text[i : i + 3] for i in range(len(text) - 2)])
    return dict(grams), sqrt(sum(c * c for c in grams.values()))


def plain_cosine(a: str, b: str) -> float:
    """ngram_cosine, outside of the JVM."""
    if not a or not b:
        return 0.0
    (x, p), (y, q) = counted(a), counted(b)
    if len(x) > len(y):
        x, y = y, x
    get = y.get
    return sum([c * get(g, 0) for g, c in x.items()]) / (p * q)


@pandas_udf(DoubleType())
def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([plain_cosine(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        u = s & at.get(ch, 0)
        s = (s + u | s - u) & full
    return (~s & full).bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


# The same names meet in many pairs.
@functools.lru_cache(50_000)
def sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


@functools.lru_cache(50_000)
def set_ratio(a: str, b: str) -> float:
    """1 if one side's words hold the other's; else the best of three comparisons."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, only_a, only_b = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if common and (not only_a or not only_b):
        return 1.0
    join = lambda p, q: f"{p} {q}" if p and q else p or q
    full_a, full_b = join(common, only_a), join(common, only_b)
    ratios = [indel_ratio(full_a, full_b)]
    if common:
        ratios += [indel_ratio(common, full_a), indel_ratio(common, full_b)]
    return max(ratios)


@pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([sort_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([set_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


def name_features(a: Column, b: Column) -> dict[str, Column]:
    """The six name features; all 0 if either name is empty."""
    empty = (a == "") | (b == "")
    out = {
        "levenshtein_sim": four(levenshtein_sim(a, b)),
        "token_jaccard": four(jaccard(tokens(a), tokens(b))),
        "char_ngram_cos": four(cosine(a, b)),
        "token_sort_ratio": four(token_sort_ratio(a, b)),
        "token_set_ratio": four(token_set_ratio(a, b)),
    }
    return {k: F.when(empty, F.lit(0.0)).otherwise(v).alias(k) for k, v in out.items()} | {"exact_match": F.when(~empty & (a == b), 1).otherwise(0).alias("exact_match")}


def numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)\b\d+\b"), F.lit(0)))


def digit_overlap(a: Column, b: Column) -> Column:
    x, y = numbers(a), numbers(b)
    return F.when(a == b, F.when(F.size(x) > 0, F.lit(1.0)).otherwise(F.lit(0.0))).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(four(jaccard(x, y)))


def house_number(c: Column) -> Column:
    return F.regexp_extract(F.lower(F.trim(c)), "(?U)" + fixed.HOUSE_NUMBER, 1)


def len_ratio(a: Column, b: Column) -> Column:
    la, lb = F.length(a), F.length(b)
    return four(F.when((la == 0) | (lb == 0), F.lit(0.0)).otherwise(F.least(la, lb) / F.greatest(la, lb)))


def token_overlap(a: Column, b: Column) -> Column:
    """Common words; equal addresses count each of their words, repeats too."""
    return F.when(a == b, F.size(tokens(a))).otherwise(F.size(F.array_intersect(tokens(a), tokens(b))))


def landmark_sim(a: Column, b: Column) -> Column:
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(four(jaccard(tokens(a), tokens(b))))


def both_equal(a: Column, b: Column) -> Column:
    return F.when((a != "") & (b != "") & (a == b), 1).otherwise(0)


def address_features(x: str, y: str) -> dict[str, Column]:
    """The thirteen address features of columns prefixed `x` and `y` (address_norm, pincode,
    city_norm, country, landmark)."""
    c = lambda p, n: F.coalesce(F.col(p + n), F.lit(""))
    a, b = c(x, "address_norm"), c(y, "address_norm")
    empty = (a == "") | (b == "")
    grams = F.when(empty, F.lit(0.0)).when(a == b, F.lit(1.0)).otherwise(four(cosine(a, b)))
    text = lambda v, zero=0.0: F.when(empty, F.lit(zero)).otherwise(v)
    out = {
        "levenshtein_sim": four(levenshtein_sim(a, b)),
        "token_jaccard": text(four(jaccard(tokens(a), tokens(b)))),
        "tfidf_cosine": grams,
        "exact_pincode_match": both_equal(c(x, "pincode"), c(y, "pincode")),
        "exact_city_match": both_equal(F.lower(c(x, "city_norm")), F.lower(c(y, "city_norm"))),
        "exact_country_match": both_equal(F.upper(c(x, "country")), F.upper(c(y, "country"))),
        "exact_address_match": both_equal(a, b),
        "char_ngram_cos": grams,
        "token_overlap_count": text(token_overlap(a, b), 0),
        "address_len_ratio": len_ratio(a, b),
        "digit_overlap_ratio": text(digit_overlap(a, b)),
        "house_number_match": both_equal(house_number(a), house_number(b)),
        "landmark_sim": landmark_sim(c(x, "landmark"), c(y, "landmark")),
    }
    return {k: v.alias(k) for k, v in out.items()}
