"""Names and addresses brought to one form, as Column expressions.

All stay in the JVM but `strip_accents`, for whose NFKD Spark has no function.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from kinfold.functions import fixed


#: What (?U)\s is: Unicode's White_Space.
WHITE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip_text(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE))


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def plain_accents(text: str | None) -> str | None:
    if text is None or text.isascii():
        return text
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


@pandas_udf(StringType())
def _accents(s: pd.Series) -> pd.Series:
    return s.map(plain_accents)


def strip_accents(c: Column) -> Column:
    """NFKD without combining marks, in Arrow batches."""
    return _accents(F.coalesce(c, F.lit("")))


def non_word_to_space(c: Column) -> Column:
    return F.regexp_replace(c, fixed.NON_WORD, " ")


def tokens(c: Column) -> Column:
    """Words of a normalized text; none of an empty one."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def name_core(raw: Column) -> Column:
    """What comes before the accents go: alias clause, metadata id, honorific."""
    text = strip_text(F.coalesce(raw, F.lit("")))
    alias = strip_text(F.regexp_extract(text, fixed.FLAGS + fixed.ALIAS, 1))
    text = F.when(F.length(alias) >= 3, alias).otherwise(text)
    text = F.regexp_replace(text, fixed.FLAGS + fixed.METADATA_ID, " ")
    return F.regexp_replace(text, fixed.FLAGS + fixed.HONORIFIC, "")


def name_form(core: Column) -> Column:
    """The rest, on a text without accents."""
    text = F.lower(F.replace(core, F.lit("&"), F.lit(" and ")))
    for pattern, form in fixed.LEGAL_FORMS:
        text = F.regexp_replace(text, fixed.FLAGS + pattern, form)
    return collapse(non_word_to_space(text))


def normalize_name(raw: Column) -> Column:
    return name_form(strip_accents(name_core(raw)))


def abbreviations() -> Column:
    return F.create_map(*[F.lit(x) for kv in fixed.ABBREVIATIONS.items() for x in kv])


def expand_words(words: Column) -> Column:
    return F.transform(words, lambda t: F.coalesce(F.element_at(abbreviations(), t), t))


def address_form(plain: Column) -> Column:
    """An address without accents in its normal form."""
    text = F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit(" and ")), F.lit("#"), F.lit(" number ")), F.lit("/"), F.lit(" "))
    text = F.lower(text)
    for pattern, form in fixed.ADDRESS_PHRASES:
        text = F.regexp_replace(text, fixed.FLAGS + pattern, form)
    return F.array_join(expand_words(tokens(collapse(non_word_to_space(text)))), " ")


def normalize_address(raw: Column) -> Column:
    return address_form(strip_accents(strip_text(F.coalesce(raw, F.lit("")))))


def comma_parts(plain: Column) -> Column:
    return F.filter(F.transform(F.split(plain, ","), strip_text), lambda p: p != "")


def first_of(c: Column, pattern: str, group: int = 1) -> Column:
    """The pattern's first match, null if there is none."""
    return F.nullif(F.regexp_extract(c, "(?U)" + pattern, group), F.lit(""))


def pincode(plain: Column, country: Column) -> Column:
    """Postal code of an address without accents; commas part it for every country."""
    c, parts = F.upper(strip_text(F.coalesce(country, F.lit("")))), comma_parts(plain)
    last = F.reverse(tokens(collapse(F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")))))
    us_last = F.try_element_at(F.filter(last, lambda t: t.rlike(r"(?U)^\d{5}(?:-\d{4})?$")), F.lit(1))

    def anywhere(p: Column) -> Column:
        street = p.rlike(fixed.FLAGS + fixed.PINCODE_STREET) & p.rlike(r"(?U)^\d+\s+")
        return F.when(~street, first_of(p, r"\b(\d{5,6})\b"))

    fallback = F.try_element_at(F.filter(F.transform(F.reverse(parts), anywhere), lambda x: x.isNotNull()), F.lit(1))
    by_country = (
        F.when(c == "INDIA", first_of(plain, r"\b([1-9]\d{5})\b"))
        .when(c == "FRANCE", first_of(plain, r"\b(\d{5})\b"))
        .when(c == "US", F.coalesce(first_of(plain, r"\b[A-Z]{2}\s+(\d{5}(?:-\d{4})?)\b"), us_last))
    )
    return F.coalesce(by_country, fallback, F.lit(""))


def landmark(plain: Column) -> Column:
    """Landmark clauses, lower case, between bars."""
    clauses = F.transform(F.regexp_extract_all(plain, F.lit(fixed.FLAGS + fixed.LANDMARK), F.lit(0)), lambda x: F.regexp_replace(x, r"^[ ,;()]+|[ ,;()]+$", ""))
    spelt = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?iU)\bopp\s*\.?\b", "opposite"), r"(?iU)\bnr\s*\.?\b", "near")
    return F.array_join(F.transform(F.filter(clauses, lambda x: F.length(x) >= 4), lambda x: collapse(F.lower(spelt(x)))), " | ")


def let(value: Column, use) -> Column:
    """use(value) with value computed once: inside a lambda or a branch an expression is not shared."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def city(plain: Column) -> Column:
    """The city, where the order of the comma parts tells it."""
    return let(F.transform(comma_parts(plain), lambda p: F.lower(strip_text(F.regexp_replace(p, r"[^\p{L}\p{N}_\s-]", "")))), city_of)


def city_of(parts: Column) -> Column:
    at = lambda k: F.get(parts, F.size(parts) + k) if k < 0 else F.get(parts, F.lit(k))

    def usable(k: int, least: int) -> Column:
        return let(at(k), lambda p: F.when(~p.rlike("(?U)" + fixed.CITY_STREET) & ~p.rlike(r"(?U)^\d+") & (F.length(p) >= least), p))

    found = F.coalesce(
        F.when(at(0).isin(fixed.REGIONS), usable(1, 0)),
        F.when(at(-1).isin(fixed.REGIONS), F.coalesce(usable(-2, 2), usable(-3, 2))),
        usable(-2, 3),
        usable(0, 3),
        F.lit(""),
    )
    return F.when(F.size(parts) > 1, found).otherwise("")


def address_core(normalized: Column, clauses: Column | None = None) -> Column:
    """The address without landmarks. A normalized one has no commas, so a landmark word takes
    all that follows; given the raw text's landmark clauses, only those are removed."""
    if clauses is None:
        return collapse(F.regexp_replace(normalized, fixed.FLAGS + fixed.LANDMARK, " "))
    cut = F.aggregate(F.filter(F.split(clauses, r" \| "), lambda x: x != ""), normalized, lambda acc, x: F.replace(acc, address_form(x), F.lit(" ")))
    return collapse(cut)


def distinctive(words: Column, stopwords: list[str]) -> Column:
    """Words of four characters or more that aren't stopwords; order and repeats stay."""
    return F.filter(words, lambda t: (F.length(t) >= 4) & ~t.isin(stopwords))
