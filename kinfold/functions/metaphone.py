"""The original Metaphone code of a word, and the UDF for lists of words."""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

VOWELS = "AEIOU"


@functools.lru_cache(200_000)
def metaphone(word: str) -> str:
    """Sound key by L. Philips' published rules of 1990; '' for words without letters."""
    w = "".join(c for c in word.upper() if "A" <= c <= "Z")
    if not w:
        return ""
    if w[:2] in ("AE", "GN", "KN", "PN", "WR"):
        w = w[1:]
    elif w[0] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    n, out, i = len(w), [], 0
    at = lambda k: w[k] if 0 <= k < n else ""
    while i < n:
        c, before, after = w[i], at(i - 1), at(i + 1)
        if c == before and c != "C":
            i += 1
            continue
        if c in VOWELS:
            if i == 0:
                out.append(c)
        elif c == "B":
            if not (before == "M" and i == n - 1):
                out.append("B")
        elif c == "C":
            if before == "S" and after and after in "EIY":
                pass
            elif w[i : i + 3] == "CIA":
                out.append("X")
            elif after == "H":
                out.append("K" if before == "S" or i == 0 and at(2) and at(2) not in VOWELS else "X")
                i += 1
            elif after and after in "EIY":
                out.append("S")
            else:
                out.append("K")
        elif c == "D":
            if after == "G" and at(i + 2) and at(i + 2) in "EIY":
                out.append("J")
                i += 1
            else:
                out.append("T")
        elif c == "G":
            if after == "H" and i + 2 < n and at(i + 2) not in VOWELS or after == "N" and (i + 2 == n or w[i + 2 :] == "ED"):
                pass
            elif after == "H" and i + 2 == n:
                pass
            elif after and after in "EIY" and before != "G":
                out.append("J")
            else:
                out.append("K")
        elif c == "H":
            if before and before in "CSPTG":
                pass
            elif after and after in VOWELS:
                out.append("H")
        elif c == "K":
            if before != "C":
                out.append("K")
        elif c == "P":
            if after == "H":
                out.append("F")
                i += 1
            else:
                out.append("P")
        elif c == "Q":
            out.append("K")
        elif c == "S":
            if after == "H":
                out.append("X")
                i += 1
            elif w[i : i + 3] in ("SIO", "SIA"):
                out.append("X")
            else:
                out.append("S")
        elif c == "T":
            if w[i : i + 3] in ("TIA", "TIO"):
                out.append("X")
            elif after == "H":
                out.append("0")
                i += 1
            elif w[i : i + 3] != "TCH":
                out.append("T")
        elif c == "V":
            out.append("F")
        elif c in "WY":
            if after and after in VOWELS:
                out.append(c)
        elif c == "X":
            out.append("KS")
        elif c == "Z":
            out.append("S")
        else:
            out.append(c)
        i += 1
    return "".join(out)


@pandas_udf(StringType())
def sounds(s: pd.Series) -> pd.Series:
    """The codes of words between single spaces, likewise; words are remembered by each worker."""
    return s.map(lambda words: " ".join(map(metaphone, words.split(" "))))
