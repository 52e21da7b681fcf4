"""Metaphone, from its published rules, over arrays of tokens."""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

FRONT, VOWELS = "eiy", "aeiou"


@functools.lru_cache(200_000)
def metaphone(word: str) -> str:
    w = "".join(c for c in word.lower() if c.isalpha() and c.isascii())
    if not w:
        return ""
    if w[:2] in ("kn", "gn", "pn", "wr", "ae"):
        w = w[1:]
    elif w[0] == "x":
        w = "s" + w[1:]
    elif w[:2] == "wh":
        w = "w" + w[2:]
    out, n = [], len(w)
    for i, c in enumerate(w):
        before, after, then = w[i - 1] if i else "", w[i + 1] if i + 1 < n else "", w[i + 2] if i + 2 < n else ""
        if c == before and c != "c":
            continue
        if c in VOWELS:
            if i == 0:
                out.append(c.upper())
        elif c == "b":
            if not (before == "m" and i == n - 1):
                out.append("B")
        elif c == "c":
            if after and after in FRONT:
                if after == "i" and then == "a":
                    out.append("X")
                elif before != "s":
                    out.append("S")
            elif after == "h":
                out.append("K" if before == "s" else "X")
            else:
                out.append("K")
        elif c == "d":
            out.append("J" if after == "g" and then and then in FRONT else "T")
        elif c == "g":
            if after == "h" and not (i + 2 >= n or then in VOWELS):
                continue
            if after == "n" and (i + 2 >= n or w[i + 1 :] == "ned"):
                continue
            if before == "d" and after and after in FRONT:
                continue
            if after == "h" and i + 2 >= n:
                continue
            out.append("J" if after and after in FRONT and before != "g" else "K")
        elif c == "h":
            if after and after in VOWELS and before not in ("c", "s", "p", "t", "g"):
                out.append("H")
        elif c == "k":
            if before != "c":
                out.append("K")
        elif c == "p":
            out.append("F" if after == "h" else "P")
        elif c == "q":
            out.append("K")
        elif c == "s":
            out.append("X" if after == "h" or (after == "i" and then in ("o", "a") and then) else "S")
        elif c == "t":
            if after == "i" and then in ("o", "a") and then:
                out.append("X")
            elif after == "h":
                out.append("0")
            elif not (after == "c" and then == "h"):
                out.append("T")
        elif c == "v":
            out.append("F")
        elif c in "wy":
            if after and after in VOWELS:
                out.append(c.upper())
        elif c == "x":
            out.append("KS")
        elif c == "z":
            out.append("S")
        else:
            out.append(c.upper())
    return "".join(out)


def coded(token: str) -> str:
    return metaphone(token) or (token[:1] + "".join(c for c in token[1:] if c not in "aeiouy"))[:4]


@F.pandas_udf(ArrayType(StringType()))
def metaphones(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda x: [coded(t) for t in x] if x is not None else [])


def metaphone_tokens(core: Column) -> Column:
    return metaphones(core)
