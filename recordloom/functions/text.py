"""Normalisation of names and addresses as Column expressions. Token lists are arrays."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that names and addresses are rewritten or cut by.
LANDMARK_CUES = ("near", "nr", "opp", "opposite", "behind", "beside", "next to", "adjacent to", "pres de", "face a", "a cote de", "en face")
LEGAL_SUFFIXES = (
    "ltd", "limited", "pvt", "private", "inc", "incorporated", "corp", "corporation", "co", "company", "llc", "llp", "plc", "sarl", "sas", "sasu", "sa", "eurl",
    "sci", "snc", "gmbh", "ag", "bv", "nv", "the", "and", "sons", "l", "c", "p", "s", "a", "r", "e", "u",
)
ABBREVIATIONS = {
    "st": "street", "rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bd": "boulevard", "dr": "drive", "ln": "lane", "hwy": "highway",
    "pl": "place", "sq": "square", "ct": "court", "pkwy": "parkway", "mkt": "market", "nr": "near", "opp": "opposite", "bldg": "building", "apt": "apartment",
    "fl": "floor", "ste": "suite", "pvt": "private", "ltd": "limited", "corp": "corporation", "inc": "incorporated", "co": "company", "intl": "international",
    "mfg": "manufacturing", "svc": "service", "svcs": "services", "ind": "industries", "ents": "enterprises", "bros": "brothers", "ctr": "center", "ctre": "centre",
    "mgmt": "management", "assoc": "associates", "tech": "technologies",
}


@F.pandas_udf(StringType())
def folded(s: pd.Series) -> pd.Series:
    """Compatibility forms taken apart, combining marks dropped, case folded."""

    def one(x: str | None) -> str:
        if x is None:
            return ""
        if x.isascii():
            return x.lower()
        x = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", x))
        return "".join(c for c in x if not unicodedata.combining(c)).casefold()

    return s.map(one)


def norm_text(c: Column) -> Column:
    """Lower-case ASCII letters, digits and single spaces; null is empty."""
    x = F.regexp_replace(F.regexp_replace(F.regexp_replace(folded(c), "&", " and "), "@", " at "), "'", "")
    return F.trim(F.regexp_replace(F.regexp_replace(x, "[^0-9a-z ]+", " "), " +", " "))


def number_of(c: Column) -> Column:
    """32 bits of a text's MD5, which any engine can compute."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")


def words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def joined(a: Column, sep: str = " ") -> Column:
    return F.array_join(a, sep)


def literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])


def expanded(c: Column, table: dict[str, str] | None = None) -> Column:
    """Every token replaced by its long form, once."""
    m = literal_map(ABBREVIATIONS if table is None else ABBREVIATIONS | table)
    return joined(F.transform(words(c), lambda t: F.coalesce(m[t], t)))


def core_tokens(tokens: Column) -> Column:
    """Tokens that aren't legal forms, or all if nothing else is left."""
    c = F.filter(tokens, lambda t: ~t.isin(*LEGAL_SUFFIXES))
    return F.when(F.size(c) > 0, c).otherwise(tokens)


def suffix_text(tokens: Column) -> Column:
    return joined(F.filter(tokens, lambda t: t.isin(*LEGAL_SUFFIXES) & (F.length(t) > 1)))


def is_number(t: Column) -> Column:
    return t.rlike("^[0-9]+$")


def acronym(core: Column) -> Column:
    return joined(F.transform(F.filter(core, lambda t: ~is_number(t)), lambda t: F.substring(t, 1, 1)), "")


def first_of(a: Column) -> Column:
    return F.coalesce(F.try_element_at(a, F.lit(1)), F.lit(""))


def skeleton(t: Column) -> Column:
    """First letter and the consonants after it, four characters at most."""
    return F.substring(F.concat(F.substring(t, 1, 1), F.regexp_replace(F.substring(t, 2, 1 << 20), "[aeiouy]", "")), 1, 4)


def phonetic_tokens(core: Column, coder: str = "skeleton") -> Column:
    some = F.filter(core, lambda t: (F.length(t) >= 2) & ~is_number(t))
    if coder == "metaphone":
        from .phonetic import metaphones

        return metaphones(some)
    return F.transform(some, skeleton)


def landmark_at(addr: Column) -> Column:
    """0-based place of the first cue, in the order of the cues, or null."""
    out = F.lit(None).cast("int")
    for cue in reversed(LANDMARK_CUES):
        inside = F.instr(addr, f" {cue} ")
        out = F.when(inside > 0, inside - 1).when(addr.startswith(f"{cue} "), 0).otherwise(out)
    return out


def without_landmark(addr: Column, at: Column) -> Column:
    after = words(F.substring(addr, at + 1, F.lit(1 << 20)))
    rest = joined(F.slice(after, F.lit(5), F.greatest(F.size(after), F.lit(1))))
    return F.when(at.isNull(), addr).otherwise(F.trim(F.concat(F.substring(addr, F.lit(1), at), F.lit(" "), rest)))


def landmark(addr: Column, at: Column) -> Column:
    after = words(F.substring(addr, at + 1, F.lit(1 << 20)))
    return F.when(at.isNull(), "").otherwise(joined(F.slice(after, 1, 4)))


def digit_runs(addr: Column) -> Column:
    return F.regexp_extract_all(addr, F.lit("([0-9]+)"), 1)


def codes(addr: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(digit_runs(addr), lambda x: F.length(x) >= 4)))


def numbers(addr: Column) -> Column:
    short = F.filter(digit_runs(addr), lambda x: F.length(x) < 4)
    bare = F.transform(short, lambda x: F.when(F.regexp_replace(x, "^0+", "") == "", "0").otherwise(F.regexp_replace(x, "^0+", "")))
    return F.array_sort(F.array_distinct(bare))


def char_grams(text: Column, sizes: tuple[int, ...] = (3, 4)) -> Column:
    """n-grams of characters inside each word with a blank on either side, with repeats."""

    def of_size(p: Column, n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(p) - (n - 1), F.lit(1)))
        return F.when(F.length(p) >= n, F.transform(places, lambda i: F.substring(p, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    def of(w: Column) -> Column:
        p = F.concat(F.lit(" "), w, F.lit(" "))
        return F.concat(*[of_size(p, n) for n in sizes])

    return F.flatten(F.transform(words(text), of))
