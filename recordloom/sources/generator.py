"""Labelled splits of invented businesses: three sources and their ground truth, as tab-separated files. Every choice is a hash of (entity, what is chosen, copy, seed), so that rows
are the same however they are partitioned, and nothing is shuffled.

`python -m recordloom.sources.generator --out dataset` writes a train split of two countries and a test split with a third that training hasn't seen."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks, tables

# What businesses are called and where they are, by country.
STEMS = {
    "US": ("Anchor", "Bluebird", "Canyon", "Dogwood", "Eagle", "Foundry", "Gateway", "Highland", "Juniper", "Lakeside", "Monarch", "Orchard", "Prairie", "Redwood", "Sterling", "Timber", "Union", "Valley"),
    "India": ("Amrit", "Bhavani", "Chandra", "Deepak", "Ganga", "Himalaya", "Indira", "Jyoti", "Kamal", "Lotus", "Mohan", "Narayan", "Padma", "Rani", "Surya", "Tulsi", "Uday", "Vijay"),
    "France": ("Aurore", "Bellevue", "Clémence", "Dubois", "Étang", "Fontaine", "Gérard", "Hélène", "Lavande", "Mistral", "Noël", "Olivier", "Prévert", "Rocher", "Sévigné", "Tilleul", "Vallée", "Verger"),
}
KINDS = {
    "US": ("Bakery", "Plumbing", "Insurance", "Hardware", "Printing", "Roofing", "Catering", "Pharmacy"),
    "India": ("Textiles", "Jewellers", "Sweets", "Traders", "Electricals", "Stores", "Medicals", "Agencies"),
    "France": ("Boulangerie", "Fleuriste", "Garage", "Librairie", "Menuiserie", "Pharmacie", "Serrurerie", "Traiteur"),
}
FORMS = {  # short, long
    "US": (("Inc", "Incorporated"), ("Corp", "Corporation"), ("LLC", "L.L.C."), ("", "")),
    "India": (("Pvt Ltd", "Private Limited"), ("Ltd", "Limited"), ("& Sons", "and Sons"), ("", "")),
    "France": (("SARL", "S.A.R.L."), ("SAS", "S.A.S."), ("EURL", "E.U.R.L."), ("", "")),
}
STREETS = {  # name, short kind, long kind
    "US": (("Walnut", "St", "Street"), ("Jefferson", "Ave", "Avenue"), ("Harbor", "Rd", "Road"), ("Sunset", "Blvd", "Boulevard"), ("Chestnut", "Ln", "Lane")),
    "India": (("Tilak", "Rd", "Road"), ("Subhash", "Marg", "Marg"), ("Temple", "St", "Street"), ("Patel", "Nagar", "Nagar"), ("Market", "Rd", "Road")),
    "France": (("de la Gare", "R", "Rue"), ("Jean Moulin", "Av", "Avenue"), ("Voltaire", "Bd", "Boulevard"), ("des Écoles", "R", "Rue"), ("de la Paix", "Pl", "Place")),
}
TOWNS = {  # town, region
    "US": (("Fairmont", "OH"), ("Lakewood", "CA"), ("Bristol", "CT"), ("Salem", "OR"), ("Dover", "DE")),
    "India": (("Nagpur", "Maharashtra"), ("Kochi", "Kerala"), ("Indore", "Madhya Pradesh"), ("Surat", "Gujarat"), ("Mysuru", "Karnataka")),
    "France": (("Dijon", ""), ("Angers", ""), ("Nîmes", ""), ("Rouen", ""), ("Grenoble", "")),
}
SIGHTS = {"US": ("near City Hall", "next to the post office"), "India": ("Opp Railway Station", "Near Clock Tower", "Behind City Hospital"), "France": ("près du marché", "face à l'église")}

# Shares of entities with 0 to 5 matches, and of records with each kind of noise.
MATCHES = (0.3, 0.3, 0.18, 0.12, 0.06, 0.04)
IN_SECOND = 0.55
LONG_FORM, NO_FORM, TURNED_NAME, NAME_ERROR, AMPERSAND, CAPITALS = 0.3, 0.15, 0.15, 0.25, 0.1, 0.08
SHORT_STREET, NO_TOWN, NO_REGION, NO_POSTCODE, SIGHT, NO_NUMBER, TURNED_ADDRESS, ADDRESS_ERROR = 0.5, 0.2, 0.4, 0.3, 0.3, 0.15, 0.2, 0.2
DELETED, INSERTED = 0.4, 0.4
HARD_NEGATIVE, OTHER_NEGATIVE = 0.5, 0.3

Chooser = Callable[[str, int], Column]


def chooser(seed: int, who: str, copy: Column) -> Chooser:
    """(what, n) -> a number below n for the entity of column id."""
    return lambda what, n: F.pmod(F.xxhash64("id", copy, F.lit(f"{who}/{what}/{seed}")), F.lit(n)).cast("int")


def chance(choose: Chooser, what: str, share: float) -> Column:
    return choose(what, 1_000_000) < F.lit(int(share * 1_000_000))


def one_of(table: dict[str, Sequence], countries: Sequence[str], choose: Chooser, what: str, part: int | None = None) -> Column:
    """An entry of the country's list, or one part of it."""
    out = F.lit("")
    for c in dict.fromkeys(countries):
        entries = [x if part is None else x[part] for x in table[c]]
        out = F.when(F.col("country") == c, F.element_at(F.array(*map(F.lit, entries)), choose(what, len(entries)) + 1)).otherwise(out)
    return out


def business(countries: Sequence[str], choose: Chooser) -> dict[str, Column]:
    """What is true of a business."""
    first = choose("stem", len(STEMS["US"]))
    stems = {c: F.array(*map(F.lit, STEMS[c])) for c in dict.fromkeys(countries)}

    def stem(at: Column) -> Column:
        out = F.lit("")
        for c, words in stems.items():
            out = F.when(F.col("country") == c, F.element_at(words, F.pmod(at, F.size(words)) + 1)).otherwise(out)
        return out

    digits = F.when(F.col("country") == "India", F.lit(100_000) + choose("postcode", 900_000)).otherwise(F.lit(10_000) + choose("postcode", 90_000))
    return {
        "stem": stem(first), "second": stem(first + 1 + choose("second", len(STEMS["US"]) - 1)), "kind": one_of(KINDS, countries, choose, "kind"),
        "form": one_of(FORMS, countries, choose, "form", 0), "long_form": one_of(FORMS, countries, choose, "form", 1), "number": (choose("number", 999) + 1).cast("string"),
        "street": one_of(STREETS, countries, choose, "street", 0), "short": one_of(STREETS, countries, choose, "street", 1), "long": one_of(STREETS, countries, choose, "street", 2),
        "town": one_of(TOWNS, countries, choose, "town", 0), "region": one_of(TOWNS, countries, choose, "town", 1), "postcode": digits.cast("string"),
        "sight": one_of(SIGHTS, countries, choose, "sight"),
    }


def mistyped(text: Column, choose: Chooser, what: str) -> Column:
    """A letter left out, put in or exchanged with the next, neither the first nor beyond the last; texts of under four characters stay."""
    n, roll = F.length(text), choose(f"{what} error kind", 1_000_000)
    at = F.lit(2) + F.pmod(choose(f"{what} error place", 1 << 30), F.greatest(n - 2, F.lit(1)))
    before, here = F.substring(text, F.lit(1), at - 1), F.substring(text, at, F.lit(1))
    letter = F.char(F.lit(97) + choose(f"{what} error letter", 26))
    deleted = F.concat(before, F.substring(text, at + 1, n))
    inserted = F.concat(before, letter, F.substring(text, at, n))
    swapped = F.concat(before, F.substring(text, at + 1, F.lit(1)), here, F.substring(text, at + 2, n))
    kinds = F.when(roll < int(DELETED * 1_000_000), deleted).when(roll < int((DELETED + INSERTED) * 1_000_000), inserted).otherwise(swapped)
    return F.when(n < 4, text).otherwise(kinds)


def written_out(rows: DataFrame, noise: Chooser | None) -> DataFrame:
    """Rows of business() columns with name and address, noisy if there is a chooser of noise. Each step is a projection of its own, so that what several expressions read is made once."""
    line = lambda kind: F.when(F.col("country") == "France", F.concat_ws(" ", kind, "street")).otherwise(F.concat_ws(" ", "street", kind))
    region = F.when(F.col("region") != "", F.col("region"))
    if noise is None:
        parts = F.array_compact(F.array(F.concat_ws(" ", F.col("number"), line(F.col("long"))), F.col("town"), region, F.col("postcode")))
        return rows.withColumns({"name": F.trim(F.concat_ws(" ", "stem", "second", "kind", "form")), "address": F.array_join(parts, ", ")})
    kept = lambda c, what, share: F.when(~chance(noise, what, share), c)
    roll = noise("form", 1_000_000)
    form = F.when(roll < int(LONG_FORM * 1_000_000), F.col("long_form")).when(roll < int((LONG_FORM + NO_FORM) * 1_000_000), F.lit("")).otherwise(F.col("form"))
    name = F.when(chance(noise, "turned name", TURNED_NAME), F.concat_ws(" ", "second", "stem", "kind")).otherwise(F.concat_ws(" ", "stem", "second", "kind"))
    kind = F.when(chance(noise, "street", SHORT_STREET), F.col("short")).otherwise(F.col("long"))
    parts = F.array(
        F.concat_ws(" ", kept(F.col("number"), "number", NO_NUMBER), line(kind)), F.when(chance(noise, "sight", SIGHT), F.col("sight")), kept(F.col("town"), "town", NO_TOWN),
        kept(region, "region", NO_REGION), kept(F.col("postcode"), "postcode", NO_POSTCODE),
    )
    rows = rows.withColumns({"form": form, "name": name, "parts": F.array_compact(parts)})
    turned = F.when(chance(noise, "turned address", TURNED_ADDRESS), F.concat(F.slice("parts", 2, 5), F.slice("parts", 1, 1))).otherwise(F.col("parts"))
    error = F.when(chance(noise, "name error", NAME_ERROR), mistyped(F.col("name"), noise, "name")).otherwise(F.col("name"))
    rows = rows.withColumns({"name": error, "address": F.array_join(turned, ", ")})
    rows = rows.withColumn("name", F.trim(F.concat_ws(" ", "name", "form")))
    rows = rows.withColumn("name", F.when(chance(noise, "ampersand", AMPERSAND), F.replace("name", F.lit(" and "), F.lit(" & "))).otherwise(F.col("name")))
    error = F.when(chance(noise, "address error", ADDRESS_ERROR), mistyped(F.col("address"), noise, "address")).otherwise(F.col("address"))
    return rows.withColumns({"name": F.when(chance(noise, "capitals", CAPITALS), F.upper("name")).otherwise(F.col("name")), "address": error})


def build(spark: SparkSession, split: str, n: int, countries: Sequence[str], seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(records, truth) of n source-1 entities: records with source 1 to 3, truth with one row an entity. Source 2 also has other businesses in the same street or of the same stem, source 3
    unrelated ones. An unknown country is a ValueError; n = 0 gives empty tables."""
    if unknown := sorted(set(countries) - set(STEMS)):
        raise ValueError(f"no words for {unknown}; there are {sorted(STEMS)}")
    letter, none = split[0].upper(), F.lit(0)
    first = chooser(seed, "entity", none)
    base = spark.range(n).withColumn("country", F.element_at(F.array(*map(F.lit, countries)), first("country", len(countries)) + 1))
    roll, count = first("matches", 1_000_000), F.lit(len(MATCHES) - 1)
    for k in reversed(range(len(MATCHES) - 1)):
        count = F.when(roll < round(sum(MATCHES[: k + 1]) * 1_000_000), k).otherwise(count)
    base = base.withColumn("k", count)
    real = business(countries, first)

    def id_of(source: Column, copy: Column) -> Column:
        return F.format_string(f"S%d-{letter}%06d", source, F.col("id") * 7 + copy)

    def rendered(rows: DataFrame, noise: Chooser | None, id_: Column, source: Column) -> DataFrame:
        named = zip(tables.COLUMNS, (id_, F.col("name"), F.col("address"), F.col("country")), strict=True)
        return written_out(rows, noise).select(*[c.alias(name) for name, c in named], source.cast("int").alias("source"))

    def source_of(copy: Column) -> Column:
        return F.when(F.pmod(F.xxhash64("id", copy, F.lit(f"source/{seed}")), F.lit(1_000_000)) < int(IN_SECOND * 1_000_000), 2).otherwise(3)

    copies = F.slice(F.sequence(F.lit(1), F.lit(len(MATCHES) - 1)), F.lit(1), F.col("k"))
    main_id = F.format_string(f"S1-{letter}%06d", "id")
    clean = base.withColumns(real)
    out = rendered(clean, None, main_id, F.lit(1))
    of_copy = source_of(F.col("copy"))
    out = out.unionByName(rendered(clean.withColumn("copy", F.explode(copies)), chooser(seed, "noise", F.col("copy")), id_of(of_copy, F.col("copy")), of_copy))
    other = business(countries, chooser(seed, "hard", none))
    both = base.where(chance(first, "hard", HARD_NEGATIVE)).withColumns(real).withColumns({f"other_{k}": c for k, c in other.items()}).withColumn("same_place", chance(first, "same place", 0.5))
    shared = ("street", "short", "long", "town", "region", "postcode")
    hard = {k: F.when(F.col("same_place") if k in shared else ~F.col("same_place"), F.col(k)).otherwise(F.col(f"other_{k}")) if k in (*shared, "stem") else F.col(f"other_{k}") for k in real}
    out = out.unionByName(rendered(both.withColumns(hard), chooser(seed, "hard noise", none), id_of(F.lit(2), F.lit(6)), F.lit(2)))
    free = base.where(chance(first, "free", OTHER_NEGATIVE)).withColumns(business(countries, chooser(seed, "free", none)))
    out = out.unionByName(rendered(free, chooser(seed, "free noise", none), id_of(F.lit(3), F.lit(6)), F.lit(3)))
    truth = base.select(main_id.alias("source1_entity_id"), F.array_join(F.transform(copies, lambda c: id_of(source_of(c), c)), ",").alias("matched_entity_ids"))
    return out, truth


def write_split(spark: SparkSession, folder: str, split: str, n: int, countries: Sequence[str], seed: int = 7) -> None:
    """The files that load_split() reads. The truth of a split other than train is a hidden one."""
    records, truth = build(spark, split, n, countries, seed)
    for source in (1, 2, 3):
        sinks.write_tsv(records.where(F.col("source") == source).drop("source"), f"{folder}/{split}_source{source}.tsv")
    sinks.write_tsv(truth, f"{folder}/train_ground_truth.tsv" if split == "train" else f"{folder}/_hidden_{split}_ground_truth.tsv")


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--out", default="dataset")
    parser.add_argument("--n-train", type=int, default=3000)
    parser.add_argument("--n-test", type=int, default=2000)
    parser.add_argument("--seed", type=int, default=7)
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName("recordloom").getOrCreate()
    write_split(spark, given.out, "train", given.n_train, ("US", "India"), given.seed)
    write_split(spark, given.out, "test", given.n_test, ("US", "India", "France"), given.seed + 1)


if __name__ == "__main__":
    main()
