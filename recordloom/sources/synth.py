"""Deterministic business records rendered from the keys of customer and supplier. The rendering is plain SQL arithmetic on the whole tables, and
sql() writes it for Spark or for another engine, so that both start from the same rows.

Source 1 has a clean record for each customer. Source 2 has a noisy one for each: abbreviated, without its legal form, with a typing error, in capitals, with accents, its
address turned round or missing; three in ten are another business of the same street and trade. Source 3 has one for each supplier; two in three
are the customer of the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.postings import MERGE

# The words that records are made of.
SYLLABLES = ("ba", "do", "ki", "lu", "me", "no", "pa", "ri", "so", "tu", "va", "we", "zi", "cha", "fe", "go", "hu", "ja", "lo", "mi")
NOUNS = ("Textile", "Bakery", "Motor", "Garden", "Silver", "River", "Stone", "Paper", "Coffee", "Timber", "Marine", "Crystal", "Harvest", "Copper", "Velvet")
TRADES = ("Traders", "Works", "Supply", "Services", "Industries", "Market", "Foods", "Partners", "Tools", "House")
FORMS = (" Ltd", " Inc.", " & Sons", " S.A.R.L.", "")
STREETS = ("Mill", "Church", "Station", "Park", "King", "Bridge", "Lake", "North")
CITIES = ("Avonlea", "Brookfield", "Carlow", "Dunmore", "Eastwick", "Fairview", "Glenrock", "Hillcrest", "Ironton", "Kenmare")
SIGHTS = ("near City Mall", "opp. Town Hall", "behind Old Fort", "next to Post Office")


def _pick(words: tuple[str, ...], index: str, spark: bool) -> str:
    items = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"element_at(array({items}), cast({index} as int) + 1)" if spark else f"([{items}])[CAST({index} AS INT) + 1]"


def sql(spark: bool) -> str:
    """Columns entity_id, business_name, business_address, country, source, and true_id, the customer that a record is of (null for others)."""

    def div(a: str, n: int) -> str:
        return f"cast(floor({a} / {n}) as bigint)"

    def word(k: str) -> str:
        parts = [_pick(SYLLABLES, f"{x} % {len(SYLLABLES)}", spark) for x in (f"({k} * 7 + 3)", div(k, 20), div(k, 400), div(k, 8000))]
        return f"concat({', '.join(parts)})"

    def cap(x: str) -> str:
        return f"concat(upper(substring({x}, 1, 1)), substring({x}, 2))"

    def trade(k: str) -> str:
        return f"concat({_pick(NOUNS, f'({k} * 11 + 5) % {len(NOUNS)}', spark)}, ' ', {_pick(TRADES, f'({k} * 3 + {div(k, 150)}) % {len(TRADES)}', spark)})"

    def form(k: str) -> str:
        return _pick(FORMS, f"{k} % {len(FORMS)}", spark)

    def street(k: str, kind: str) -> str:
        return f"concat(cast(1 + {k} * 13 % 900 as {'string' if spark else 'varchar'}), ' ', {_pick(STREETS, f'{k} % {len(STREETS)}', spark)}, {kind})"

    def town(k: str) -> str:
        text = "string" if spark else "varchar"
        return f"concat({_pick(CITIES, f'{div(k, 3)} % {len(CITIES)}', spark)}, ' ', cast(10000 + {k} * 37 % 89999 as {text}))"

    def sight(k: str) -> str:
        return f"case when {k} % 6 = 0 then concat(' ', {_pick(SIGHTS, f'{div(k, 6)} % {len(SIGHTS)}', spark)}) else '' end"

    def name(k: str) -> str:
        return f"concat({cap(word(k))}, ' ', {trade(k)}, {form(k)})"

    def address(k: str) -> str:
        long, short = "' Street'", "' St.'"
        return f"concat({street(k, long)}, {sight(k)}, ', ', {town(k)})"

    k, o = "k", "(k + 100003)"
    abbreviation = "' St.'"
    noisy_name = f"""case k % 10
      when 0 then replace(replace(concat({cap(word(k))}, ' ', {trade(k)}, {form(k)}), 'Services', 'Svcs'), 'Industries', 'Ind')
      when 1 then concat({cap(word(k))}, ' ', {trade(k)})
      when 2 then concat(substring({cap(word(k))}, 1, 2), substring({cap(word(k))}, 4), ' ', {trade(k)}, {form(k)})
      when 3 then upper({name(k)})
      when 4 then replace(replace({name(k)}, 'e', 'é'), 'o', 'ö')
      when 5 then {name(k)}
      when 6 then concat({trade(k)}, ' ', {cap(word(k))}, {form(k)})
      else concat({cap(word(o))}, ' ', {trade(k)}, {form(o)}) end"""
    noisy_address = f"""case k % 10
      when 0 then concat({street(k, abbreviation)}, {sight(k)}, ', ', {town(k)})
      when 5 then concat({town(k)}, ', ', {street(k, abbreviation)})
      when 6 then ''
      when 7 then concat({street(o, abbreviation)}, ', ', {town(k)})
      when 8 then concat({street(k, abbreviation)}, ', ', {town(o)})
      when 9 then concat({street(o, abbreviation)}, ', ', {town(o)})
      else {address(k)} end"""
    text = "string" if spark else "varchar"
    return f"""
      select concat('S1-', cast(k as {text})) as entity_id, {name(k)} as business_name, {address(k)} as business_address, country, 1 as source, k as true_id from base
      union all
      select concat('S2-', cast(k as {text})), {noisy_name}, {noisy_address}, country, 2, case when k % 10 < 7 then k end from base
      union all
      select concat('S3-', cast(k as {text})), case when k % 3 < 2 then concat({cap(word(k))}, ' & Co ', {trade(k)}) else concat({cap(word(o))}, ' ', {trade(o)}) end,
        case when k % 3 = 0 then {address(k)} else {street(k, abbreviation)} end, country, 3, case when k % 3 < 2 then k end
      from (select s_suppkey as k, n_name as country from supplier join customer on c_custkey = s_suppkey join nation on n_nationkey = c_nationkey) s"""


BASE = "select c_custkey as k, n_name as country from customer join nation on n_nationkey = c_nationkey"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a folder of tables, with true_id."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "supplier", "nation")}
    tables["supplier"] = tables["supplier"].hint(MERGE)  # suppliers meet customers, and both grow
    text = f"with base as ({BASE}) {sql(True)}"
    for t in tables:
        text = text.replace(f" {t} ", f" {{{t}}} ").replace(f"from {t}", f"from {{{t}}}")
    return spark.sql(text, **tables)


def truth(records_: DataFrame) -> DataFrame:
    """s1_id, t_id: every pair of a source-1 record and another of the same business."""
    s1 = records_.where("source = 1").select(F_id("s1_id"), "true_id")
    others = records_.where("source > 1 and true_id is not null").select(F_id("t_id"), "true_id")
    return s1.join(others.hint(MERGE), "true_id").select("s1_id", "t_id")


def F_id(name: str):
    from pyspark.sql import functions as F

    return F.col("entity_id").alias(name)
