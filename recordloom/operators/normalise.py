"""Records into canonical columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def canonical(records: DataFrame, table: dict[str, str] | None = None, coder: str = "skeleton") -> DataFrame:
    """entity_id, source, country_n, raw_name, raw_addr, name_n, addr_n, full_n; token lists core, phon, codes, nums; texts core_text, suffix, acr, nospace,
    first_tok, phon_first, addr_core, landmark. Abbreviations are written out before anything else looks at the tokens."""
    rows = records.select(
        F.trim("entity_id").alias("entity_id"), "source", F.coalesce("business_name", F.lit("")).alias("raw_name"), F.coalesce("business_address", F.lit("")).alias("raw_addr"),
        T.norm_text(F.col("business_name")).alias("name_0"), T.norm_text(F.col("business_address")).alias("addr_0"), T.norm_text(F.col("country")).alias("country_0"),
    )
    rows = rows.select(
        "entity_id", "source", "raw_name", "raw_addr", F.when(F.col("country_0") == "", "unknown").otherwise(F.col("country_0")).alias("country_n"),
        T.expanded(F.col("name_0"), table).alias("name_n"), T.expanded(F.col("addr_0"), table).alias("addr_n"),
    )
    rows = rows.withColumns({"tokens": T.words(F.col("name_n")), "at": T.landmark_at(F.col("addr_n")), "full_n": F.trim(F.concat_ws(" ", "name_n", "addr_n"))})
    rows = rows.withColumn("core", T.core_tokens(F.col("tokens")))
    core = F.col("core")
    rows = rows.withColumns({
        "core_text": T.joined(core), "suffix": T.suffix_text(F.col("tokens")), "acr": T.acronym(core), "nospace": T.joined(core, ""), "first_tok": T.first_of(core),
        "phon": T.phonetic_tokens(core, coder), "addr_core": T.without_landmark(F.col("addr_n"), F.col("at")), "landmark": T.landmark(F.col("addr_n"), F.col("at")),
        "codes": T.codes(F.col("addr_n")), "nums": T.numbers(F.col("addr_n")),
    })
    return rows.withColumn("phon_first", T.first_of(F.col("phon"))).drop("tokens", "at")


def mined_abbreviations(records: DataFrame, pairs: DataFrame, min_count: int = 5, similar: bool = True) -> DataFrame:
    """short, long, n: rewrites that matched pairs (s1_id, t_id) teach: where at most two tokens differ on either side, one a beginning of the other, or alike. The most
    frequent long form wins, then the alphabet."""
    from ..functions.strings import jaro_winkler_similarity

    texts = records.select("entity_id", F.array_distinct(T.words(T.norm_text(F.concat_ws(" ", "business_name", "business_address")))).alias("t"))
    both = pairs.join(texts.select(F.col("entity_id").alias("s1_id"), F.col("t").alias("ta")), "s1_id").join(texts.select(F.col("entity_id").alias("t_id"), F.col("t").alias("tb")), "t_id")
    both = both.select(F.array_except("ta", "tb").alias("da"), F.array_except("tb", "ta").alias("db")).where("size(da) between 1 and 2 and size(db) between 1 and 2")
    each = both.select(F.explode("da").alias("x"), "db").select("x", F.explode("db").alias("y")).where(~T.is_number(F.col("x")) & ~T.is_number(F.col("y")))
    shorter = F.length("x") < F.length("y")
    each = each.select(F.when(shorter, F.col("x")).otherwise(F.col("y")).alias("short"), F.when(shorter, F.col("y")).otherwise(F.col("x")).alias("long"))
    each = each.where("length(short) between 2 and 5 and length(long) > length(short)")
    counted = each.groupBy("short", "long").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    fits = F.col("long").startswith(F.col("short"))
    if similar:
        fits = fits | (jaro_winkler_similarity(F.col("short"), F.col("long")) > 0.85)
    order = W.partitionBy("short").orderBy(F.desc("n"), "long")
    return counted.where(fits).withColumn("r", F.row_number().over(order)).where("r = 1").select("short", "long", "n")
