"""URL filters through time. A filter list is a log of dated entries (list_name, kind, pattern, action, since); the log becomes validity intervals, one entry
standing until the next entry of the same list and pattern; every capture meets the entries that were active when it was fetched.

A capture's keys are its host and the host's parent domains, and its path's leading parts under its host; their number depends on the URL alone, and
equal keys make the join, so no capture meets entries of other hosts. Of the active entries that match, the longest key decides, and among those of one key
a blocking one, then the list's name.

Defined cases: a url that is null or has no host, and a capture without a date, match nothing (verdict "none"); entries of the same list, pattern and date stand in
the order of action, so that "remove" wins over "block" and "allow"; repeated entries count once; repeated captures give repeated rows; an empty list
or table gives "none" or no rows; further columns of the captures are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def intervals(entries: DataFrame) -> DataFrame:
    """list_name, key, action, valid_from, valid_to (open: null) from the log; only entries that block or allow. Hosts are lower-case in keys, paths stay as they are."""
    host = F.substring_index("pattern", "/", 1)
    prefix = F.concat(F.lower(host), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)"))
    key = F.when(F.col("kind") == "domain", F.lower("pattern")).otherwise(F.regexp_replace(prefix, "/+$", ""))
    log = entries.select("list_name", key.alias("key"), "action", F.col("since").cast("date").alias("valid_from")).where("key is not null and valid_from is not null").distinct()
    log = log.groupBy("list_name", "key", "valid_from").agg(F.max("action").alias("action"))  # "remove" > "block" > "allow"
    after = F.lead("valid_from").over(W.partitionBy("list_name", "key").orderBy("valid_from"))
    return log.withColumn("valid_to", after).where("action in ('block', 'allow')")


def keys_of(captures: DataFrame) -> DataFrame:
    """A row for each distinct (url, day) and key."""
    seen = captures.select("url", "day").where("url is not null and day is not null").distinct()
    host = F.lower(F.regexp_extract("url", HOST, 1))
    path = F.regexp_replace(F.regexp_extract("url", PATH, 1), "/+$", "")
    rows = seen.select("url", "day", host.alias("host"), path.alias("path")).where("host <> ''")
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda i: F.concat(F.col("host"), F.array_join(F.slice(parts, 1, i), "/")))
    both = F.array_distinct(F.concat(domains, F.when(F.size(parts) > 1, prefixes).otherwise(F.array().cast("array<string>"))))
    return rows.select("url", "day", F.explode(both).alias("key"))


def verdicts(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, day, verdict, list_name, entry, valid_from for every capture (page_id, url, day)."""
    rows = captures.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("day").cast("date").alias("day"))
    at = intervals(entries)
    active = (F.col("day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    hits = keys_of(rows).join(at, "key").where(active)
    first = F.min(F.struct((-F.length("key")).alias("n"), (F.col("action") == "allow").alias("a"), "list_name", "key", "valid_from")).alias("o")
    found = hits.groupBy("url", "day").agg(first).select(
        F.col("url").alias("u"), F.col("day").alias("d"), F.when(F.col("o.a"), "allow").otherwise("block").alias("verdict"), "o.list_name", F.col("o.key").alias("entry"), "o.valid_from"
    )
    out = rows.join(found, (F.col("url") == F.col("u")) & (F.col("day") == F.col("d")), "left")
    return out.select("page_id", "url", "day", F.coalesce("verdict", F.lit("none")).alias("verdict"), "list_name", "entry", "valid_from")
