"""Results as files: id lists, pairs, metrics, and a check of what was written."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def id_lists(s1: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """source1_entity_id and its sorted distinct ids, comma-joined, empty if none; a row for each record of s1 (q)."""
    lists = pairs.groupBy("q").agg(F.array_join(F.array_sort(F.collect_set("t")), ",").alias(column))
    return s1.select("q").join(lists, "q", "left").select(F.col("q").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True, escape='"', emptyValue="")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file through Spark's file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_metrics(spark: SparkSession, path: str, metrics: dict) -> None:
    write_text(spark, path, json.dumps(metrics, indent=2, sort_keys=True, default=str))


def faults(s1: DataFrame, targets: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """fault, n of the answer: rows that aren't one a record, unknown ids, matches that no candidate list has. All 0 is valid."""
    lists = lambda df, c: df.select(F.col("source1_entity_id").alias("q"), F.explode(F.split(c, ",")).alias("t")).where("t <> ''")
    c, m = lists(candidates, "candidate_entity_ids"), lists(matches, "matched_entity_ids")
    ids, known = s1.select("q"), targets.select("t")

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("fault"), F.count(F.lit(1)).alias("n"))

    return (
        count(ids.join(matches.select(F.col("source1_entity_id").alias("q")), "q", "left_anti"), "missing row")
        .unionByName(count(matches.groupBy("source1_entity_id").count().where("count > 1"), "repeated row"))
        .unionByName(count(matches.select(F.col("source1_entity_id").alias("q")).join(ids, "q", "left_anti"), "unknown record"))
        .unionByName(count(m.join(known, "t", "left_anti"), "unknown target"))
        .unionByName(count(m.join(c, ["q", "t"], "left_anti"), "match without candidate"))
    )
