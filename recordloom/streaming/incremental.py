"""Records that arrive as a stream, matched against stored source-1 records. Weights are those of the stored index; each micro-batch is a small target side, so its
candidates come from the same operators as a batch run's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocking, normalise


def batch_candidates(arrived: DataFrame, index: DataFrame, cap: int = 100) -> DataFrame:
    """q, t of arrived records (the columns of as_records) that share an exact key with index, weighted canonical records of source 1. New tokens, which the index has no weight for, count as rarest."""
    known = index.select("country_n", F.explode(F.map_entries("w")).alias("e")).select("country_n", "e.*").groupBy("country_n", "key").agg(F.first("value").alias("value"))
    canon = normalise.canonical(arrived)
    tokens = canon.select("entity_id", "country_n", F.explode(F.array_distinct(F.concat("core"))).alias("key"))
    top = known.groupBy("country_n").agg(F.max("value").alias("most"))
    w = tokens.join(known, ["country_n", "key"], "left").join(top, "country_n", "left").select("entity_id", "key", F.coalesce("value", F.col("most") + 1, F.lit(1.0)).alias("value"))
    maps = w.groupBy("entity_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("w"))
    weighted = canon.join(maps, "entity_id", "left").withColumn("w", F.coalesce("w", F.create_map().cast("map<string,double>")))
    both = index.select(*[c for c in weighted.columns]).unionByName(weighted)
    return blocking.key_pairs(blocking.record_keys(both), blocking.blocks(both), cap)


def matching(stream: DataFrame, index: DataFrame, path: str, checkpoint: str, cap: int = 100) -> StreamingQuery:
    """Candidates of every micro-batch, written under path by batch number, so that a repeated batch replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        batch_candidates(batch, index, cap).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
