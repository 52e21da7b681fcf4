"""Sharding through fixed virtual slots: a record's hash picks one of thousands of slots, bytes are added up by slot, and a small versioned table maps
slots to shards. Rebalancing edits that table; the hash, and so a record's slot, never changes.

Defined cases: a null text has 0 bytes and counts 1; a null id is hashed like a value; equal rows share a slot, and take places beside each other in
it; an empty table gives no places and a map that is dealt in turn; further columns of the input are ignored by place() and kept by route().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import new_folder, stored

N_SLOTS = 4096
CHUNK = 4096
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def virtual_slot(*keys: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_slots)).cast("int")


def slot_bytes(spark: SparkSession, rows: DataFrame) -> dict[int, int]:
    """Bytes by slot; at most as many entries as there are slots, whatever the input."""
    return {r[0]: r[1] for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def dealt(n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    """The first version of a map, made before any size is known: slots in turn. Index: slot, value: shard."""
    return [slot % n_shards for slot in range(n_slots)]


def rebalanced(slots: list[int], sizes: dict[int, int], n_shards: int, tolerance: float = 0.002) -> list[int]:
    """The map edited for n_shards (more than before, or as many): slots leave the fullest shard for the emptiest while that narrows the gap, largest
    fitting slot first. All else stays where it is."""
    out = list(slots)
    load = [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, shard in enumerate(out):
        load[shard] += sizes.get(slot, 0)
        held[shard].append((sizes.get(slot, 0), slot))
    for x in held:
        x.sort()
    mean = sum(load) / n_shards
    for _ in range(len(out)):
        a, b = max(range(n_shards), key=lambda s: (load[s], -s)), min(range(n_shards), key=lambda s: (load[s], s))
        room = min(load[a] - mean, mean - load[b]) if load[b] < mean else 0
        if load[a] - load[b] <= tolerance * mean:
            break
        fits = [x for x in held[a] if 0 < x[0] <= max(room, (load[a] - load[b]) / 2)]
        if not fits:
            break
        size, slot = fits[-1]
        held[a].remove((size, slot))
        held[b].append((size, slot))
        load[a] -= size
        load[b] += size
        out[slot] = b
    return out


def map_table(spark: SparkSession, versions: dict[int, list[int]]) -> DataFrame:
    """The stored form: a row for each version and slot."""
    return spark.createDataFrame([(v, slot, shard) for v, m in sorted(versions.items()) for slot, shard in enumerate(m)], MAP_SCHEMA)


def write_version(spark: SparkSession, folder: str, version: int, slots: list[int]) -> None:
    """A version of the map, added to those in the folder as one file. Versions are never changed once written."""
    map_table(spark, {version: slots}).coalesce(1).write.mode("append").parquet(folder)


def read_versions(spark: SparkSession, folder: str) -> DataFrame | None:
    """All versions in a folder, or None where none was written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema(MAP_SCHEMA).parquet(folder)


def latest(table: DataFrame) -> tuple[int, list[int]]:
    """Number and slots of the newest version; a map has as many rows as there are slots."""
    top = table.agg(F.max("version")).first()[0]
    return top, [r[0] for r in table.where(F.col("version") == top).orderBy("virtual_slot").select("shard").collect()]


def route(rows: DataFrame, table: DataFrame, version: int, slot: Column, name: str = "assigned_shard") -> DataFrame:
    """rows with the shard that a version of the map gives to their slot; the map has as many rows as there are slots, so it is broadcast."""
    at = table.where(F.col("version") == version).select(F.col("virtual_slot").alias("at"), F.col("shard").alias("to"))
    held = rows.select(F.struct(*[f"`{c}`" for c in rows.columns]).alias("row"), slot.alias("slot"))
    return held.join(F.broadcast(at), F.col("slot") == F.col("at")).select("row.*", F.col("to").alias(name))


def place(docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS, folder: str | None = None) -> DataFrame:
    """Every document's size, checksum, shard and place, by the newest version of the map in folder. Bytes are added up by slot, the version found there (or the first, dealt in
    turn) is edited to even them out, the edit is stored as the next version, and rows take their shards from the stored one. So a later call on more rows moves only
    the slots that its edit moves.

    The text is read once; only ids, sizes and checksums move. The hash takes the checksum beside the id, so that rows without an id, or many rows of one id,
    spread out; equal rows, which share a slot, are one row with a count until they take their places. Places are numbered within a virtual slot, and start after
    those of the shard's earlier slots, so that no task numbers a whole shard."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "slot_map")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("m"))
    rows = stored(rows.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), n_slots=n_slots)), "sizes")
    counted = {r[0]: (r[1], r[2]) for r in rows.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("m")), F.sum("m")).collect()}  # at most n_slots rows
    found = read_versions(spark, folder)
    if found is None:
        write_version(spark, folder, 0, dealt(n_shards, n_slots))
        found = read_versions(spark, folder)
    version, slots = latest(found)
    edited = rebalanced(slots, {k: v[0] for k, v in counted.items()}, n_shards)
    write_version(spark, folder, version + 1, edited)
    table = read_versions(spark, folder)
    starts, after = [], [0] * n_shards
    for slot, shard in enumerate(edited):
        starts.append((slot, after[shard]))
        after[shard] += counted.get(slot, (0, 0))[1]
    at = spark.createDataFrame(starts, "virtual_slot int, start long")
    by_slot = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("m").over(by_slot), F.lit(0))).join(F.broadcast(at), "virtual_slot")
    rows = route(rows, table, version + 1, F.col("virtual_slot"), "shard").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / CHUNK))))
    nth = F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("m"), (F.col("chunk") + 1) * CHUNK) - 1)).alias("nth")
    rows = rows.select("doc_id", "size", "text_crc32", "shard", "start", "before", "virtual_slot", nth)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("before") + F.col("nth")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
        F.lit(version + 1).alias("map_version"),
    )
