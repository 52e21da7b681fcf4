"""Record tables: tab-separated files, ground truth, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import number_of

COLUMNS = ("entity_id", "business_name", "business_address", "country")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, header names stripped, empty fields empty strings and never null."""
    raw = spark.read.csv(path, sep="\t", header=True, escape='"', inferSchema=False)
    return raw.toDF(*[c.strip() for c in raw.columns]).na.fill("")


def as_records(df: DataFrame, source: int) -> DataFrame:
    """The four expected columns, empty where absent, and the number of the source."""
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in COLUMNS]
    return df.select(F.trim(named[0]).alias(COLUMNS[0]), *[x.alias(c) for x, c in zip(named[1:], COLUMNS[1:], strict=True)], F.lit(source).alias("source"))


def id_list(c: Column) -> Column:
    """Ids of a comma-joined list, blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def truth_pairs(truth: DataFrame) -> DataFrame:
    """s1_id, t_id: one row a matched pair."""
    return truth.select(F.trim("source1_entity_id").alias("s1_id"), F.explode(F.array_distinct(id_list(F.col("matched_entity_ids")))).alias("t_id")).distinct()


def truth_sizes(truth: DataFrame) -> DataFrame:
    """s1_id, n: matches of every entity, 0 included."""
    return truth.groupBy(F.trim("source1_entity_id").alias("s1_id")).agg(F.size(F.array_distinct(F.flatten(F.collect_list(id_list(F.col("matched_entity_ids")))))).alias("n"))


def load_split(spark: SparkSession, folder: str, split: str, sample: float = 1.0, seed: int = 42) -> tuple[DataFrame, DataFrame | None]:
    """Records of the three sources, and the ground truth or the hidden one if there is any."""
    records = as_records(read_tsv(spark, f"{folder}/{split}_source1.tsv"), 1)
    for n in (2, 3):
        records = records.unionByName(as_records(read_tsv(spark, f"{folder}/{split}_source{n}.tsv"), n))
    truth = None
    for name in (f"{split}_ground_truth.tsv", f"_hidden_{split}_ground_truth.tsv"):
        if exists(spark, f"{folder}/{name}"):
            truth = read_tsv(spark, f"{folder}/{name}")
            break
    if sample < 1.0:
        records, truth = sampled(records, truth, sample, seed)
    return records, truth


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def chosen(id_: Column, fraction: float, seed: int) -> Column:
    """Whether an id belongs to a sample; a matter of the id alone, so partitions don't matter."""
    return F.pmod(number_of(F.concat_ws(":", id_, F.lit(str(seed)))), F.lit(1_000_000)) < int(fraction * 1_000_000)


def sampled(records: DataFrame, truth: DataFrame | None, fraction: float, seed: int) -> tuple[DataFrame, DataFrame | None]:
    """A fraction of source 1, all records matched with it, and the same fraction of the others."""
    s1 = records.where((F.col("source") == 1) & chosen(F.col("entity_id"), fraction, seed))
    others = records.where("source > 1")
    if truth is None:
        return s1.unionByName(others.where(chosen(F.col("entity_id"), fraction, seed))), None
    truth = truth.join(s1.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    matched = truth_pairs(truth).select(F.col("t_id").alias("entity_id")).distinct().withColumn("matched", F.lit(True))
    kept = others.join(matched, "entity_id", "left").where(F.col("matched").isNotNull() | chosen(F.col("entity_id"), fraction, seed)).drop("matched")
    return s1.unionByName(kept.select(*records.columns)), truth


def split_files(spark: SparkSession, folder: str, split: str) -> list[tuple[str, int, int]]:
    """Fingerprints of all files that a split's results depend on, its ground truth and vectors included."""
    names = [*(f"{split}_source{i}.tsv" for i in (1, 2, 3)), f"{split}_ground_truth.tsv", f"_hidden_{split}_ground_truth.tsv", f"{split}_vectors.parquet"]
    return fingerprint(spark, [f"{folder}/{n}" for n in names])


def vectors(spark: SparkSession, folder: str, split: str) -> DataFrame | None:
    """entity_id, v of a split's records, where there is such a table."""
    path = f"{folder}/{split}_vectors.parquet"
    return spark.read.parquet(path).select("entity_id", "v") if exists(spark, path) else None


def fingerprint(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Name, length and time of each file, for keys of stored stages."""
    out = []
    for p in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(where):
            s = files.getFileStatus(where)
            out.append((s.getPath().getName(), s.getLen(), s.getModificationTime()))
    return out
