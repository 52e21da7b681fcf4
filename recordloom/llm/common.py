"""What several operators share: written tables, words, identities of rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern [^\x20\x09-\x0D]+; bytes.split() divides at the same six bytes.
SPACES = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; a local one only where it is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='recordloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/recordloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: lineage ends there, and a lost executor loses nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def release(df: DataFrame) -> None:
    """Deletes a table that stored() wrote, once nothing will read it again."""
    path = getattr(df, "_stored_path", None)
    if path:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def n_words(text: Column | str) -> Column:
    """Number of words of a text, 0 for null; JVM only. A word starts where a non-space follows a space or the start."""
    text = F.col(text) if isinstance(text, str) else text
    plain = F.trim(F.translate(text, SPACES[1:], " " * 5))
    return F.when(F.coalesce(F.length(plain), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(F.split(plain, " +"))).cast("long")
