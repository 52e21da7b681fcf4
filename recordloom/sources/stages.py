"""Stored stages: a DataFrame is written once for a key made of all that it depends on, and read from there after that."""

from __future__ import annotations

import hashlib
import json
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import exists


def work_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; a local one only where it is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='recordloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/recordloom/{spark.sparkContext.applicationId}"


def stage_key(name: str, **parts: object) -> str:
    return f"{name}-{hashlib.md5(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]}"


def stage(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame], **parts: object) -> DataFrame:
    """The stage's rows; Spark's _SUCCESS marks a whole one, so a broken write is made again. Every setting that make() uses belongs into parts."""
    path = f"{folder}/{stage_key(name, **parts)}"
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
