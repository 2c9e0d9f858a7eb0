"""Intermediate tables and files in the folder that all executors share (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.plans.stable import shared_dir


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: cut lineage, known size, no row counted twice after a lost executor."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_id(docs: DataFrame, id_col: str, out: str) -> Column:
    """The id in column ``out`` (a text in the workers: pandas has no null among integers) as the type it has in ``docs``."""
    return F.col(out).cast(docs.schema[id_col].dataType)


def mounted(folder: str) -> str:
    """The path under which workers can open files of the shared folder."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{folder}: workers map files into memory, so spark.checkpoint.dir must be a mounted folder (file:)")
    return url.path


def put(path: str, data: bytes) -> None:
    """Write a file at once: attempts of the same task replace each other's equal content."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    temp = f"{path}.{uuid.uuid4().hex}"
    with open(temp, "wb") as f:
        f.write(data)
    os.replace(temp, path)
