"""Readers for the stored relations.

Tables are plain Parquet.  Reads go through ``spark.read.parquet`` and leave
column pruning and filter pushdown to Catalyst: callers select what they use
and the scan's ReadSchema shrinks to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal: independent of the session time zone."""
    return F.lit(text).cast("timestamp_ntz")


def read_relation(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A1: a stored relation read with its fixed schema (``schemas.STORED``),
    never inferred; callers select the columns they use."""
    from ..schemas import STORED
    return spark.read.schema(STORED[name]).parquet(path)
