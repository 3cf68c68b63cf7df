"""Passes over time series in order, without a hot key in one task.

A window over one post's series needs all of it in one task.  Here the rows are
first written in range order of (key, time, ...), so a long series lies in
several consecutive parts.  Each part is passed over on its own; what a part's
first key had before comes from the ends of the parts before it, one row per
part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path

_PART = "_part"


def range_parts(df: DataFrame, key: str, order: list[str] | list[Column], parts: int | None = None) -> DataFrame:
    """``df`` in range order of (``key``, ``order``) with the number of its range
    in ``_part``; rows without a key are dropped.  Written once to the shared
    folder, so every later pass sees the same ranges."""
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = (df.where(F.col(key).isNotNull()).repartitionByRange(n, key, *order)
             .withColumn(_PART, F.spark_partition_id()))
    path = shared_path(spark, "ordered", uuid.uuid4().hex)
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def _ends(ranged: DataFrame, key: str, agg: Column) -> DataFrame:
    """(part, key, ``_end``) of the keys that some part begins with: no other
    key lies in two parts, so at most two rows per part are left."""
    first = ranged.groupBy(_PART).agg(F.min(key).alias(key)).select(key).distinct()
    return (ranged.join(F.broadcast(first), key, "left_semi")
                  .groupBy(_PART, key).agg(agg.alias("_end")))


def _earlier(key: str):
    return Window.partitionBy(key).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)


def summed(ranged: DataFrame, key: str, order: list[str] | list[Column], weight: Column, name: str) -> DataFrame:
    """``ranged`` with ``name``: the sum of ``weight`` over the rows of the same
    key before this one in ``order`` (which is total), counted within the part
    and on from the parts before; without ``_part``."""
    within = Window.partitionBy(_PART, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ends = _ends(ranged, key, F.sum(weight))
    ends = ends.select(_PART, key, F.sum("_end").over(_earlier(key)).alias("_before"))
    inside = ranged.withColumn(name, F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return (inside.join(F.broadcast(ends), [_PART, key], "left")
                  .withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop("_before", _PART))


def numbered(ranged: DataFrame, key: str, order: list[str] | list[Column], name: str) -> DataFrame:
    """``ranged`` with ``name``: the 1-based place of the row within its key in
    ``order`` (see :func:`summed`)."""
    one = F.lit(1).cast("bigint")
    return summed(ranged, key, order, one, name).withColumn(name, F.col(name) + one)


def carried(ranged: DataFrame, key: str, order: list[str], value: Column, name: str,
            inclusive: bool) -> DataFrame:
    """``ranged`` (of :func:`range_parts`) with ``name``: the newest non-null
    ``value`` of the same key up to this row in ``order`` (``inclusive``), or
    before it; null if there is none."""
    rows = ranged.withColumn("_value", value)
    within = Window.partitionBy(_PART, key).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    rows = rows.withColumn(name, F.last("_value", ignorenulls=True).over(within))
    at = F.when(F.col("_value").isNotNull(), F.struct(*order))
    ends = _ends(ranged.withColumn("_value", value), key, F.max_by("_value", at))
    ends = ends.select(_PART, key, F.last("_end", ignorenulls=True).over(_earlier(key)).alias("_before"))
    ends = F.broadcast(ends.where(F.col("_before").isNotNull()))
    return (rows.join(ends, [_PART, key], "left")
                .withColumn(name, F.coalesce(name, "_before")).drop("_before", "_value"))
