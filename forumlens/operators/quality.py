"""Declared constraints as quality queries.

Spark enforces no keys, so each constraint of the stored schema becomes a
query: duplicate keys, orphans, nulls in NOT NULL columns, and the
UNIQUE(provider, query, url) de-duplication of news items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import STORED


def primary_key_violations(tables: dict[str, tuple[DataFrame, str | tuple[str, ...]]]) -> DataFrame:
    """``(relation, key_value, n)`` for every key held by more than one row;
    the parts of a composite key are joined by ``|``."""
    parts = []
    for name, (df, key) in tables.items():
        cols = [key] if isinstance(key, str) else list(key)
        value = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
        parts.append(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                       .select(F.lit(name).alias("relation"), value.alias("key_value"), "n"))
    return reduce(DataFrame.unionByName, parts)


def foreign_key_orphans(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """``(relation, orphans)``: child rows whose non-null reference has no
    parent row (anti join)."""
    parts = []
    for name, child, fk, parent, pk in checks:
        c = child.select(F.col(fk).alias("_k")).where(F.col("_k").isNotNull())
        p = parent.select(F.col(pk).alias("_k"))
        parts.append(c.join(p, "_k", "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
                      .select(F.lit(name).alias("relation"), "orphans"))
    return reduce(DataFrame.unionByName, parts)


def not_null_counts(checks: list[tuple[str, DataFrame, tuple[str, ...]]]) -> DataFrame:
    """``(relation, column_name, nulls)``, one pass per relation."""
    parts = []
    for name, df, cols in checks:
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
        stack = "stack({n}, {pairs}) as (column_name, nulls)".format(
            n=len(cols), pairs=", ".join(f"'{c}', `{c}`" for c in cols))
        parts.append(counts.selectExpr(f"'{name}' as relation", stack))
    return reduce(DataFrame.unionByName, parts)


def not_null_columns(relation: str) -> tuple[str, ...]:
    """Columns that a stored relation declares NOT NULL."""
    return tuple(f.name for f in STORED[relation].fields if not f.nullable)


def write_observed(df: DataFrame, path: str, relation: str) -> dict[str, int]:
    """C3 while writing: ``df`` to ``path``, and the nulls of each column that
    ``relation`` declares NOT NULL, counted by the tasks that write the rows, so
    the check costs no pass of its own."""
    seen = Observation()
    cols = not_null_columns(relation)
    df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).write.parquet(path)
    return {c: int(seen.get[c] or 0) for c in cols}


def dedupe_news(items: DataFrame) -> DataFrame:
    """C4: one row per (provider, query, url), the earliest ``fetched_at``
    (then lowest id) kept."""
    w = Window.partitionBy("provider", "query", "url").orderBy(F.col("fetched_at").asc(), F.col("id").asc())
    return items.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
