"""Size checks before broadcasting.

A side is broadcast only when it is proven small: ``limit(n + 1).count()``
stops reading after ``n + 1`` rows, so the check itself is cheap even when
the side turns out to be large.  Beyond the bound the plain DataFrame is
returned and Spark shuffles (sort-merge or shuffle-hash join), and AQE may
still switch to a broadcast at runtime from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows allowed on a broadcast side.  The sides broadcast here are narrow
# (a key plus one or two columns), so this stays well under the driver's
# broadcast limit.
MAX_BROADCAST_ROWS = 2_000_000


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    n = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    return df.limit(n + 1).count() <= n


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame | None:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows,
    else None (the caller keeps a shuffle join)."""
    return F.broadcast(df) if is_small(df, max_rows) else None


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    small = small_side(df, max_rows)
    return df if small is None else small


# Rows per key above which a key is "hot": one task should not receive it
# whole through a shuffle join.
HOT_KEY_ROWS = 5_000_000


def hot_keys(df: DataFrame, key: str, threshold: int | None = None) -> DataFrame | None:
    """Keys holding more than ``threshold`` rows, ready to broadcast, or
    None when there are none.  Counted with partial aggregation; the set is
    at most rows/threshold keys and is size-checked before broadcasting."""
    t = HOT_KEY_ROWS if threshold is None else threshold
    hot = df.groupBy(key).count().where(F.col("count") > t).select(key)
    if hot.limit(1).count() == 0:
        return None
    return small_side(hot)
