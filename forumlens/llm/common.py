"""Helpers shared by the training-data operators.

Word scanning works on UTF-8 bytes with numpy: every separator these operators
use is ASCII, so byte classes cut exactly where code-point classes would.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.session import ensure_checkpoint_dir, shared_path

#: Words are maximal runs of anything but space and tab..carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_RE = r"[^\x20\x09-\x0D]+"
IS_SPACED = np.ones(256, bool)
IS_SPACED[list(SPACES)] = False
#: Words of the decontamination match: digits, letters, all beyond ASCII.
IS_ALNUM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    IS_ALNUM[_a:_b + 1] = True
#: Lower-cases A-Z only.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20

_BYTE_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_SLICE = 1 << 20  # bytes or words hashed at a time
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    """What the cluster sized its shuffles to; blocks and ranges follow it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage and
    survives lost executors, unlike cached or locally checkpointed rows."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def add_in_arrow(df: DataFrame, job, name: str, kind: T.DataType) -> DataFrame:
    """``df`` with a last column made by ``job`` over its record batches, which
    sees the columns by place: their names may be any."""
    plain = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    schema = T.StructType([*plain.schema.fields, T.StructField("made", kind)])
    return plain.mapInArrow(job, schema).toDF(*df.columns, name)


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, _SLICE + 4096)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        if n > _SLICE + 4096:  # one word longer than a slice: not kept
            return out[0], out[1]
        _POWERS[base] = (out[0], out[1])
    return _POWERS[base]


def _slices(buf: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``_SLICE`` bytes that cut no word."""
    a, n = 0, len(buf)
    while a < n:
        b = min(a + _SLICE, n)
        while b < n and is_word[buf[b]]:
            stop = np.flatnonzero(~is_word[buf[b:b + _SLICE]])
            b += int(stop[0]) if len(stop) else min(_SLICE, n - b)
        yield a, b
        a = b


def scan_words(data: bytes, is_word: np.ndarray, fold: np.ndarray | None = None
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and a 64-bit polynomial value of every word."""
    buf = np.frombuffer(data, np.uint8)
    found = []
    for a, b in _slices(buf, is_word):
        part = buf[a:b]
        edge = np.zeros(len(part) + 2, bool)
        edge[1:-1] = is_word[part]
        cuts = np.flatnonzero(edge[1:] != edge[:-1])
        s, e = cuts[0::2], cuts[1::2]
        up, down = _powers(_BYTE_BASE, len(part) + 1)
        x = (part if fold is None else fold[part]).astype(np.uint64)
        x += np.uint64(1)
        x *= down[:len(part)]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(x, out=total[1:])
        v = (total[e] - total[s]) * up[s]
        found.append((s + a, e + a, mix(v ^ (e - s).astype(np.uint64) << np.uint64(48))))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive values, by differences of
    one running sum instead of a loop."""
    out = []
    for a in range(0, max(0, len(values) - width + 1), _SLICE):
        part = values[a:a + _SLICE + width - 1]
        up, down = _powers(_WORD_BASE, len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * down[:len(part)], out=total[1:])
        n = len(part) - width + 1
        out.append(mix((total[width:] - total[:n]) * up[:n]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def doc_groups(texts: list[bytes | None], size: int = 1 << 21
               ) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, end, joined bytes, byte offset of each text): runs of texts of
    about ``size`` bytes, or one longer text, joined by line feeds."""
    a = 0
    while a < len(texts):
        b, total = a, 0
        while b < len(texts) and (b == a or total + len(texts[b] or b"") <= size):
            total += len(texts[b] or b"") + 1
            b += 1
        part = [t or b"" for t in texts[a:b]]
        at = np.zeros(len(part) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in part], out=at[1:])
        yield a, b, b"\n".join(part), at
        a = b
