"""Structured Streaming jobs for landed scrapes.

The reference re-runs a batch job on a schedule; here landed files are a
stream.  Every sink is replay-safe: a micro-batch that runs again (after an
executor or driver loss) rewrites the same table version / partition
instead of appending twice.  Checkpoints and tables live under the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_landed(spark: SparkSession, directory: str, file_glob: str, schema: T.StructType,
                max_files: int | None = None) -> DataFrame:
    """Stream of landed Parquet files (explicit schema, no inference)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # listing only, no data
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def write_epoch(df: DataFrame, path: str, epoch_id: int) -> None:
    """Write one epoch's rows into its own partition; a replayed epoch
    overwrites the same partition."""
    df.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")


def _compactions(spark: SparkSession, path: str) -> list[int]:
    base = f"{path}_compacted"
    if not exists(spark, base):
        return []
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(int(st.getPath().getName().split("=")[1]) for st in fs.listStatus(jvm_path)
                  if st.getPath().getName().startswith("upto=")
                  and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{st.getPath()}/_SUCCESS")))


def current_view(spark: SparkSession, path: str, key: str, before: int | None = None) -> DataFrame | None:
    """Merge-on-read state: per key, the row of the newest epoch (epochs
    before ``before`` only).  Each epoch holds complete rows for the keys
    it changed, so the newest epoch's row is the current one.  The newest
    finished compaction (see :func:`compact`) stands in for all epochs it
    covers."""
    parts = []
    usable = [u for u in _compactions(spark, path) if before is None or u < before]
    floor = usable[-1] if usable else None
    if floor is not None:
        parts.append(spark.read.parquet(f"{path}_compacted/upto={floor}").withColumn("epoch", F.lit(floor)))
    if exists(spark, path):
        d = spark.read.parquet(path)
        if before is not None:
            d = d.where(F.col("epoch") < before)
        if floor is not None:
            d = d.where(F.col("epoch") > floor)
        parts.append(d)
    if not parts:
        return None
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cols = [c for c in df.columns if c not in (key, "epoch")]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col("epoch")).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def compact(spark: SparkSession, path: str, key: str, upto_epoch: int) -> None:
    """Fold all epochs up to ``upto_epoch`` into one table; later reads use
    it plus the newer epochs only.  Written next to the epochs and visible
    only once complete, so a failed compaction changes nothing."""
    view = current_view(spark, path, key, before=upto_epoch + 1)
    if view is not None:
        view.write.mode("overwrite").parquet(f"{path}_compacted/upto={upto_epoch}")


def epoch_count(col: str, unit: str) -> Column:
    """Zone-less time as a count of ``unit`` since 1970-01-01 (no time zone
    or daylight-saving shift involved)."""
    return F.expr(f"timestampdiff({unit}, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")


def event_time(col: str) -> Column:
    """A TIMESTAMP for ``withWatermark`` from a zone-less time, read as UTC
    whatever the session time zone, so durations are never bent by DST."""
    return F.timestamp_micros(epoch_count(col, "MICROSECOND"))


def deduplicated(stream: DataFrame, keys: list[str], time_col: str, delay: str) -> DataFrame:
    """K2 source for :func:`dedupe_sink`: the first row of each of the
    ``keys`` (``time_col`` is one of them) by the state store, which forgets a
    key once the watermark is ``delay`` past it, and beside them every row once
    more with ``_raw`` true: the state store drops rows behind the watermark
    unseen, and the sink finds those among the raw ones."""
    clock = "_clock"
    seen = (stream.withColumn(clock, event_time(time_col)).withWatermark(clock, delay)
                  .dropDuplicatesWithinWatermark(keys).drop(clock))
    return seen.withColumn("_raw", F.lit(False)).unionByName(stream.withColumn("_raw", F.lit(True)))


def late_rows(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Raw rows, one per key, that the state store did not let pass: they came
    behind the watermark, or their key is known already."""
    raw, passed = batch.where("_raw").drop("_raw").dropDuplicates(keys), batch.where("not _raw").select(*keys)
    return raw.join(passed, [raw[k].eqNullSafe(passed[k]) for k in keys], "left_anti")


def not_stored(rows: DataFrame, stored: DataFrame, keys: list[str], days: list) -> DataFrame:
    """``rows`` whose keys aren't among the stored rows of the same ``days``:
    the list is a literal, so the scan opens those days' partitions only."""
    old = stored.where(F.col("_day").isin(*days)).select("_day", *keys)
    return rows.join(old, [old[k].eqNullSafe(rows[k]) for k in ["_day", *keys]], "left_anti")


def dedupe_sink(path: str, keys: list[str], time_col: str):
    """K2 ``foreachBatch`` body over :func:`deduplicated`: append the rows whose
    ``keys`` aren't stored yet, however late they come.  Rows that the state
    store let pass are new and written as they are; only the others are compared
    with stored rows, and only with those of their own days (``time_col`` is one
    of the keys, and stored rows lie by its day).  A replayed epoch rewrites its
    own rows."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("_day", F.to_date(time_col)).persist()
        try:
            late = late_rows(batch, keys)
            days = [r[0] for r in late.select("_day").distinct().collect()]  # the days of one batch's late rows
            if days and exists(spark, path):
                stored = spark.read.schema(batch.drop("_raw").schema.add("epoch", "long")).parquet(path)
                late = not_stored(late, stored.where(F.col("epoch") < epoch_id), keys, [d for d in days if d])
            new = batch.where("not _raw").drop("_raw").unionByName(late)
            new.write.mode("overwrite").partitionBy("_day").parquet(f"{path}/epoch={epoch_id}")
        finally:
            batch.unpersist()
    return run


def latest_metrics(snapshots: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """K3: current metrics per entity, newest by (scraped_at, id)."""
    row = F.struct(*[F.col(c) for c in ["scraped_at", *cols]])
    agg = snapshots.groupBy(key).agg(F.max_by(row, F.struct("scraped_at", "id")).alias("_n"))
    return agg.select(key, *[F.col(f"_n.{c}").alias(c) for c in ["scraped_at", *cols]])


def merge_updates_sink(path: str, key: str):
    """``foreachBatch`` body for update-mode aggregates: each epoch writes
    only its updated rows; :func:`current_view` gives the merged state."""
    def run(updates: DataFrame, epoch_id: int) -> None:
        write_epoch(updates, path, epoch_id)
    return run
