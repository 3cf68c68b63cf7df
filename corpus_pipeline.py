"""The training-data pipeline: stages over ``documents``, each written and reread.

Each stage takes what its predecessor kept, whole, and returns the columns of
its input; the last adds what the mix takes of each document.  Texts that a
stage shortens get their new length in ``n_chars``, where there is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import common as C
from forumlens.llm.decontaminate import decontaminate
from forumlens.llm.line_dedup import line_dedup
from forumlens.llm.mixing import mix_sources
from forumlens.llm.quality import GRADES, accepted, label_grades, rate, train
from forumlens.llm.simhash import keep_one


def _with_text(out: DataFrame, docs: DataFrame, text: Column, changed: Column) -> DataFrame:
    """The columns of ``docs`` with a new text, and its length where it changed."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length(text).cast(kind)).otherwise(F.col("n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rated good; those without text stay out of judgement and pass."""
    model = train(docs, label_grades(C.read(spark, sf_dir, "labels")), GRADES)
    name = C.free_name(docs, "rating")
    rated = rate(docs, model, result=name)
    return rated.where(accepted(F.col(name)) | (F.trim(F.coalesce("text", F.lit(""))) == "")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of lines; a document of nothing else goes."""
    name = C.free_name(docs, "line_runs")
    out = line_dedup(docs, min_lines=1, result=name).where(~F.col(f"{name}.emptied"))
    return _with_text(out, docs, F.col(f"{name}.clean_text"), F.col(f"{name}.n_removed") > 0)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate class."""
    return keep_one(docs, shingle=4, radius=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that they share with benchmark items."""
    name = C.free_name(docs, "contamination")
    out = decontaminate(docs, C.read(spark, sf_dir, "benchmark"), width=10, result=name)
    return _with_text(out, docs, F.col(f"{name}.clean_text"), F.size(f"{name}.spans") > 0)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of each."""
    name = C.free_name(docs, "mix")
    out = mix_sources(docs, weights=(5, 2, 1), max_epochs=3, seed=17, result=name)
    added = [F.col(f"{name}.{c}").alias(C.free_name(docs, c)) for c in ("size", "source_size", "target", "taken")]
    return out.select(*docs.columns, *added)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near),
          ("decontaminate", benchmark), ("mix", mix)]

#: The classifier is fitted, and fingerprints link transitively: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
