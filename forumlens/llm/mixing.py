"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

A source's target is its weight times a common level, but at most
``max_epochs`` times its size; the level rises until the targets share out all
words.  A document is taken whole as often as its source's target holds the
source, and a seeded order of the documents decides who is taken once more: all
before a cut, and at the cut as many words as the target still lacks.

The cut is found in levels: running sums per source over 256 parts of the seeded
order, then over 256 parts of the one that holds the cut, and so on; the last
sum runs over the documents of a part of 1 / 16,777,216.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm import common as C

MAX_BROADCAST_SOURCES = 10_000
LEVELS = (2, 4, 6)  # leading hex digits of the seeded order
UP_TO = (Window.unboundedPreceding, Window.currentRow)


def _small(per_source: DataFrame) -> DataFrame:
    """A table of one row per source, to broadcast if the sources are few."""
    return F.broadcast(per_source) if per_source.count() <= MAX_BROADCAST_SOURCES else per_source


def water_level(sources: DataFrame, max_epochs: int) -> float:
    """The level at which ``sources`` (source_size, weight), each clamped at
    ``max_epochs`` sizes, share out all words: clamp, share the excess anew, repeat."""
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = float(total or 0) / float(weight or 1)
    while True:
        full = F.col("weight") * F.lit(level) > F.col("source_size") * max_epochs
        used, free = sources.agg(
            F.sum(F.when(full, F.col("source_size") * max_epochs).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        new = (total - used) / free if free else level
        if new == level:
            return level
        level = new


def _plan(rows: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source: source_size, target, whole (repetitions of every document),
    cut (the document at the cut) and part (words of it)."""
    by_name = Window.orderBy(F.asc_nulls_last("source"))  # over the sources, not their documents
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = C.stored(sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), nth)), "sources")
    level = water_level(sources, max_epochs)
    size = F.col("source_size")
    target = F.least((size * max_epochs).cast("double"), F.col("weight") * F.lit(level))
    whole = F.when(size > 0, F.floor(target / size)).otherwise(0)
    sources = sources.withColumn("target", target).withColumn("whole", whole.cast("long"))
    sources = C.stored(sources.withColumn("more", F.floor(F.col("target") + 0.5) - F.col("whole") * size), "targets")

    def cut(sums: DataFrame, order: str) -> DataFrame:
        """The first row of each source by ``order`` whose running sum reaches ``more``."""
        run = F.sum("words").over(Window.partitionBy("source").orderBy(order).rowsBetween(*UP_TO))
        sums = sums.withColumn("upto", run).where("upto >= more").groupBy("source").agg(
            F.min(F.struct(order, "words", "upto", "n", "more")).alias("x"))
        return sums.select("source", "x.*")

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("source", "its_source")
        return left.join(right, left["source"].eqNullSafe(right["its_source"])).drop("its_source")

    # the cut's place in the seeded order, some digits of it more at a time
    found = sources.where("more > 0").select("source", F.lit("").alias("digits"), "more")
    for n in LEVELS:
        inside = beside(rows, _small(found)).where(F.expr("startswith(place.key, digits)"))
        sums = inside.groupBy("source", F.substring("place.key", 1, n).alias("digits"), "more").agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        left = F.col("more") - F.col("upto") + F.col("words")
        found = C.stored(cut(sums, "digits").select("source", "digits", left.alias("more")), "cuts")
    inside = beside(rows, _small(found)).where(F.expr("startswith(place.key, digits)"))
    sums = inside.groupBy("source", "place", "more").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    found = cut(sums, "place").select(
        "source", F.col("place").alias("cut"),
        # equal rows share the words that are left
        F.expr("(more - upto + words) div n").alias("part"))
    found = found.withColumnRenamed("source", "its_source")
    return C.stored(sources.join(found, sources["source"].eqNullSafe(found["its_source"]), "left")
                    .select("source", "source_size", "target", "whole", "cut", "part"), "plan")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 17,
                result: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``result``: size (words of the text),
    source_size, target (words that the source should give), taken (words that
    the mix takes of this row, repeats counted), repeats (whole repetitions) and
    part (words of one more, begun at its start).

    ``weights`` repeat over the sources in code-point order, null last.  Null
    and empty texts have size 0 and are taken 0 words; documents without a
    source are a source; rows equal in id and text share the words at the cut.
    Rows with one id are told apart by their texts.  The same seed takes the
    same words.  An empty table stays empty.  If ``docs`` has a column ``result``
    the new one gets underscores.
    """
    result = C.free_name(docs, result)
    size, place, mine = (C.free_name(docs, n) for n in ("size", "place", "mine"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit(""))))
    rows = docs.withColumns({size: C.n_words(docs[text_col]), place: F.struct(
        key.alias("key"), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("version"))})
    narrow = C.stored(rows.select(docs[source_col].alias("source"), F.col(size).alias("size"),
                                  F.col(place).alias("place")), "sizes")
    plan = _plan(narrow, weights, max_epochs)
    plan = plan.select(F.struct(*plan.columns).alias(mine))
    plan = _small(plan)
    rows = rows.join(plan, rows[source_col].eqNullSafe(plan[f"{mine}.source"]))
    p = F.col(mine)
    whole_part = F.when(F.col(place) < p["cut"], F.col(size)).when(F.col(place) == p["cut"], p["part"]).otherwise(0)
    part = F.when(p["cut"].isNull(), F.lit(0)).otherwise(whole_part)
    once_more = (part == F.col(size)) & (F.col(size) > 0)
    out = F.struct(
        F.col(size).alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"),
        (F.col(size) * p["whole"] + part).alias("taken"),
        (p["whole"] + once_more.cast("long")).alias("repeats"), F.when(once_more, 0).otherwise(part).alias("part"))
    return rows.select(*[rows[c] for c in docs.columns], out.alias(result))
