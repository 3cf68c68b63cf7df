"""Line deduplication by a suffix array over line identities, in DataFrame operations only.

Every non-blank line is a symbol (its MD5) and every such line of a text a
suffix.  Prefix doubling ranks the suffixes by their first 1, 2, 4, ... lines: a
rank is the slot in the suffix array where the interval of suffixes with that
common prefix starts.  A suffix whose prefix is its own alone is settled and
leaves; the rounds go on until no suffix is left, however long the runs are.

The rounds bound, for every suffix, the longest run of lines that also starts
earlier (in an earlier text, or further up) between two powers of two.  Binary
descent then finds the longest-common-prefix interval that it belongs to: a node
is an interval of suffixes that share m lines, known by its earliest suffix; a
step of 2**l splits it by the rank of the lines that follow, and all but the
earliest suffix of a part move on to the part's own node.  Only a part's earliest
suffix can be the copy that others of the node repeat, so it stays for them: each
suffix is in one node, and a node has one more.

A later copy of a run of ``min_lines`` lines or more is deleted; the maximal runs
that are later copies are told with their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm import common as C
from forumlens.operators.ordered import numbered, range_parts, summed

NOT_BLANK = r"[^\x20\x09-\x0D]"
#: A position is a text's number and the line's number in it.
LINE_BITS = 31


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, version, j, at, line, words): the j-th non-blank line, at line ``at``."""
    text = docs[text_col]
    cut = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("version"),
                       F.posexplode(F.filter(cut, lambda s: s["line"].rlike(NOT_BLANK))).alias("j", "s"))
    return rows.select("id", "version", "j", "s.at", F.unhex(F.md5("s.line")).alias("line"),
                       C.n_words(F.col("s.line")).alias("words"))


def _doc() -> Column:
    return F.shiftright("p", LINE_BITS)


def _again(df: DataFrame) -> DataFrame:
    """Dealt anew, so that Spark may split the other side of a join where a key is hot."""
    return df.repartition(C.shuffle_width(df.sparkSession))


def _slots(counted: DataFrame, key: str, by: str) -> DataFrame:
    """``counted`` (``n`` suffixes each) with the slot where each interval starts,
    counted from the slot of ``key``."""
    ranged = range_parts(counted, key, [by])
    return summed(ranged, key, [by], F.col("n"), "slot").withColumn("slot", F.col("slot") + F.col(key)).drop("n")


def _first_round(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts with repeated lines (doc, id, version); their repeated lines (p, at, words);
    and suffixes (p, r, first): rank of the first line, earliest suffix of the rank."""
    seen = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("r", F.lit(0).cast("long"))
    slots = _slots(seen, "r", "line").select("line", F.col("slot").alias("r"))
    found = C.stored(lines.join(_again(slots), "line").drop("line").dropDuplicates(["id", "version", "j"]), "found")
    one = found.select(F.lit(0).alias("all"), "id", "version").distinct()
    order = ["id", "version"]
    docs = C.stored(numbered(range_parts(one, "all", order), "all", order, "doc").drop("all"), "texts")
    other = _again(docs.withColumnsRenamed({"id": "id_", "version": "version_"}))
    same = found["id"].eqNullSafe(other["id_"]) & (found["version"] == other["version_"])
    rows = C.stored(found.join(other, same).select(
        (F.shiftleft("doc", LINE_BITS) + F.col("j")).alias("p"), "at", "words", "r"), "positions")
    first = rows.groupBy("r").agg(F.min("p").alias("first"))
    return docs, rows.select("p", "at", "words"), C.stored(rows.select("p", "r").join(_again(first), "r"), "round")


def _rounds(suffixes: DataFrame) -> list[DataFrame]:
    """(p, r, first) of the suffixes that share their first 1, 2, 4, ... lines
    with another one, round by round until there are none."""
    out = [suffixes]
    while True:
        k = len(out) - 1
        next_lines = Window.partitionBy(_doc()).orderBy("p").rangeBetween(1 << k, 1 << k)
        here = out[-1].select("p", "r", F.max("r").over(next_lines).alias("follow"))
        here = C.stored(here.where("follow is not null"), "follow")
        pairs = here.groupBy("r", "follow").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("first")).where("n > 1")
        slots = _again(_slots(pairs, "r", "follow"))
        here = C.stored(here.join(slots, ["r", "follow"]).select("p", F.col("slot").alias("r"), "first"), "round")
        if here.isEmpty():
            return out
        out.append(here)


def _copied(rounds: list[DataFrame]) -> DataFrame:
    """(p, w, m): the most lines m from p on that also start earlier, first at w."""
    each = [u.where("p > first").select("p", F.col("first").alias("w"), F.lit(k).alias("k")) for k, u in enumerate(rounds)]
    every = each[0]
    for more in each[1:]:
        every = every.unionByName(more)
    start = every.groupBy("p").agg(F.max(F.struct("k", "w")).alias("s")).select("p", "s.w", "s.k")
    start = C.stored(start, "bounds")
    witness = start.select(F.col("w").alias("p"), "w", "k").distinct()
    start = start.unionByName(witness).withColumn("m", F.expr("shiftleft(1L, k)"))
    done = start.where("k = 0").select("p", "w", "m")
    act = None
    for l in range(len(rounds) - 2, -1, -1):
        enter = start.where(F.col("k") == l + 1).select("p", "w", "m")
        act = enter if act is None else act.unionByName(enter)
        ranks = rounds[l].select(F.col("p").alias("next"), F.col("r").alias("f"))
        act = C.stored(act.withColumn("next", F.col("p") + F.col("m")).join(ranks, "next", "left").drop("next"), "split")
        parts = act.where("f is not null").groupBy("w", "m", "f").agg(
            F.count(F.lit(1)).alias("n"), F.min("p").alias("first")).where("n > 1").drop("n")
        parts = C.stored(parts, "parts")
        moves = F.col("p") > F.col("first")
        stepped = act.join(_again(parts), ["w", "m", "f"], "left").select(
            "p", F.when(moves, F.col("first")).otherwise(F.col("w")).alias("w"),
            F.when(moves, F.col("m") + (1 << l)).otherwise(F.col("m")).alias("m"))
        act = C.stored(stepped.unionByName(parts.select(
            F.col("first").alias("p"), F.col("first").alias("w"), (F.col("m") + (1 << l)).alias("m"))), "nodes")
    return (done if act is None else done.unionByName(act)).where("p > w")


def _union(spans: Column) -> Column:
    """Lines of ``spans`` (ascending, each ending behind the one before), each once."""
    start = F.transform(spans, lambda c, i: F.struct(
        F.greatest(c["start"], F.get(spans, i - 1)["end"]).alias("start"), c["end"].alias("end")))
    return F.flatten(F.transform(start, lambda c: F.sequence(c["start"], c["end"] - 1)))


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_lines: int) -> DataFrame:
    """(id, version, gone, longest, copies) of each text with any: line numbers to
    delete, ascending, the lines of its longest run that starts earlier, and its
    maximal runs that do (start, end, lines, words), by start."""
    lines = C.stored(_lines(docs, id_col, text_col), "lines")
    texts, rows, suffixes = _first_round(lines)
    runs = _copied(_rounds(suffixes)).where(F.col("m") >= min_lines)
    none = F.lit(None)
    both = rows.withColumn("end", none.cast("long")).unionByName(
        runs.select("p", none.cast("int").alias("at"), none.cast("long").alias("words"),
                    (F.col("p") + F.col("m")).alias("end")))
    by_place = Window.partitionBy(_doc()).orderBy("p")
    so_far = by_place.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_place.rangeBetween(Window.unboundedPreceding, -1)
    reached = both.select("*", F.max("end").over(so_far).alias("reach"), F.max("end").over(before).alias("before"),
                          F.sum("words").over(so_far).alias("upto")).where("reach > p")
    # the lines of a run are consecutive among those reached: nth and m name them
    reached = reached.withColumn("nth", F.count("at").over(so_far).cast("int"))
    lines_of = F.col("at").isNotNull()
    maximal = F.col("end") > F.coalesce("before", F.lit(0))
    found = reached.groupBy(_doc().alias("doc")).agg(
        F.sort_array(F.collect_list(F.when(lines_of, F.struct("at", "words", "upto")))).alias("lines"),
        F.sort_array(F.collect_list(F.when(maximal, F.struct(
            "nth", (F.col("end") - F.col("p")).cast("int").alias("m"))))).alias("copies"),
        F.max(F.col("end") - F.col("p")).cast("int").alias("longest"))

    def told(c: Column) -> Column:
        first, last = F.get("lines", c["nth"] - 1), F.get("lines", c["nth"] + c["m"] - 2)
        return F.struct(first["at"].alias("start"), (last["at"] + 1).alias("end"), c["m"].alias("lines"),
                        (last["upto"] - first["upto"] + first["words"]).alias("words"))

    found = found.select("doc", F.col("lines.at").alias("gone"), "longest", F.transform("copies", told).alias("copies"))
    return found.join(texts, "doc").select("id", "version", "gone", "longest", "copies")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 1,
               long_words: int = 10, result: str = "line_runs") -> DataFrame:
    """``docs`` with a struct column ``result``: n_lines, runs (maximal intervals
    of deleted line numbers, end exclusive), n_removed, longest (non-blank lines
    of the longest run that also starts earlier, if deleted), emptied (every
    non-blank line went), clean_text (the lines left; empty if emptied), copies
    (start, end, lines, words: each run of lines that also starts earlier and is
    no part of a longer one, by start; such runs may overlap) and long (n_removed,
    emptied, clean_text if copies of fewer than ``long_words`` words stay).

    A run of ``min_lines`` non-blank lines or more goes if it also starts
    earlier; with 1, every later copy of a line.  Lines end at line feeds; blank lines are neither compared nor deleted and do
    not part a run.  Earlier means a smaller id (null first), of texts with one
    id the smaller hash, then the smaller line number; rows equal in id and text
    are one document and fare alike.  The first copy of every line stays.  Null
    texts have no lines and stay null; texts without repeats stay as they are; an
    empty table stays empty.  If ``docs`` has a column ``result`` the new one gets
    underscores.
    """
    result = C.free_name(docs, result)
    found = repeated_lines(docs, id_col, text_col, min_lines)
    found = found.withColumnsRenamed({"id": "gone_id", "version": "gone_version"})
    # split before the join: behind it the lines are a column, not split anew by each lambda
    version, lines, gone, longest, copies = (
        C.free_name(docs, n) for n in ("version", "lines", "gone", "longest", "copies"))
    found = found.withColumnsRenamed({"gone": gone, "longest": longest, "copies": copies})
    rows = docs.withColumns({version: F.xxhash64(docs[text_col]), lines: F.split(docs[text_col], "\n", -1)})
    rows = rows.drop(text_col).join(
        found, rows[id_col].eqNullSafe(found["gone_id"]) & (rows[version] == found["gone_version"]), "left")
    n = F.size(lines)

    def left(some: Column) -> Column:
        stay = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), some), lambda i: F.get(F.col(lines), i))
        return F.array_join(F.when(some.isNull(), F.col(lines)).otherwise(stay), "\n")

    nexts = F.transform(gone, lambda i: i + 1)
    runs = F.arrays_zip(F.array_except(gone, nexts).alias("start"), F.array_except(nexts, gone).alias("end"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    none = F.array().cast("array<struct<start:int,end:int,lines:int,words:bigint>>")
    some_long, long_gone, text_name, long_name = (
        C.free_name(docs, x) for x in ("some_long", "long_gone", "clean_text", "long_text"))
    rows = rows.withColumn(some_long, F.filter(copies, lambda c: c["words"] >= long_words))
    rows = rows.withColumn(long_gone, F.when(
        F.size(some_long) > 0, F.array_intersect(_union(F.col(some_long)), F.col(gone))))
    rows = rows.withColumns({text_name: left(F.col(gone)), long_name: left(F.col(long_gone))})

    def all_gone(some: str, text: str) -> Column:
        return F.col(some).isNotNull() & ~F.col(text).rlike(NOT_BLANK)

    def removed(some: str) -> Column:
        return F.when(F.col(some).isNull(), 0).otherwise(F.size(some))

    emptied, long_emptied = all_gone(gone, text_name), all_gone(long_gone, long_name)
    out = F.struct(
        F.when(F.col(lines).isNull(), 0).otherwise(n).alias("n_lines"),
        F.coalesce(runs.cast("array<struct<start:int,end:int>>"), empty).alias("runs"),
        removed(gone).alias("n_removed"), F.coalesce(longest, F.lit(0)).alias("longest"), emptied.alias("emptied"),
        F.when(emptied, "").otherwise(F.col(text_name)).alias("clean_text"), F.coalesce(copies, none).alias("copies"),
        F.struct(removed(long_gone).alias("n_removed"), long_emptied.alias("emptied"),
                 F.when(long_emptied, "").otherwise(F.col(long_name)).alias("clean_text")).alias("long"))
    was = F.array_join(F.col(lines), "\n").alias(text_col)
    return rows.select(*[was if c == text_col else rows[c] for c in docs.columns], out.alias(result))
