"""Transcript parsing: a hidden Markov model recovers speakers, Viterbi's path
is cut into turns, and each turn is rendered in one canonical form.

A transcript is a sequence of lines.  A line's features are its speaker marker,
what stands before it, its length and its last mark; a state is a role and
whether the line begins a turn.  Starts, steps and features are counted in Spark
over all labelled lines.

Long transcripts are cut into chunks.  A chunk's best scores between its first
and last states are one small matrix; the matrices of a transcript are chained
to fix the states at the cuts, and then each chunk is decoded by itself.  So a
transcript that holds a third of all lines is decoded by many tasks, and only
its matrices (one per ``CHUNK`` pieces) meet in one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm import common as C

ROLES = ("system", "user", "assistant")
#: State 2 * role begins a turn, 2 * role + 1 goes on with it.
STATES = 2 * len(ROLES)
CHUNK = 64  # pieces
MARKERS = {
    "system": ("system", "sys", "instructions", "context"),
    "user": ("user", "human", "customer", "q", "question", "me", "you"),
    "assistant": ("assistant", "ai", "bot", "model", "a", "answer", "agent"),
}
_NAMES = "|".join(sorted((n for names in MARKERS.values() for n in names), key=len, reverse=True))
#: A marker is one of the names at the start of a line, behind decoration and
#: with a colon or a closing bracket after it, or a heading mark before it.
MARKER_RE = rf"(?i)^[ \t]*(?:(?:[#*<\[(|]+[ \t]*)({_NAMES})[ \t]*[*|>\])]*:?[*]*(?:[ \t]+|$)|({_NAMES})[ \t]*:[ \t]*)"
_MARKER = re.compile(MARKER_RE)
LENGTHS = (1, 40, 120, 300)
LAST = "?:.!"
FEATURES = (len(ROLES) + 1, 2, len(LENGTHS) + 1, len(LAST) + 1)


def marker(line: str) -> tuple[int, int]:
    """Role number + 1 of the line's marker (0: none), and where the line's text starts."""
    m = _MARKER.match(line)
    if not m:
        return 0, 0
    name = (m.group(1) or m.group(2)).lower()
    return 1 + next(i for i, r in enumerate(ROLES) if name in MARKERS[r]), m.end()


def observe(lines: list[str], fresh: bool) -> np.ndarray:
    """Feature values of consecutive lines; ``fresh``: the first follows a blank or nothing."""
    out = np.zeros((len(lines), len(FEATURES)), np.int64)
    for i, line in enumerate(lines):
        text = line.strip()
        out[i] = (marker(line)[0], fresh, np.searchsorted(LENGTHS, len(text), side="right"),
                  1 + LAST.find(text[-1:]) if text else 0)
        fresh = not text
    return out


@dataclass
class Model:
    start: np.ndarray  # log probabilities
    step: np.ndarray
    features: list[np.ndarray]  # per feature: states x values

    def scores(self, seen: np.ndarray) -> np.ndarray:
        return sum(f[:, seen[:, k]].T for k, f in enumerate(self.features))


def _log(counts: np.ndarray) -> np.ndarray:
    smooth = counts + 0.5
    return np.log(smooth / smooth.sum(axis=-1, keepdims=True))


def _chain(model: Model, scores: np.ndarray) -> np.ndarray:
    """Best score from each first state to each last state of the lines."""
    best = np.full((STATES, STATES), -np.inf)
    np.fill_diagonal(best, scores[0])
    for row in scores[1:]:
        best = (best[:, :, None] + model.step[None]).max(axis=1) + row
    return best


def viterbi(model: Model, scores: np.ndarray, first: int | None = None, last: int | None = None) -> np.ndarray:
    """The best path, its first and last states fixed if told; ties to the lower state."""
    best = scores[0] + (model.start if first is None else np.where(np.arange(STATES) == first, 0, -np.inf))
    back = np.zeros((len(scores), STATES), np.int64)
    for i, row in enumerate(scores[1:], 1):
        ways = best[:, None] + model.step
        back[i] = ways.argmax(axis=0)
        best = ways.max(axis=0) + row
    path = np.zeros(len(scores), np.int64)
    path[-1] = best.argmax() if last is None else last
    for i in range(len(scores) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def cuts(model: Model, matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """First and last state of each chunk on the best path through all."""
    into = [model.start]  # best score of each first state of a chunk
    for m in matrices:
        end = (into[-1][:, None] + m).max(axis=0)
        into.append((end[:, None] + model.step).max(axis=0))
    out: list[tuple[int, int]] = []
    for c in range(len(matrices) - 1, -1, -1):
        ways = into[c][:, None] + matrices[c]
        if out:
            last = int((ways.max(axis=0) + model.step[:, out[-1][0]]).argmax())
        else:
            last = int(ways.max(axis=0).argmax())
        out.append((int(ways[:, last].argmax()), last))
    return out[::-1]


def _before(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``rows`` with column ``name``: ``value`` of the transcript's row before.

    Inside a chunk by a window; across chunks from the last rows of the chunks
    before, so that no task holds all rows of a long transcript.
    """
    inside = Window.partitionBy("conv", "chunk").orderBy("piece", "text")
    ends = rows.groupBy("conv", "chunk").agg(F.max(F.struct("piece", "text", value)).alias("x"))
    chunks = Window.partitionBy("c").orderBy("k")
    ends = ends.select(F.col("conv").alias("c"), F.col("chunk").alias("k"), F.col(f"x.{value}").alias("end"))
    ends = ends.select("c", "k", F.lag("end").over(chunks).alias("end")).repartition(C.shuffle_width(rows.sparkSession))
    out = rows.withColumns({name: F.lag(value).over(inside), "nth": F.row_number().over(inside)})
    out = out.join(ends, out["conv"].eqNullSafe(ends["c"]) & (out["chunk"] == ends["k"]))
    return out.withColumn(name, F.when(F.col("nth") == 1, F.col("end")).otherwise(F.col(name))).drop("c", "k", "end", "nth")


def _pieces(rows: DataFrame, conv: str, piece: str, text: str, *more: Column) -> DataFrame:
    """(conv, chunk, piece, text, fresh: the piece before ends in a blank line or is none)."""
    out = rows.select(rows[conv].cast("string").alias("conv"), rows[piece].cast("long").alias("piece"),
                      F.coalesce(rows[text], F.lit("")).alias("text"), *more)
    out = out.withColumns({"chunk": F.coalesce(F.floor(F.col("piece") / CHUNK), F.lit(-(1 << 60))),
                           "blank": F.col("text").rlike(r"(^|\n)[ \t\r\f\x0B]*$")})
    out = _before(out, "blank", "fresh").drop("blank")
    return out.withColumn("fresh", F.coalesce("fresh", F.lit(True)))


def _chunks(group: pa.Table, *keys: str):
    """The group's rows, sorted, chunk by chunk."""
    rows = sorted(group.to_pylist(), key=lambda r: tuple((r[k] is not None, r[k]) if r[k] is not None else (False,)
                                                         for k in (*keys, "piece", "text")))
    for _, some in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield list(some)


def _seen(rows: list[dict]) -> tuple[list[str], np.ndarray, list[int]]:
    lines, seen, owner = [], [], []
    for i, r in enumerate(rows):
        mine = r["text"].split("\n")
        lines += mine
        seen.append(observe(mine, r["fresh"]))
        owner += [i] * len(mine)
    return lines, np.concatenate(seen), owner


def train(rows: DataFrame, conv: str = "conv_id", piece: str = "turn", text: str = "text",
          role: str = "role") -> Model:
    """Counts over all labelled pieces, each a turn; other roles and null don't count."""
    number = F.array_position(F.array(*map(F.lit, ROLES)), F.lower(rows[role])) - 1
    known = _pieces(rows, conv, piece, text, number.cast("int").alias("role")).where("role >= 0")

    def observed(batches):
        for batch in batches:
            counts = {}
            for r in batch.to_pylist():
                lines = r["text"].split("\n")
                for k, f in enumerate(observe(lines, r["fresh"])):
                    key = (2 * r["role"] + (k > 0), *f.tolist())
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_pylist(
                [{"state": s, "seen": list(f), "n": n} for (s, *f), n in counts.items()],
                pa.schema([("state", pa.int32()), ("seen", pa.list_(pa.int32())), ("n", pa.int64())]))

    kinds = known.select("text", "role", "fresh").mapInArrow(observed, "state int, seen array<int>, n long")
    features = [np.zeros((STATES, n)) for n in FEATURES]
    # at most states x feature values rows
    for r in kinds.groupBy("state", "seen").agg(F.sum("n").alias("n")).collect():
        for k, v in enumerate(r.seen):
            features[k][r.state, v] += r.n
    n_lines = F.size(F.split("text", "\n", -1))
    start, step = np.zeros(STATES), np.zeros((STATES, STATES))
    known = known.withColumn("state", (2 * F.col("role") + (n_lines > 1).cast("int")).cast("int"))  # a turn's last state
    steps = _before(known, "state", "before").select("role", "before", n_lines.alias("n")).groupBy("role", "before")
    for r in steps.agg(F.count(F.lit(1)).alias("turns"), F.sum("n").alias("lines"),
                       F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("long")).collect():
        a = 2 * r.role
        step[a, a + 1] += r.long
        step[a + 1, a + 1] += r.lines - r.turns - r.long
        if r.before is None:
            start[a] += r.turns
        else:
            step[r.before, a] += r.turns
    forbidden = np.zeros((STATES, STATES), bool)  # going on with another's turn, or from nothing
    for s in range(STATES):
        for t in range(1, STATES, 2):
            forbidden[s, t] = s // 2 != t // 2
    first = np.where(np.arange(STATES) % 2 == 1, -1e9, _log(start))
    return Model(first, np.where(forbidden, -1e9, _log(step)), [_log(f) for f in features])


def _measure(model: Model):
    def run(group: pa.Table) -> pa.Table:
        out = []
        for rows in _chunks(group, "conv", "chunk"):
            _, seen, _ = _seen(rows)
            out.append({"conv": rows[0]["conv"], "chunk": rows[0]["chunk"],
                        "matrix": _chain(model, model.scores(seen)).ravel().tolist()})
        return pa.Table.from_pylist(out, pa.schema([("conv", pa.string()), ("chunk", pa.int64()),
                                                    ("matrix", pa.list_(pa.float64()))]))
    return run


def _tie(model: Model):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["conv"] is not None, r["conv"] or "", r["chunk"]))
        out = []
        for conv, some in groupby(rows, key=lambda r: r["conv"]):
            some = list(some)
            found = cuts(model, [np.array(r["matrix"]).reshape(STATES, STATES) for r in some])
            out += [{"conv": conv, "chunk": r["chunk"], "first": a, "last": b}
                    for r, (a, b) in zip(some, found, strict=True)]
        return pa.Table.from_pylist(out, pa.schema([("conv", pa.string()), ("chunk", pa.int64()),
                                                    ("first", pa.int32()), ("last", pa.int32())]))
    return run


PART = pa.schema([("conv", pa.string()), ("chunk", pa.int64()), ("part", pa.int64()), ("begins", pa.int64()),
                  ("role", pa.string()), ("n_lines", pa.int64()), ("text", pa.string())])


def _decode(model: Model):
    """The parts of turns in each chunk: part 0 goes on with the turn before."""
    def run(group: pa.Table, ends: pa.Table) -> pa.Table:
        fixed = {(r["conv"], r["chunk"]): (r["first"], r["last"]) for r in ends.to_pylist()}
        out = []
        for rows in _chunks(group, "conv", "chunk"):
            lines, seen, _ = _seen(rows)
            key = (rows[0]["conv"], rows[0]["chunk"])
            path = viterbi(model, model.scores(seen), *fixed[key])
            begin = path % 2 == 0
            turn = np.cumsum(begin)
            for part in range(int(turn[0]), int(turn[-1]) + 1):
                mine = np.flatnonzero(turn == part)
                text = [lines[i][marker(lines[i])[1]:] if begin[i] else lines[i] for i in mine]
                out.append({"conv": key[0], "chunk": key[1], "part": part, "begins": int(turn[-1]),
                            "role": ROLES[path[mine[0]] // 2], "n_lines": len(mine), "text": "\n".join(text)})
        return pa.Table.from_pylist(out, PART)
    return run


def parse_transcripts(rows: DataFrame, model: Model, conv: str = "conv_id", piece: str = "piece",
                      text: str = "text") -> DataFrame:
    """One row per recovered turn: ``conv``, turn (from 0), role, n_lines and
    rendered, the canonical form ``<|role|>\\ntext\\n<|end|>`` without marker and
    outer blank space.

    A transcript is all rows of one ``conv`` (null is one too), joined by line
    feeds in the order of ``piece`` (null first; of one number by text).  Null
    and empty texts are blank lines; other columns are ignored; no rows give no
    turns.
    """
    spark = rows.sparkSession
    kind = rows.schema[conv].dataType.simpleString()
    groups = C.shuffle_width(spark) * 2
    pieces = C.stored(_pieces(rows, conv, piece, text), "pieces")
    deal = F.pmod(F.xxhash64("conv", "chunk"), F.lit(groups)).cast("int")
    chunks = pieces.select("conv", "chunk", "piece", "text", "fresh", deal.alias("deal")).groupBy("deal")
    matrices = chunks.applyInArrow(_measure(model), "conv string, chunk long, matrix array<double>")
    by_conv = F.pmod(F.xxhash64("conv"), F.lit(groups)).cast("int")
    ends = C.stored(matrices.withColumn("deal", by_conv).groupBy("deal").applyInArrow(
        _tie(model), "conv string, chunk long, first int, last int"), "cuts")
    parts = chunks.cogroup(ends.select("*", deal.alias("deal")).groupBy("deal")).applyInArrow(
        _decode(model), "conv string, chunk long, part long, begins long, role string, n_lines long, text string")
    parts = C.stored(parts, "parts")
    # turns before each chunk; part 0 of a chunk is the last turn of those before
    counts = parts.groupBy("conv", "chunk").agg(F.max("begins").alias("n"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("conv").alias("c"), F.col("chunk").alias("k"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = counts.repartition(C.shuffle_width(spark))
    at = parts.join(counts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
    turns = at.groupBy("conv", (F.col("base") + F.col("part") - 1).alias("turn")).agg(
        F.first("role").alias("role"), F.sum("n_lines").alias("n_lines"),
        F.sort_array(F.collect_list(F.struct("chunk", "text"))).alias("texts"))
    body = F.regexp_replace(F.array_join("texts.text", "\n"), r"^\s+|\s+$", "")
    return turns.select(F.col("conv").cast(kind).alias(conv), "turn", "role", "n_lines", F.concat(
        F.lit("<|"), F.col("role"), F.lit("|>\n"), body, F.lit("\n<|end|>")).alias("rendered"))


def as_transcripts(turns: DataFrame) -> DataFrame:
    """Labelled turns (conv_id, turn, role, text) as raw transcripts, a piece per
    turn: five styles by conversation, one of which marks only every other turn."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    who = F.lower("role")
    short = F.when(who == "assistant", "A").when(who == "user", "Q").otherwise("System")
    other = F.when(who == "assistant", "AI").when(who == "user", "Human").otherwise("System")
    mark = (F.when(style == 0, F.concat(F.initcap(who), F.lit(": ")))
            .when(style == 1, F.concat(F.lit("### "), other, F.lit("\n")))
            .when(style == 2, F.concat(short, F.lit(": ")))
            .when(style == 3, F.concat(F.lit("["), who, F.lit("] ")))
            .otherwise(F.when(F.col("turn") % 2 == 0, F.concat(other, F.lit(": "))).otherwise("")))
    text = F.concat(F.coalesce(mark, F.lit("")), F.coalesce("text", F.lit("")), F.lit("\n"))
    return turns.select("conv_id", F.col("turn").alias("piece"), text.alias("text"), "role")
