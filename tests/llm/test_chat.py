import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.llm import chat
from forumlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    return chat.train(chat.as_transcripts(turns), piece="piece")


def brute(model, rows):
    """Plain Viterbi over whole transcripts: (conv, turn, role, lines, rendered)."""
    out = []
    for conv, some in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        some = sorted(some, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        lines = "\n".join(t or "" for _, _, t in some).split("\n")
        path = chat.viterbi(model, model.scores(chat.observe(lines, True)))
        turns = []
        for s, x in zip(path.tolist(), lines, strict=True):
            if s % 2 == 0:
                turns.append((chat.ROLES[s // 2], []))
                x = x[chat.marker(x)[1]:]
            turns[-1][1].append(x)
        out += [(conv, n, r, len(x), f"<|{r}|>\n" + "\n".join(x).strip(" \t\n\x0b\f\r") + "\n<|end|>")
                for n, (r, x) in enumerate(turns)]
    return sorted(out, key=repr)


def test_held_out_accuracy(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    fold = F.pmod(F.xxhash64("conv_id", F.lit("fold")), F.lit(3))
    pieces = chat.as_transcripts(turns)
    model = chat.train(pieces.where(fold != 0), piece="piece")
    held = pieces.where(fold == 0)
    got = {(r.conv_id, r.turn): (r.role, r.rendered) for r in chat.parse_transcripts(held, model).collect()}
    true = {(r.conv_id, r.turn): (r.role, r.text) for r in turns.where(fold == 0).collect()}
    assert sum(got.get(k, ("",))[0] == r for k, (r, _) in true.items()) >= 0.93 * len(true)
    exact = sum(got.get(k) == (r, f"<|{r}|>\n{t.strip()}\n<|end|>") for k, (r, t) in true.items())
    assert exact >= 0.9 * len(true)


def test_query_against_plain_viterbi(spark, model):
    pieces = chat.as_transcripts(spark.read.parquet(f"{SF}/conversations.parquet"))
    rows = [(r.conv_id, r.piece, r.text) for r in pieces.collect()]
    got = [(r.conv_id, r.turn, r.role, r.n_lines, r.rendered) for r in QUERIES["op10_chat"](spark, SF).collect()]
    assert sorted(got, key=repr) == brute(model, rows)


def test_chunks_change_nothing(spark, model, monkeypatch):
    turns = [r for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    rows = [(1, i, ("User: " if r.role == "user" and i % 3 else "") + r.text) for i, r in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, piece long, text string")
    want = brute(model, rows)
    for size in (1, 7, 64):
        monkeypatch.setattr(chat, "CHUNK", size)
        got = [tuple(r) for r in chat.parse_transcripts(df, model).collect()]
        assert sorted(got, key=repr) == want


def test_edges(spark, model):
    rows = [(1, 0, "User: hi?"), (1, 1, None), (1, 2, "Assistant: hello.\nmore text here"), (2, 0, ""), (3, None, "x"),
            (3, 5, "### Human\nquestion?"), (3, 5, "### Human\nquestion?"), (None, 0, "Q: a?"), (None, 1, "A: b."),
            (4, -7, "SYSTEM: be kind\n\n[user] é?\n\n[assistant] ok."), (5, 0, "word " * 200000), (6, 0, "a\n" * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, piece long, text string").selectExpr(
        "*", "1 as turn", "2 as role", "3 as conv", "4 as chunk")
    got = chat.parse_transcripts(df, model).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(model, rows)
    four = sorted((r.turn, r.role, r.rendered) for r in got if r.conv_id == 4)
    assert [x for _, _, x in four] == ["<|system|>\nbe kind\n<|end|>", "<|user|>\né?\n<|end|>", "<|assistant|>\nok.\n<|end|>"]
    assert chat.parse_transcripts(df.limit(0), model).count() == 0


def test_no_labels(spark):
    none = spark.createDataFrame([(1, 0, "x", None)], "conv_id long, turn long, text string, role string")
    model = chat.train(none)
    assert np.isfinite(model.start).all()
    rows = none.select("conv_id", F.col("turn").alias("piece"), F.lit("Human: x\nAI: y").alias("text"))
    assert len(chat.parse_transcripts(rows, model).collect()) >= 1


@pytest.mark.parametrize("line,role", [("User: a", 2), ("### Human", 2), ("[assistant] x", 3), ("**Q**: x", 2), ("A: x", 3),
                                       ("A text: x", 0), ("user", 0), ("<system> x", 1), ("me too", 0), ("", 0)])
def test_markers(line, role):
    assert chat.marker(line)[0] == role


def test_steps_are_counted(spark):
    """A turn of one line steps on from its first state, a longer one from its second."""
    rows = [(1, 0, "hi?", "user"), (1, 1, "a\nb\nc", "assistant"), (1, 2, "ok", "user"), (2, 0, "x\ny", "user"), (2, 1, "z", "assistant")]
    model = chat.train(spark.createDataFrame(rows, "conv_id long, turn long, text string, role string"))
    counts = np.zeros((chat.STATES, chat.STATES))
    for a, b in ((2, 4), (4, 5), (5, 5), (5, 2), (2, 3), (3, 4)):
        counts[a, b] += 1
    want = chat._log(counts)
    allowed = model.step > -1e8
    assert np.allclose(model.step[allowed], want[allowed])
    start = np.zeros(chat.STATES)
    start[2] = 2
    assert np.allclose(model.start[::2], chat._log(start)[::2])
