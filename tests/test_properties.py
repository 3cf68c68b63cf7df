"""Randomised properties (seeded): Python number printing, clipping, and
whitespace splitting against Python itself."""

import random
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from forumlens.functions import text as T

WS = ["\t", "\n", "\x0b", "\x0c", "\r", " ", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ",
      " ", " ", " ", " ", " ", " ", " ", "　"]


def test_py_float_str_random(spark):
    rnd = random.Random(7)
    vals = [rnd.uniform(-1, 1) * 10 ** rnd.randint(-9, 18) for _ in range(3000)]
    vals += [round(rnd.uniform(0, 5), 4) for _ in range(1000)] + [0.0, -0.0, 1e-4, 1e16, 9.999e15, 1e-5]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select("x", T.py_float_str(F.col("x")).alias("y"))
    for r in df.collect():
        x, y = r["x"], r["y"]
        if abs(x) < 1e16:
            assert y == str(x), (x, y)
        else:   # shortest text that reads back as x, as long as Python's
            assert float(y) == x and len(y) == len(str(x)), (x, y)


def test_round4_delta_random(spark):
    rnd = random.Random(11)
    vals = [round(rnd.uniform(0, 5), 4) - round(rnd.uniform(0, 5), 4) for _ in range(2000)]
    # half-way in print, on either side in fact
    vals += [rnd.choice((-1, 1)) * float(f"{rnd.randint(0, 3000)}.{rnd.randint(0, 9999):04d}5") for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select("x", T.delta_text(F.col("x"), True).alias("y"))

    for x, y in df.collect():
        # the exact binary value, rounded in decimal arithmetic
        want = Decimal(x).quantize(Decimal("0.0001"), ROUND_HALF_EVEN)
        assert Decimal(y) == want and y.startswith("+") == (want > 0), (x, y)


def test_clip_and_split_random(spark):
    rnd = random.Random(3)
    texts = []
    for _ in range(500):
        n = rnd.choice([0, 1, 5, 219, 220, 221, 400])
        parts = []
        for _ in range(n):
            parts.append("".join(rnd.choice("abcxyzÉé日") for _ in range(rnd.randint(1, 6))))
            parts.append("".join(rnd.choice(WS) for _ in range(rnd.randint(1, 3))))
        texts.append(rnd.choice(WS) + "".join(parts))
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(
        "x", T.clip_text(F.col("x")).alias("c"), F.size(T.words(F.col("x"))).alias("n"),
        T.clip_text(T.clip_text(F.col("x"))).alias("cc"))
    for r in df.collect():
        w = r["x"].split()
        assert r["n"] == len(w)
        assert r["c"] == (" ".join(w) if len(w) <= 220 else " ".join(w[:220]) + "...")
        if len(w) <= 220:
            assert r["cc"] == r["c"]          # clipping is idempotent within the limit
