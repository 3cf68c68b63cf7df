"""Scalar text rules against tables of inputs and expected outputs."""

from pyspark.sql import functions as F

from forumlens.functions import text as T


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col(F.col("x")).alias("y")).first()["y"]


def mapped(spark, col, table, dtype):
    """What ``col`` makes of each input of ``table``, beside what it should be."""
    got = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(table)], f"i int, x {dtype}")
    got = dict(got.select("i", col(F.col("x")).alias("y")).collect())
    return [(x, got[i]) for i, (x, _) in enumerate(table)], table


def test_clip_text(spark):
    full = ("w " * 220)[:-1]
    got, want = mapped(spark, T.clip_text, [
        (full, full), (full + " w", full + "..."), ("a\u00a0b c", "a b c"), ("  lead and trail  ", "lead and trail"),
        ("", ""), ("x\x1cy", "x y"), ("tab\tand\nnewline", "tab and newline"), ("\u3000wide\u2003space", "wide space")],
        "string")
    assert got == want


def test_delta_labels(spark):
    got, want = mapped(spark, lambda c: T.delta_text(c, False), [(5, "+5"), (0, "0"), (-2, "-2"), (None, None)], "bigint")
    assert got == want
    got, want = mapped(spark, lambda c: T.delta_text(c, True), [
        (0.01, "+0.01"), (0.00004, "0.0"), (-0.00004, "-0.0"), (0.123456, "+0.1235"), (-0.5, "-0.5"), (1.0, "+1.0"),
        (None, None), (0.0025, "+0.0025"), (0.0, "0.0"), (12345678.9, "+12345678.9"),
        # half-way cases: the exact binary values decide
        (0.00005, "+0.0001"), (0.12345, "+0.1235"), (0.00015, "+0.0001"), (0.00025, "+0.0003"), (-0.12345, "-0.1235"),
        (0.5 + 2 ** -5, "+0.5312"), (0.5 + 3 * 2 ** -5, "+0.5938")], "double")
    assert got == want


def test_py_float_str(spark):
    vals = [0.0001, 1e-05, 1.5e7, 0.0655, 1.0, 123.25, 1e16, 12345678.9, -0.001, 3.0e-7]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select("x", T.py_float_str(F.col("x")).alias("y"))
    for r in df.collect():
        assert r["y"] == str(r["x"]), r["x"]


def test_reportable_comments(spark):
    got, want = mapped(spark, T.reportable_comment, [
        ("  [deleted] x", False), ("[Removed]", True), ("   ", False), (None, False), ("[removed]", False), ("ok", True),
        (" [deleted]", False)], "string")
    assert got == want


def test_query_line_clean_and_filter(spark):
    clean = [("- crude oil prices", "crude oil prices"), ('"Fed"', "Fed"), ("Here are queries", "Here are queries"),
             ("  **Nvidia stock news**  ", "Nvidia stock news"), ('"-x-"', "x"), ("", ""), ("Post 1", "Post 1")]
    got, want = mapped(spark, T.query_line_clean, clean, "string")
    assert got == want
    keep = [True, True, False, True, True, False, False]
    got, want = mapped(spark, T.query_line_keep, [(c, k) for (_, c), k in zip(clean, keep, strict=True)], "string")
    assert got == want


def test_discussion_url_without_id(spark):
    df = spark.createDataFrame([(None, "sub", "https://x"), ("", None, None), ("ab", None, "u")],
                               "rid string, sub string, url string")
    got = [r[0] for r in df.select(T.discussion_url(F.col("rid"), F.col("sub"), F.col("url"))).collect()]
    assert got == ["https://x", "", "https://www.reddit.com/r/wallstreetbets/comments/ab/"]


def test_comment_line(spark):
    df = spark.createDataFrame([(None, "", "  hello   world ", None), (3, "bob", "x", "http://u")],
                               "score bigint, author string, body string, url string")
    got = [r[0] for r in df.select(T.comment_line(F.col("score"), F.col("author"), F.col("body"), F.col("url"))).collect()]
    assert got == ["- hello world\n", "- [score 3] u/bob: x (Source: http://u)\n"]
