import pytest
from oracle import compare

from forumlens.llm.mixing import mix_sources, water_level

SCHEMA = "doc_id long, source string, text string"


def of(out):
    return {r.doc_id: r.mix for r in out.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    names, rows = compare(spark, "op8_mix_sources", f"/root/testdata/{sf}")
    by = {}
    for r in rows:
        r = dict(zip(names, r, strict=True))
        assert r["taken"] <= 3 * r["size"]
        t = by.setdefault((r["source_size"], r["target"]), [0])
        t[0] += r["taken"]
    assert all(abs(t[0] - target) <= 1 for (_, target), t in by.items())
    assert abs(sum(t for _, t in by) - sum(s for s, _ in by)) < 1e-6 * sum(s for s, _ in by)


def test_water_level(spark):
    def level(rows):
        return water_level(spark.createDataFrame(rows, "source_size long, weight int"), 3)
    assert level([(100, 1), (100, 1)]) == 100
    # 5/8 of 1000 is over 3 * 100: the rest is shared 2 : 1
    assert level([(100, 5), (400, 2), (500, 1)]) == pytest.approx(700 / 3)
    # the second clamp follows from the first
    assert level([(10, 5), (60, 2), (930, 1)]) == 790
    assert level([(0, 5), (0, 2)]) == 0


def test_clamped_split_and_stable(spark):
    rows = [(i, "a", "w " * 10) for i in range(10)] + [(100 + i, "b", "w " * 7) for i in range(100)] + [
        (300 + i, "c", "w " * 13) for i in range(50)] + [(400, None, "w " * 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = of(mix_sources(df))
    total = {s: sum(got[k].taken for k, x, _ in rows if x == s) for s in "abc"}
    assert got[0].target == 300 and total["a"] == 300 and {got[k].taken for k in range(10)} == {30}
    for s, k in (("b", 100), ("c", 300)):
        assert abs(total[s] - got[k].target) <= 0.5
    assert sum(1 for k in range(100, 200) if got[k].part) <= 1
    assert of(mix_sources(df.repartition(3))) == got
    other = of(mix_sources(df, seed=18))
    assert other != got and other[0].target == 300


def test_edges(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, None, "x y"), (None, None, "x y"), (4, "b", "p q r s"),
            (4, "b", "p q r s"), (4, "b", "other"), (5, "é", "one"), (6, "Z", "w " * 200000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as size", "2 as place", "3 as mine", "4 as target")
    out = mix_sources(df)
    assert out.columns == [*df.columns, "mix"]
    rows = out.collect()
    assert len(rows) == 9 and all(r.mix.taken <= 3 * r.mix.size for r in rows)
    assert [r.mix.taken for r in rows if r.doc_id in (1, 2)] == [0, 0]
    twins = [r.mix.taken for r in rows if r.text == "p q r s"]
    assert twins[0] == twins[1]
    assert mix_sources(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, "a", None), (2, "b", "")], SCHEMA)
    assert [r.mix.taken for r in mix_sources(empty).collect()] == [0, 0]
    clash = mix_sources(df.withColumnRenamed("size", "MIX"))
    assert clash.columns == [*[c if c != "size" else "MIX" for c in df.columns], "mix_"] and clash.count() == 9
