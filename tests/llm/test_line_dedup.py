import random

import pytest
from oracle import compare

from forumlens.llm.line_dedup import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, least):
    """Every run of lines that also starts earlier, tried one by one."""
    docs = sorted({(k, t) for k, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(d, at, x) for d, (_, t) in enumerate(docs) for at, x in enumerate(t.split("\n")) if x.strip(BLANKS)]
    gone, longest = set(), {}
    for i in range(len(lines)):
        for j in range(i):
            n = 0
            while (i + n < len(lines) and lines[i + n][0] == lines[i][0] and lines[j + n][0] == lines[j][0]
                   and lines[i + n][2] == lines[j + n][2]):
                n += 1
            if n >= least:
                key = docs[lines[i][0]]
                gone.update((key, lines[i + m][1]) for m in range(n))
                longest[key] = max(n, longest.get(key, 0))
    out = []
    for k, t in rows:
        if t is None:
            out.append((k, 0, 0, 0, None))
            continue
        cut = t.split("\n")
        left = [x for at, x in enumerate(cut) if ((k, t), at) not in gone]
        n = len(cut) - len(left)
        out.append((k, len(cut), n, longest.get((k, t), 0),
                    "\n".join(left) if not n or any(x.strip(BLANKS) for x in left) else ""))
    return sorted(out, key=repr)


def of(out):
    return sorted(((r.doc_id, r.line_runs.n_lines, r.line_runs.n_removed, r.line_runs.longest,
                    r.line_runs.clean_text)
                   for r in out.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    names, rows = compare(spark, "op9_line_dedup", f"/root/testdata/{sf}")
    removed = [r[names.index("n_removed")] for r in rows]
    assert any(removed) and not all(removed)


def test_every_later_copy_goes(spark):
    """No line of the corpus stays twice."""
    out = line_dedup(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text"))
    left = out.selectExpr("explode(split(line_runs.clean_text, '\\n')) as line").where(r"line rlike '[^\\x20\\x09-\\x0D]'")
    assert left.groupBy("line").count().where("count > 1").count() == 0
    assert left.count() == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr(
        "explode(split(text, '\\n')) as line").where(r"line rlike '[^\\x20\\x09-\\x0D]'").distinct().count()


@pytest.mark.parametrize("seed,least", [(0, 1), (1, 2), (2, 3), (3, 5), (4, 10), (5, 6)])
def test_random_texts_against_brute_force(spark, seed, least):
    rng = random.Random(seed)
    some = ["a", "b", "a b", "c d e", "", "  ", "f g h i j k l m n o p", "q", "r s"]
    rows = [(k, "\n".join(rng.choice(some) for _ in range(rng.randint(1, 30)))) for k in range(25)]
    rows += [(100 + k, rows[k][1]) for k in range(6)]
    rows += [(200 + k, "\n".join(rows[k][1].split("\n")[k % 3:] + rows[k + 1][1].split("\n"))) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert of(line_dedup(df, min_lines=least)) == brute(rows, least)


def test_runs_of_many_lengths(spark):
    """Copies of parts of one long text: the longest run is found to the line."""
    rng = random.Random(9)
    base = [f"line {rng.randrange(400)}" for _ in range(300)]
    rows = [(0, "\n".join(base))]
    for k in range(1, 12):
        a, n = rng.randrange(150), rng.randrange(1, 140)
        rows.append((k, "\n".join([f"own {k}"] + base[a:a + n] + [f"own {k} too"] + base[:k])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 7):
        assert of(line_dedup(df, min_lines=least)) == brute(rows, least)


def test_edges(spark):
    run = "one two three\nfour five six\nseven eight"
    rows = [(1, run), (2, "x\n" + run + "\ny"), (3, None), (4, ""), (5, "\n\n"), (None, "p q r\ns t u"),
            (7, "p q r\ns t u"), (8, run), (8, run), (9, "one two three\n\n \nfour five six\nend"),
            (10, "z z z z z z\n" * 60), (11, "w" * 1_000_000 + " a b c d e f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "1 as version", "doc_id", "2 as lines", "text", "3 as gone", "4 as at", "5 as clean_text")
    out = line_dedup(df, min_lines=2)
    assert out.columns == [*df.columns, "line_runs"]
    assert of(out) == brute(rows, 2)
    got = {r.doc_id: r for r in out.collect()}
    assert [tuple(x) for x in got[2].line_runs.runs] == [(1, 4)] and got[2].line_runs.clean_text == "x\ny"
    assert got[8].line_runs.emptied and got[8].line_runs.clean_text == "" and got[8].text == run
    assert [tuple(x) for x in got[9].line_runs.runs] == [(0, 1), (3, 4)]
    assert got[10].line_runs.n_removed == 59 and got[10].line_runs.longest == 59 and not got[5].line_runs.emptied
    assert line_dedup(df.limit(0)).count() == 0
    clash = line_dedup(df.withColumn("Line_Runs", df.lines), min_lines=2)
    assert clash.columns[-2:] == ["Line_Runs", "line_runs_"]


def brute_copies(rows):
    """Per text, the runs that also start earlier and are no part of a longer one: (start, end, lines, words)."""
    docs = sorted({(k, t) for k, t in rows}, key=lambda r: r[0])
    lines = [(d, at, x) for d, (_, t) in enumerate(docs) for at, x in enumerate(t.split("\n")) if x.strip(BLANKS)]
    found = {key: [] for key in docs}
    for i in range(len(lines)):
        most = 0
        for j in range(i):
            n = 0
            while (i + n < len(lines) and lines[i + n][0] == lines[i][0] and lines[j + n][0] == lines[j][0]
                   and lines[i + n][2] == lines[j + n][2]):
                n += 1
            most = max(most, n)
        of_text = found[docs[lines[i][0]]]
        if most and (not of_text or lines[i + most - 1][1] + 1 > of_text[-1][1]):
            run = lines[i:i + most]
            of_text.append((run[0][1], run[-1][1] + 1, most, sum(len(x.split()) for _, _, x in run)))
    return found


@pytest.mark.parametrize("seed,least", [(0, 5), (1, 10)])
def test_copies_are_maximal_runs(spark, seed, least):
    """The runs that single lines don't tell, and what goes where only runs of some words do."""
    rng = random.Random(seed)
    some = ["a", "b", "a b", "c d e", "", "  ", "f g h i", "q", "r s"]
    rows = [(k, "\n".join(rng.choice(some) for _ in range(rng.randint(1, 25)))) for k in range(20)]
    rows += [(100 + k, "x" + str(k) + "\n" + rows[k][1] + "\n" + rows[k + 1][1]) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_copies(rows)
    got = line_dedup(df, long_words=least).collect()
    for r in got:
        runs = want[(r.doc_id, r.text)]
        assert [tuple(c) for c in r.line_runs.copies] == runs
        cut = r.text.split("\n")
        gone = {at for a, b, _, n in runs if n >= least for at in range(a, b) if cut[at].strip(BLANKS)}
        left = [x for at, x in enumerate(cut) if at not in gone]
        assert r.line_runs.long.n_removed == len(gone)
        assert r.line_runs.long.clean_text == (
            "\n".join(left) if not gone or any(x.strip(BLANKS) for x in left) else "")
    assert any(r.line_runs.long.n_removed < r.line_runs.n_removed for r in got)


def test_query_tells_runs(spark):
    """Lines that move together and lines that move alone are told apart."""
    names, rows = compare(spark, "op9_line_dedup", "/root/testdata/sf0.001")
    at = {n: i for i, n in enumerate(names)}
    assert max(r[at["longest"]] for r in rows) > 10
    assert 0 < sum(r[at["n_copies"]] for r in rows) < sum(r[at["n_removed"]] for r in rows)
    assert 0 < sum(r[at["n_removed_long"]] for r in rows) < sum(r[at["n_removed"]] for r in rows)
