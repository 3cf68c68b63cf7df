"""Registered queries of the training-data operators, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import common as C
from forumlens.llm.ann import nearest
from forumlens.llm.chat import as_transcripts, parse_transcripts
from forumlens.llm.chat import train as train_chat
from forumlens.llm.decontaminate import decontaminate
from forumlens.llm.hard_negatives import mine_hard_negatives
from forumlens.llm.lexical_search import ranked_search
from forumlens.llm.line_dedup import line_dedup
from forumlens.llm.main_text import extract_main_text
from forumlens.llm.mixing import mix_sources
from forumlens.llm.personal_data import BASE, find_personal_data
from forumlens.llm.quality import GRADES, accepted, label_grades, rate, train
from forumlens.llm.simhash import near_duplicates
from forumlens.llm.substring_dedup import substring_dedup
from forumlens.llm.warc import through_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(C.read(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, C.read(spark, sf_dir, "benchmark"), width=10)
    n_hit = F.aggregate("contamination.spans", F.lit(0).cast("long"),
                        lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", "contamination.n_words", n_hit.alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(C.read(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", "fingerprint", "component_id")


OP8_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
    FROM documents),
src AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS s,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM docs GROUP BY source),
fill AS (
    SELECT 0 AS step, CAST((SELECT sum(s) FROM src) AS DOUBLE) / (SELECT sum(w) FROM src) AS level
    UNION ALL
    SELECT step + 1,
           (SELECT CAST(sum(s) - sum(CASE WHEN w * f.level > 3 * s THEN 3 * s ELSE 0 END) AS DOUBLE)
                   / sum(CASE WHEN w * f.level > 3 * s THEN 0 ELSE w END) FROM src)
    FROM fill f WHERE step < 40),
plan AS (
    SELECT source, s, least(CAST(3 * s AS DOUBLE), w * level) AS target
    FROM src, (SELECT level FROM fill ORDER BY step DESC LIMIT 1)),
more AS (
    SELECT source, s, target, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS whole,
           CAST(floor(target + 0.5) AS BIGINT) AS t
    FROM plan),
run AS (
    SELECT d.doc_id, d.size, m.s, m.target, m.whole, m.t - m.whole * m.s AS more,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id
                             ROWS UNBOUNDED PRECEDING) - d.size AS before
    FROM docs d JOIN more m ON d.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
       CAST(size * whole + greatest(0, least(size, more - before)) AS BIGINT) AS taken
FROM run
"""


@query("op8_mix_sources", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mix_sources(docs, weights=(5, 2, 1), max_epochs=3, seed=17)
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


OP9_SQL = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents),
told AS (  -- every later copy of a line
    SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS said,
           row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth FROM cut),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (said AND nth > 1) AS n,
           string_agg(line, chr(10) ORDER BY pos) FILTER (NOT said OR nth = 1) AS text,
           coalesce(bool_or(said AND nth = 1), false) AS has_words
    FROM told GROUP BY doc_id),
lines AS (
    SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS j,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
    FROM cut WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
runs AS (  -- runs of at most ten lines, which hold ten words at least
    SELECT a.doc_id, a.j, b.j AS e, b.words AS last, a.words AS first,
           (SELECT sum(c.words) FROM lines c WHERE c.doc_id = a.doc_id AND c.j BETWEEN a.j AND b.j) AS words
    FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND b.j BETWEEN a.j AND a.j + 9),
shortest AS (
    SELECT doc_id, j, e FROM runs WHERE words >= 10 AND (words - last < 10 OR words - first < 10)),
named AS (
    SELECT s.doc_id, s.j, s.e, string_agg(l.line, chr(10) ORDER BY l.j) AS content
    FROM shortest s JOIN lines l ON l.doc_id = s.doc_id AND l.j BETWEEN s.j AND s.e GROUP BY ALL),
ordered AS (
    SELECT doc_id, j, e, row_number() OVER (PARTITION BY content ORDER BY doc_id, j) AS nth FROM named),
gone AS (
    SELECT DISTINCT l.doc_id, l.pos FROM ordered o
    JOIN lines l ON l.doc_id = o.doc_id AND l.j BETWEEN o.j AND o.e WHERE o.nth > 1),
kept_long AS (
    SELECT c.doc_id, string_agg(c.line, chr(10) ORDER BY c.pos) AS text,
           bool_or(regexp_matches(c.line, '[^\x20\x09-\x0D]')) AS has_words
    FROM cut c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.pos = g.pos WHERE g.pos IS NULL GROUP BY c.doc_id),
shared AS (  -- runs of 1, 2, 3, ... lines that start twice or more
    SELECT doc_id, j, 1 AS m, md5(line) AS h, row_number() OVER (PARTITION BY line ORDER BY doc_id, j) AS nth
    FROM lines QUALIFY count(*) OVER (PARTITION BY line) > 1
    UNION ALL
    SELECT doc_id, j, m, h, row_number() OVER (PARTITION BY h ORDER BY doc_id, j) AS nth
    FROM (SELECT s.doc_id, s.j, s.m + 1 AS m, md5(s.h || l.line) AS h
          FROM shared s JOIN lines l ON l.doc_id = s.doc_id AND l.j = s.j + s.m)
    QUALIFY count(*) OVER (PARTITION BY h) > 1),
later AS (SELECT doc_id, j, max(m) AS m FROM shared WHERE nth > 1 GROUP BY doc_id, j),
maximal AS (
    SELECT doc_id, j, m FROM later
    QUALIFY j + m > coalesce(max(j + m) OVER (PARTITION BY doc_id ORDER BY j
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)),
upto AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY j) AS t FROM lines),
copies AS (
    SELECT c.doc_id, count(*) AS n, max(c.m) AS longest,
           string_agg(a.pos || ':' || (b.pos + 1) || ':' || (b.t - a.t + a.words), ',' ORDER BY c.j) AS spans
    FROM maximal c JOIN upto a ON a.doc_id = c.doc_id AND a.j = c.j
    JOIN upto b ON b.doc_id = c.doc_id AND b.j = c.j + c.m - 1 GROUP BY c.doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INT) AS n_lines, CAST(coalesce(k.n, 0) AS INT) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN
           sha256(CASE WHEN k.n > 0 AND NOT k.has_words THEN '' ELSE coalesce(k.text, '') END) END AS kept_sha256,
       CAST(coalesce(c.n, 0) AS INT) AS n_copies, CAST(coalesce(c.longest, 0) AS INT) AS longest,
       coalesce(c.spans, '') AS copies, CAST(coalesce(g.n, 0) AS INT) AS n_removed_long,
       CASE WHEN d.text IS NOT NULL THEN
           sha256(CASE WHEN g.n > 0 AND NOT coalesce(l.has_words, false) THEN ''
                  ELSE coalesce(l.text, '') END) END AS kept_long_sha256
FROM documents d
LEFT JOIN kept k ON d.doc_id = k.doc_id
LEFT JOIN copies c ON d.doc_id = c.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON d.doc_id = g.doc_id
LEFT JOIN kept_long l ON d.doc_id = l.doc_id
"""


@query("op9_line_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without every later copy of a line, the maximal runs that are copies
    (first line, line behind the last, words), and without those of ten words or
    more alone."""
    out = line_dedup(C.read(spark, sf_dir, "documents").select("doc_id", "text"), min_lines=1, long_words=10)
    spans = F.transform("line_runs.copies", lambda c: F.concat_ws(":", c["start"], c["end"], c["words"]))

    def told(text: str):
        return F.sha2(F.col(text).cast("binary"), 256)

    return out.select("doc_id", "line_runs.n_lines", "line_runs.n_removed",
                      told("line_runs.clean_text").alias("kept_sha256"),
                      F.size("line_runs.copies").alias("n_copies"), "line_runs.longest",
                      F.array_join(spans, ",").alias("copies"), F.col("line_runs.long.n_removed").alias("n_removed_long"),
                      told("line_runs.long.clean_text").alias("kept_long_sha256"))


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, label_grades(C.read(spark, sf_dir, "labels")), GRADES)
    out = rate(docs, model)
    return out.select("doc_id", F.col("rating.expected").alias("expected_grade"),
                      F.col("rating.tail")[0].alias("p_harmless"), F.col("rating.tail")[1].alias("p_good"),
                      accepted(F.col("rating")).alias("accepted"))


@query("op4_personal_data")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_personal_data(C.read(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("personal_data")

    def told(some):
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind):
        return F.filter(spans, lambda s: s["kind"] == kind)

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))
    return out.select("doc_id", *counts, F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
                      told(spans).alias("spans"))


OP5_SQL = r"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
digits AS (
    SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS BIGINT) >> (5 * (3 - k % 4))) & 31 AS INT), 1),
               '' ORDER BY k) AS d
    FROM (SELECT DISTINCT h FROM p), range(32) t(k) GROUP BY h),
best AS (SELECT h, max(page_id) AS best FROM p GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM p JOIN best USING (h) JOIN digits USING (h)
"""


@query("op5_warc", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = through_archives(C.read(spark, sf_dir, "pages"), least_bytes=0)
    return out.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast("long").alias("refers_to"))


@query("op7_nearest")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(C.read(spark, sf_dir, "embeddings"), every=20, k=20)


@query("op10_chat")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled turns as raw transcripts, parsed again without their roles."""
    pieces = as_transcripts(C.read(spark, sf_dir, "conversations"))
    model = train_chat(pieces, piece="piece")
    return parse_transcripts(pieces.drop("role"), model)


@query("op11_main_text")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_main_text(C.read(spark, sf_dir, "pages").select("page_id", "url", "html"), result="main")
    return out.select("page_id", "url", F.col("main").alias("text"), F.length("main").cast("long").alias("n_chars"))


OP12_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
corpus AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d),
size AS (SELECT doc_id, 100 - 25 + (25 * len(terms) * n_docs) // n_terms AS m FROM d, corpus WHERE len(terms) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
weight AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, corpus GROUP BY term),
item AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
score AS (
    SELECT item_id, doc_id, CAST(sum(n * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM (SELECT item_id, term, count(*) AS n FROM item GROUP BY ALL) JOIN weight USING (term)
    JOIN tf USING (term) JOIN size USING (doc_id) GROUP BY ALL),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op12_ranked_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search(docs, C.read(spark, sf_dir, "benchmark"), k=20)


OP13_SQL = r"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_sum(list_transform(list_zip(a.c, b.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0),
positive AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pair WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negative AS (
    SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, other_id) AS rank
    FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = C.read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return mine_hard_negatives(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256.0)
