"""Physical-plan checks: pushdown, pruning, no Python in the hot path, caps
before collection."""

import contextlib
import io

from forumlens.plans.registry import all_queries

from conftest import SF_SMALL


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_pushed_to_scan(spark):
    p = plan(all_queries()["by_subreddit"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(source), EqualTo(source,src3)]" in p


def test_column_pruning_skips_text(spark):
    p = plan(all_queries()["report_deltas"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in p


def test_no_python_udf_in_core_queries(spark):
    q = all_queries()
    for name in ("report_deltas", "context_document", "top_comments", "upsert_posts", "letter_qa", "ingest_rss"):
        p = plan(q[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_top_k_limits_before_shuffle(spark):
    p = plan(all_queries()["top_comments"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_no_cross_or_nested_loop_joins(spark):
    """No registered query pairs rows without an equi-join key."""
    side_effects = {"letter_files", "write_pages", "ingest_letters", "ingest_listing"}
    for name, fn in all_queries().items():
        if name.startswith("stream_") or name in side_effects:
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
