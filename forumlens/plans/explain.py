"""Print the physical plan tree of registered queries.

    python -m forumlens.plans.explain /root/testdata/sf0.1 [--at-scale] name ...

``--at-scale`` turns broadcasts off (size checks fail, Spark's threshold is
off), which is the plan shape the queries take on inputs too large to
broadcast.
"""

from __future__ import annotations

import contextlib
import io
import sys


def plan_tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0].strip()


def main(argv: list[str]) -> int:
    from .. import session
    from ..operators import guards
    from .registry import all_queries
    args = argv[1:]
    at_scale = "--at-scale" in args
    args = [a for a in args if a != "--at-scale"]
    sf_dir, names = args[0], args[1:]
    spark = session.build_session()
    if at_scale:
        guards.MAX_BROADCAST_ROWS = 0
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    q = all_queries()
    for name in names:
        print(f"### {name}{' (at scale)' if at_scale else ''}\n")
        print(plan_tree(q[name](spark, sf_dir)))
        print()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
