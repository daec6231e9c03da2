"""Print the final (AQE) physical plan and scan details of registered queries.

Usage: python scripts/show_plans.py [sf_dir] name [name ...] [--no-broadcast]

``--no-broadcast`` sets both broadcast thresholds to -1 to show the plan a
cluster gets once the dimensions outgrow them.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from creamery.queries import QUERIES  # noqa: E402
from creamery.session import local_session  # noqa: E402


def main():
    args = sys.argv[1:]
    no_bcast = "--no-broadcast" in args
    args = [a for a in args if a != "--no-broadcast"]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    extra = {}
    if no_bcast:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = local_session(master="local[8]", shuffle_partitions=16, extra=extra)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        print(f"===== {name}")
        final = plan.split("== Final Plan ==")[-1].split("+- == Initial Plan ==")[0] if "Final Plan" in plan else plan
        print(final.rstrip())
        for line in plan.splitlines():
            if re.match(r"\s*(ReadSchema|PushedFilters|Location)", line):
                print("   ", line.strip()[:160])


if __name__ == "__main__":
    main()
