"""Write the executed physical plans (after AQE) of headline queries to
PLANS.md: usage ``python scripts/plans.py [sf_dir]``."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tributary.plans.catalog import QUERIES  # noqa: E402
from tributary.session import build_session  # noqa: E402

SHOWN = ["conversion_rate", "popular_products", "silver_full", "validate_routes",
         "scd2_history", "quality_silver"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    out = ["# Executed plans", "",
           f"Physical plans after adaptive execution, `{sf_dir}`, local[8], 8 shuffle "
           "partitions; `*(n)` marks whole-stage code generation. Generated by "
           "`scripts/plans.py`.", ""]
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        lines = [ln[:160] for ln in final.splitlines()]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
