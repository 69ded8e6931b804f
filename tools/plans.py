"""Write PLANS.md: final (adaptive) physical plans of representative queries.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.001)
Each query is collected first through the same query execution, so the plans
shown are AQE's final plans (shapes do not depend on the scale here).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SHOW = {
    "cart_position_reorder": "filter and column pruning reach the Parquet scan; partial + final aggregate",
    "top_departments": "exact distinct count as a two-level aggregate; top-k without a full sort",
    "overview": "global aggregate with a distinct count: map-side partial aggregation per user",
    "viz_top_users": "per-user aggregate, top-k",
    "flatten_order_items": "narrow ETL: parse, one cast per document, explode, inline — no shuffle",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from cartscope.registry import QUERIES
    from cartscope.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = ["# Physical plans (final adaptive plans)", "",
           f"Generated by `tools/plans.py` at `{sf}`; file locations shortened.", ""]
    for name, why in SHOW.items():
        df = QUERIES[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("+- == Initial Plan ==")[0]
        plan = re.sub(r"file:[^\]\s,]+", "<path>", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## `{name}`", "", why, "", "```", plan.rstrip()[:6000], "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
