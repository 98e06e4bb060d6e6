"""Print the physical plan trees of the headline queries (for PLANS.md).

    python tools/plans.py /root/testdata/sf0.1 > /tmp/plans.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["rating_histogram", "movie_features", "user_features", "item_sequences", "eval_summary"]


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.treeString()
    return "\n".join(line.rstrip() for line in text.splitlines() if line.strip())


def main():
    from recengine.plans.catalog import QUERIES
    from recengine.session import get_session

    sf = sys.argv[1]
    names = sys.argv[2:] or HEADLINE
    spark = get_session(shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    for name in names:
        df = QUERIES[name](spark, sf)
        print(f"### {name}\n```")
        print(tree(df))
        print("```\n")


if __name__ == "__main__":
    main()
