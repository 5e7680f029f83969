"""Print the physical plan of registered queries (tree + scan details).

Usage: python tools/explain.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytrace.plans.queries import QUERIES  # noqa: E402
from skytrace.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()  # runs this very plan, so that its final adaptive form shows
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        tree, _, details = text.partition("\n\n\n")
        print(f"### {name}\n```")
        print(tree.strip())
        for line in details.splitlines():
            if re.match(r"^(PushedFilters|PartitionFilters|ReadSchema|Location):", line):
                print("   " + line[:200])
        print("```\n")


if __name__ == "__main__":
    main()
