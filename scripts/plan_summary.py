"""Print the shuffles, joins, windows and scans of a registered query's
executed plan (from ``explain("formatted")``).

usage: python scripts/plan_summary.py <query> [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from knnrec.plans.queries import QUERIES  # noqa: E402
from knnrec.session import build_session  # noqa: E402

NODES = ("Exchange", "BroadcastExchange", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin",
         "WindowGroupLimit", "Window", "Scan parquet", "HashAggregate", "InMemoryTableScan")


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    seen = set()
    for block in text.split("\n\n"):
        head = block.split("\n")[0]
        match = re.match(r"\(\d+\) (\S+(?: parquet)?)", head)
        if not match or match.group(1) not in NODES:
            continue
        detail = re.sub(r"#\d+L?", "", " ".join(x.strip() for x in block.split("\n")[1:5]))
        key = (match.group(1), detail)
        if key not in seen:
            seen.add(key)
            print(f"{match.group(1):20s} {detail[:220]}")


if __name__ == "__main__":
    main()
