"""Print the physical operator tree of headline queries for plan review.

For each query: the formatted plan's operator tree, then the scan's
ReadSchema / PushedFilters lines and the number of exchanges.

    python tools/explain_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labrelay import json_values, parse_messages, table_rows  # noqa: E402
from labrelay.operators.upsert import latest_per_key  # noqa: E402
from labrelay.plans.catalog import QUERIES  # noqa: E402
from labrelay.session import local_session  # noqa: E402

DEFAULT = ["order_json", "result_json", "upsert_acks", "malformed_report"]


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def summary(text: str) -> str:
    tree, details = [], []
    in_tree = True
    for line in text.splitlines():
        if in_tree and not line.strip():
            in_tree = False
        if in_tree:
            tree.append(line)
        elif re.match(r"^(ReadSchema|PushedFilters|Output \[\d+\]: \[partition|Keys|Functions)", line):
            details.append("   " + line[:200])
    exchanges = sum("Exchange" in t for t in tree)
    return "\n".join(tree + details + [f"   exchanges: {exchanges}"])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = local_session(8, 8)
    for name in names:
        print(f"== {name}")
        print(summary(formatted(QUERIES[name](spark, sf))))
    path = os.environ.get("EXPLAIN_MESSAGES")
    if path:  # a stored message table: the production shape
        raw = spark.read.parquet(path)
        print("== stored messages -> order JSON")
        print(summary(formatted(json_values(parse_messages(raw, "order"), "order"))))
        print("== stored messages -> order upsert")
        print(summary(formatted(latest_per_key(table_rows(parse_messages(raw, "order"), "order"), "lab_order_id"))))


if __name__ == "__main__":
    main()
