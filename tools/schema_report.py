"""Write TABLES.md: columns and types of every mart table (per-element and
observed), taken from the query plans themselves.

Usage: python tools/schema_report.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanweave.plans.catalog import OBSERVED_QUERIES, TABLE_QUERIES  # noqa: E402
from loanweave.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[2]", shuffle_partitions=4)
    lines = ["# Output tables", "",
             "Columns and Spark types of every mart table, read from the query plans",
             "(`tools/schema_report.py`). The sink adds `extract_timestamp` (timestamp_ntz) and the",
             "partition column `extract_date` (date).", ""]
    for title, qs in (("Per-element tables", TABLE_QUERIES), ("Observed tables", OBSERVED_QUERIES)):
        lines += [f"## {title}", ""]
        for name, fn in qs.items():
            schema = fn(spark, sf_dir).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            lines += [f"**{name}** ({len(schema.fields)} columns): {cols}", ""]
    with open("TABLES.md", "w") as f:
        f.write("\n".join(lines))
    print("wrote TABLES.md")


if __name__ == "__main__":
    main()
