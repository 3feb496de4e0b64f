"""Summarise every registered query's physical plan into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] [out.md]
Per query: shuffle exchanges, broadcast exchanges, partial top-1 before the
shuffle, Python evaluation nodes, and each parquet scan's pushed filters and
read-schema width.  Plans are the initial adaptive plans (before AQE's
runtime changes).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loanweave.plans.catalog import QUERIES  # noqa: E402
from loanweave.session import build_session  # noqa: E402

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "PythonUDF")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    nodes = re.findall(r"^\((\d+)\) (\w[\w ]*?)\s*$", text, flags=re.M)
    names = [n for _, n in nodes]
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", text):
        if block.startswith(tuple(f"({i}) Scan parquet" for i in range(1000))):
            loc = re.search(r"Location: \w+ \[([^\]]+)\]", block)
            pushed = re.search(r"PushedFilters: \[(.*)\]", block)
            schema = re.search(r"ReadSchema: struct<(.*)>", block)
            table = os.path.basename(loc.group(1).split(",")[0]) if loc else "?"
            columns = schema.group(1) if schema else ""
            while "<" in columns:  # fields inside a column are no columns
                columns = re.sub(r"<[^<>]*>", "", columns) if re.search(r"<[^<>]*>", columns) else columns.replace("<", "")
            width = len(re.findall(r"(?:^|,)(\w+):", columns))
            scans.append((table, pushed.group(1) if pushed else "", width))
    return {
        "exchanges": sum(1 for n in names if n == "Exchange"),
        "broadcasts": sum(1 for n in names if n == "BroadcastExchange"),
        "partial_top1": "Partial" in text and "WindowGroupLimit" in text,
        "python": any(p in text for p in PY_NODES),
        "scans": scans,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session("local[4]", shuffle_partitions=8)
    lines = [
        "# Physical plans of the registered queries", "",
        f"Generated by `tools/plan_report.py` over `{sf_dir}` (initial adaptive plans).",
        "Columns: shuffle exchanges, broadcast exchanges, partial top-1 (`WindowGroupLimit`) before",
        "the shuffle, Python evaluation in the plan, and per parquet scan: file, pushed filters,",
        "number of columns read.", "",
        "| query | shuffles | broadcasts | partial top-1 | python | scans (file: pushed filters / columns read) |",
        "| --- | --- | --- | --- | --- | --- |"]
    for name, fn in QUERIES.items():
        s = summarise(formatted(fn(spark, sf_dir)))
        scans = "<br>".join(f"{t}: {p or '—'} / {w}" for t, p, w in s["scans"])
        lines.append(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | "
                     f"{'yes' if s['partial_top1'] else '—'} | {'YES' if s['python'] else 'no'} | "
                     f"{scans} |")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
