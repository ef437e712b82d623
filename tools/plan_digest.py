"""Write PLANS.md: a condensed physical plan of every batch query at one scale.

Keeps the operators that decide cost (exchanges, aggregates, joins, windows, sorts,
top-k, scans with their pushed filters and read schema) and drops expression detail.
Usage: python tools/plan_digest.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillflow.plans import all_queries  # noqa: E402
from rillflow.session import local_session  # noqa: E402

KEEP = re.compile(r"Exchange|Aggregate|Join|Window|TakeOrdered|Sort |Generate|Expand|"
                  r"FileScan|BatchScan|MapIn|Union|Sample|Limit")


def digest(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    out = []
    for line in buf.getvalue().splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        if "FileScan" in line:
            head = line[:line.index("FileScan")]
            table = re.search(r"/([a-z]+)\.parquet", line)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            schema = re.search(r"ReadSchema: (\S+)", line)
            line = (f"{head}Scan {table.group(1) if table else '?'} "
                    f"pushed={pushed.group(1) if pushed else '[]'} "
                    f"read={schema.group(1) if schema else '?'}")
        else:
            line = re.sub(r"\(keys=(\[[^\]]*\]), functions=\[([^\]]*)\].*", r"(keys=\1, \2)", line)
            line = re.sub(r"windowspecdefinition\(([^)]*)\).*", r"over(\1)", line)
        out.append(line.rstrip()[:200])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    print("# Physical plans (condensed)\n")
    print(f"Batch queries at `{os.path.basename(sf_dir)}`, `local[8]`, AQE on; initial plans "
          "(AQE may still turn a sort-merge join into a broadcast at run time). Generated by "
          "`tools/plan_digest.py`.\n")
    for name, fn in all_queries().items():
        if name.endswith(("_stream", "_live", "_through_topic", "_state", "_changes", "_seek")):
            continue
        print(f"## {name}\n\n```")
        print("\n".join(digest(fn(spark, sf_dir))))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
