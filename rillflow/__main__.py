"""Run a named query: ``python -m rillflow <query> [sf_dir] [--explain]``.

Without a query name, lists the registered queries. Shows up to 20 result rows
(``show``), or with ``--explain`` the formatted physical plan instead.
"""

from __future__ import annotations

import sys

from rillflow.plans import all_queries
from rillflow.session import local_session


def main(argv: list[str]) -> int:
    queries = all_queries()
    args = [a for a in argv if not a.startswith("--")]
    if not args or args[0] not in queries:
        print("queries:", ", ".join(sorted(queries)))
        return 0 if not args else 2
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    df = queries[args[0]](spark, sf_dir)
    if "--explain" in argv:
        df.explain("formatted")
    else:
        df.show(20, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
