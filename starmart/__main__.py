"""Command line: load the models and run reports.

    python -m starmart list
    python -m starmart run q3_corrected --data /root/testdata/sf0.01 [--show 20]
    python -m starmart explain q3_star --data /root/testdata/sf0.01
    python -m starmart export --data /root/testdata/sf0.01 --out /shared/mart

``run`` prints the first rows of a registered query, ``explain`` its formatted
physical plan, ``export`` writes the staged source tables and the star mart
(one Parquet directory per table) to ``--out``.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("--data", default="/root/testdata/sf0.01")
        p.add_argument("--show", type=int, default=20)
    p = sub.add_parser("export")
    p.add_argument("--data", default="/root/testdata/sf0.01")
    p.add_argument("--out", required=True)
    a = ap.parse_args(argv)

    from .plans import registry
    qs = registry.queries()
    if a.cmd == "list":
        print("\n".join(sorted(qs)))
        return 0

    from .session import get_spark
    spark = get_spark()
    if a.cmd == "export":
        from .plans import catalog
        from .sources.store import write_table
        for prefix, tables in (("source", catalog.sources(spark, a.data)), ("mart", catalog.mart(spark, a.data))):
            for name, df in tables.items():
                if not name.endswith("_stored"):
                    write_table(df, f"{a.out.rstrip('/')}/{prefix}/{name}")
        return 0
    if a.query not in qs:
        print(f"unknown query {a.query!r}; try: python -m starmart list", file=sys.stderr)
        return 2
    df = qs[a.query](spark, a.data)
    if a.cmd == "explain":
        df.explain("formatted")
    else:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
