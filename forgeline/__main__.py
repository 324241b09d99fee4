"""Run a registered query and write its result (A3 sink).

    python -m forgeline q_sensor_clean --sf /data/sf0.1 --out /data/out/clean --format csv
    python -m forgeline --list
"""
from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="forgeline")
    ap.add_argument("query", nargs="?")
    ap.add_argument("--sf", help="folder with the input tables")
    ap.add_argument("--out", help="output folder")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    ap.add_argument("--partition-by", nargs="*", default=None)
    ap.add_argument("--list", action="store_true")
    a = ap.parse_args(argv)
    from .plans.catalog import QUERIES
    if a.list or not a.query:
        print("\n".join(sorted(QUERIES)))
        return 0
    if a.query not in QUERIES or not a.sf or not a.out:
        ap.error("a registered query name, --sf and --out are required")
    from .session import get_session
    from .sources.io import write_table
    spark = get_session()
    write_table(QUERIES[a.query](spark, a.sf), a.out, a.format, a.partition_by)
    return 0


if __name__ == "__main__":
    sys.exit(main())
