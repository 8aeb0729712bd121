"""Materialise every stage: ``python -m tillroll --sf-dir DIR --database DB``.

Prints one JSON line per published table (table, row_count, columns).
"""

from __future__ import annotations

import argparse
import json
import os

from tillroll.plans.publish import run_all
from tillroll.session import build_session, size_shuffles


def _local_bytes(folder: str) -> int | None:
    """Total size of a local source folder (None for remote storage)."""
    if "://" in folder and not folder.startswith("file://"):
        return None
    root = folder.removeprefix("file://")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs)


def main() -> None:
    ap = argparse.ArgumentParser(prog="tillroll")
    ap.add_argument("--sf-dir", required=True, help="folder with the source Parquet tables")
    ap.add_argument("--database", default="sales_pipeline")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size of the source tables, to size shuffles (measured for local folders)")
    a = ap.parse_args()
    spark = build_session(a.master)
    size = a.input_bytes if a.input_bytes is not None else _local_bytes(a.sf_dir)
    if size is not None:
        size_shuffles(spark, size)
    for r in run_all(spark, a.sf_dir, a.database):
        print(json.dumps({"table": r.table, "row_count": r.row_count, "columns": r.columns}))
    spark.stop()


if __name__ == "__main__":
    main()
