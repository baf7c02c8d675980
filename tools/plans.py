"""Write PLANS.md: the executed physical plan of every headline query.

Usage: python tools/plans.py [sf_dir] [out_file] [warehouse_dir]

Each query is run once (so AQE's final plan is shown) over the stored
warehouse, which is the production shape: multi-file Parquet tables,
filters pushed into the scans.
"""
from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()        # after execution: the final adaptive plan
    text = buf.getvalue().replace("== Physical Plan ==", "").strip()
    # keep the final adaptive plan; drop expression ids, plan ids and paths
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    text = re.sub(r"InMemoryFileIndex\(1 paths\)\[[^\]]*\]?", "<warehouse table>", text)
    return text.strip()


def main() -> None:
    from laborstar.plans.pipeline import load_tables
    from laborstar.plans.reports import reports
    from laborstar.session import get_session
    from laborstar.sources.fixtures import Warehouse
    from laborstar.sources.warehouse import StoredWarehouse

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    parent = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="laborstar-plans-")
    wh_dir = f"{parent.rstrip('/')}/warehouse-{uuid.uuid4().hex}"
    load_tables(spark, Warehouse.of(spark, sf_dir).raw, wh_dir, as_of="2024-01-01")
    rep = reports(StoredWarehouse(spark, wh_dir), profile_code="15-1002.00")
    lines = ["# Executed plans of the reports", "",
             f"Generated by `tools/plans.py` over a warehouse loaded from `{sf_dir}` (`local[8]`, AQE on).",
             "Final adaptive plans, expression ids removed.", ""]
    for name, df in rep.items():
        lines += [f"## {name}", "", "```", final_plan(df), "```", ""]
    with open(out, "w") as f:
        f.write("\n".join(lines))
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
