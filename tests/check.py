"""``python tests/check.py [sf] [name ...]``: compare registered queries with their SQL."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

import oracle  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from retailtide.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark = build_session(
        "check", "local[8]", "UTC", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    sqls = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                rows = oracle.compare(query, sqls[name], spark, con, sf_dir)
                state = "match"
            else:
                rows, state = query(spark, sf_dir).count(), "rows only"
            print(f"{name:28s} {state:10s} {rows:8d} rows {time.time() - start:6.1f}s", flush=True)
        except Exception as error:
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:1500]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()


if __name__ == "__main__":
    main()
