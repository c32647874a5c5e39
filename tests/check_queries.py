"""Run registered queries against DuckDB: ``python tests/check_queries.py SF_DIR [name-prefix ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from oracle import compare, connect

import __spark_entry__ as entry_points
from brightloom.session import get_session


def main() -> int:
    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = get_session(cpus="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            got = fn(spark, sf).toArrow()
            dt = time.time() - t0
            if name in oracles:
                problems = compare(got, con.execute(oracles[name]).to_arrow_table())
            else:
                problems = [] if got.num_rows else ["no rows"]
        except Exception as e:
            dt = time.time() - t0
            msg = str(e)
            problems = [f"{type(e).__name__}: {msg[:700]}"]
            if not msg:
                traceback.print_exc()
        bad += bool(problems)
        tag = "FAIL" if problems else ("ok  " if name in oracles else "rows")
        print(f"{tag} {name} {dt:.2f}s", *(problems or []), sep="\n      " if problems else " ", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
