"""``python tests/check_all.py [sf] [name ...]``: compare registered queries with DuckDB, with timings."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402
from vecferry.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:]
    failed = 0
    for name, run in queries.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        begin = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                state = problem or f"ok ({df.count()} rows)"
            else:
                problem, state = "", f"rows only ({df.count()} rows)"
        except Exception as error:  # noqa: BLE001
            problem = state = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.time() - begin:6.2f}s {state}", flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))
