"""Run registered queries against their oracle: python tests/run_oracle.py [sf_dir] [names...]"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from quarry.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or sorted(qs)):
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in orc:
                probs = compare(df, con, orc[name])
            else:
                probs = [] ; n = df.count(); print(f"   rows-only {name}: {n} rows")
        except Exception as exc:  # report and continue
            probs = [f"error {type(exc).__name__}: {str(exc)[:400]}"]
        status = "OK " if not probs else "BAD"
        bad += bool(probs)
        print(f"{status} {name:28s} {time.time()-t:6.1f}s {'; '.join(probs)}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")


if __name__ == "__main__":
    main()
