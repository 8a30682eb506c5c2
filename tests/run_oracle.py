"""Run all (or named) queries against their SQL: python -m tests.run_oracle [sf] [names...]"""

import sys
import time

sys.path.insert(0, ".")

from __spark_entry__ import ALL_QUERIES as QUERIES, ALL_SQL as ORACLE  # noqa: E402
from brinemark.session import build_session  # noqa: E402
from tests.compare import difference, duck, rows_of_duck, rows_of_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in names:
        t = time.time()
        try:
            ours = rows_of_spark(QUERIES[name](spark, sf_dir))
            took = time.time() - t
            if name not in ORACLE:
                print(f"{name:28s} rows-only {len(ours[1]):7d} {took:6.2f}s")
                continue
            verdict = difference(ours, rows_of_duck(con, ORACLE[name]))
            print(f"{name:28s} {'OK' if verdict is None else 'DIFF'} {len(ours[1]):7d} {took:6.2f}s {verdict or ''}", flush=True)
        except Exception as e:  # report and go on with the next query
            print(f"{name:28s} ERROR {str(e)[:600]}", flush=True)


if __name__ == "__main__":
    main()
