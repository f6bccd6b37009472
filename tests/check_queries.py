"""Runs registered queries next to their SQL twins: ``python tests/check_queries.py [dir] [names…]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tests.compare import difference, sql_frame  # noqa: E402
from weirflow.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session("check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    oracle = entry.oracle_sql()
    failed = []
    for name in names:
        start = time.time()
        try:
            got = entry.queries()[name](spark, sf_dir).toPandas()
            spent = time.time() - start
            problem = difference(got, sql_frame(sf_dir, oracle[name])) if name in oracle else "no twin"
        except Exception as error:  # noqa: BLE001 - report and go on
            got, spent, problem = [], time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'DIFF'} {name:24} rows={len(got)} {spent:.2f}s {problem or ''}", flush=True)
        if problem not in (None, "no twin"):
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
