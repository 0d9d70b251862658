"""Run the queries against DuckDB from the command line: run_checks.py SF_DIR [NAME ...]."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from compare import connect, difference  # noqa: E402
from conftest import new_session  # noqa: E402

from spark_checks import ORACLES, QUERIES  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, failed = new_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, con, ORACLES[name]) if name in ORACLES else None
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    spark.stop()
