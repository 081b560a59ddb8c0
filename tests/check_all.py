"""python tests/check_all.py [directory] [name...]: every query against its SQL, with times."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as e
from tests.compare import connect, difference
from tidemart.session import local_session

directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(e.queries())
spark = local_session()
con = connect(directory)
sql = e.oracle_sql()
bad = 0
for name in names:
    start = time.time()
    try:
        df = e.queries()[name](spark, directory)
        if name in sql:
            result = difference(df, con, sql[name]) or "ok"
        else:
            result = f"ok (no SQL), {df.count()} rows"
    except Exception as error:  # noqa: BLE001
        result = f"ERROR {str(error)[:1500]}"
    bad += not result.startswith("ok")
    print(f"{name:26s} {time.time() - start:6.2f}s {result[:1800]}", flush=True)
print("bad:", bad)
sys.exit(bool(bad))
