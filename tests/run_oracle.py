"""Compare every registered query with its SQL twin: python tests/run_oracle.py [sf_dir] [name-prefix...]"""

import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from wardflow.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
prefixes = sys.argv[2:]
spark = build_session("local[8]", shuffle_partitions=8)
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in sqls:
            ok, msg = compare(df, con, sqls[name])
        else:
            n = df.count()
            ok, msg = True, f"rows-only: {n}"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:40s} {time.time() - t:6.1f}s {msg}", flush=True)
print("FAILED:", bad)
