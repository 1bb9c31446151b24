"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [names...]"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopcube.session import get_session  # noqa: E402
from tests.harness import compare, duck  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in orc:
                r = compare(df, con, orc[name])
            else:
                r = {"spark_rows": df.count(), "oracle": None}
        except Exception as e:  # report and continue
            r = {"error": f"{type(e).__name__}: {str(e)[:600]}"}
        r["sec"] = round(time.time() - t0, 2)
        ok = r.get("exact") or (r.get("oracle", 1) is None and "error" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + name, json.dumps(r, default=str), flush=True)
    print(f"{bad} not exact")


if __name__ == "__main__":
    main()
