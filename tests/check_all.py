"""Run queries against their SQL: check_all.py FOLDER [NAME ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import harness  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from skyweave.session import build_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = harness.connect(folder)
    oracles = contract.oracle_sql()
    bad = 0
    for name, fn in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                found = harness.differences(df, con, oracles[name])
                size = len(con.sql(oracles[name]).fetchall())
            else:
                found, size = [], df.count()
            verdict = "ok" if not found else "BAD " + "; ".join(found)
            if name not in oracles:
                verdict = "rows only"
        except Exception as error:  # report every failing query in one run
            traceback.print_exc(limit=-3)
            verdict, size, found = f"ERROR {str(error)[:1500]}", -1, ["error"]
        bad += bool(found)
        print(f"{name:28} {time.time() - start:6.2f}s {size:7d} {verdict}", flush=True)
    print("failing:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
