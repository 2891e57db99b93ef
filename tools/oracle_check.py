"""Local stand-in for the driver's correctness gate.

Runs each registered query in Spark and its oracle SQL in DuckDB on the same
parquet tables; compares column names, row counts, types (mapped) and the
sorted rows (floats rounded to 6 significant places).

    python tools/oracle_check.py [sf_dir] [name-substring ...]
    ORACLE_EXTRA_CONF='{"spark.sql.ansi.enabled": "false"}' python tools/oracle_check.py
    ORACLE_EXACT=1 python tools/oracle_check.py      # doubles compared bit for bit
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from shelfscope.fixtures import TABLES  # noqa: E402
from shelfscope.registry import load_all  # noqa: E402
from shelfscope.session import local_session  # noqa: E402

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
    "tinyint": "TINYINT", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


EXACT = os.environ.get("ORACLE_EXACT") == "1"  # compare doubles bit for bit


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, v if EXACT else float(f"{v:.9g}"))
    if isinstance(v, decimal.Decimal):
        return (1, float(f"{float(v):.9g}"))
    if isinstance(v, bool):
        return (2, int(v))
    if isinstance(v, int):
        return (1, float(v)) if abs(v) < 2**53 else (1, v)
    if isinstance(v, (dt.datetime, dt.date)):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, str([norm(x) for x in v]))
    return (5, str(v))


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    filters = [a for a in sys.argv[1:] if not a.startswith("/")]
    import json
    extra = json.loads(os.environ.get("ORACLE_EXTRA_CONF", "{}"))  # e.g. other session settings
    spark = local_session(extra=extra)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = skipped = 0
    for name, e in load_all().items():
        if filters and not any(f in name for f in filters):
            continue
        t0 = time.time()
        try:
            sdf = e.fn(spark, sf_dir)
            s_types = [(f.name, f.dataType.simpleString()) for f in sdf.schema.fields]
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if e.oracle is None:
            print(f"rows {name}: {len(s_rows)} rows (no oracle) {ts:.1f}s")
            skipped += 1
            continue
        try:
            rel = con.sql(e.oracle)
            d_cols = rel.columns
            d_types = [str(x) for x in rel.types]
            d_rows = rel.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(ex)[:400]}")
            bad += 1
            continue
        problems = []
        s_cols = [n for n, _ in s_types]
        if sorted(s_cols) != sorted(d_cols):
            problems.append(f"columns spark={s_cols} duck={d_cols}")
        else:
            dmap = dict(zip(d_cols, d_types))
            for n, st in s_types:
                want = SPARK_TO_DUCK.get(st, st.upper())
                if dmap[n] != want:
                    problems.append(f"type {n}: spark {st} duck {dmap[n]}")
            if len(s_rows) != len(d_rows):
                problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
            else:
                order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
                d_idx = {c: i for i, c in enumerate(d_cols)}
                sr = sorted(tuple(norm(r[i]) for i in order) for r in s_rows)
                dr = sorted(tuple(norm(r[d_idx[s_cols[i]]]) for i in order) for r in d_rows)
                diff = [(a, b) for a, b in zip(sr, dr) if a != b]
                if diff:
                    problems.append(f"{len(diff)} differing rows, first: spark={diff[0][0]} duck={diff[0][1]}")
        if problems:
            bad += 1
            print(f"FAIL {name} ({len(s_rows)} rows, {ts:.1f}s): " + "; ".join(problems)[:1500])
        else:
            ok += 1
            print(f"ok   {name}: {len(s_rows)} rows {ts:.1f}s")
    print(f"== ok {ok}  fail {bad}  rows-only {skipped}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
