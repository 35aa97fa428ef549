"""Run queries and their SQL on the same tables and compare schema, row count and values.

``python -m tests.compare [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb

from tallymark.bindings.registry import TABLES

KINDS = {"bool": "bool", "int": "int", "float": "float", "str": "str"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def kind(dtype: str) -> str:
    d = dtype.lower()
    if d.startswith(("int", "bigint", "smallint", "tinyint", "long", "hugeint", "ubigint")):
        return "int:" + ("32" if d in ("int", "integer") else "64" if d in ("bigint", "long") else d)
    if d.startswith(("double", "float", "decimal")):
        return "float"
    if d.startswith(("varchar", "string")) or d == '"null"':
        return "text"
    return d.split("[")[0].replace("_ntz", "")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, bool) else (True, "b", v) for v in r))


def differences(df, con, sql) -> list[str]:
    got_names = df.columns
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want_kinds = {d[0]: kind(str(d[1])) for d in cur.description}
    want = cur.fetchall()
    problems = []
    if sorted(got_names) != sorted(want_names):
        return [f"columns {sorted(got_names)} != {sorted(want_names)}"]
    for f in df.schema:
        k = kind(f.dataType.simpleString())
        if k != want_kinds[f.name] and want:
            problems.append(f"type of {f.name}: {k} != {want_kinds[f.name]}")
    a, b = rows_of(got_names, df.collect()), rows_of(want_names, want)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ ({sorted(got_names)}), first {bad[0]}")
    return problems


def main() -> int:
    from tallymark import session
    from tallymark.bindings import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = session.local()
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problems = differences(df, con, ORACLES[name])
                n = ""
            else:
                problems, n = [], f" rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problems, n = [f"{type(e).__name__}: {str(e)[:600]}"], ""
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s{n} {' | '.join(problems)}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
