"""Compare a registered query with its SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, float):
        return round(v, 6)
    return v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in found)


def differences(frame, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    got = rows(frame.columns, frame.collect())
    if got != expected:
        extra, lost = got - expected, expected - got
        return (
            f"{sum(got.values())} rows against {sum(expected.values())}; only in Spark "
            f"{list(extra.items())[:3]}; only in SQL {list(lost.items())[:3]}"
        )
    types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
             [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    return (sum(got.values()), dict(zip(names, types, strict=True)))


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tieout.session import local

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = database(folder), entry.oracle_sql()
    bad = 0
    for name, q in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            frame = q(spark, folder)
            if name in sql:
                found = differences(frame, con, sql[name])
            else:
                found = (frame.count(), "rows only")
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        ok = isinstance(found, tuple)
        bad += not ok
        if ok and name in sql:
            spark_types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
            same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                    "boolean": "BOOLEAN", "date": "DATE"}
            odd = {c: (t, found[1][c]) for c, t in spark_types.items() if same.get(t) != found[1][c]}
            found = (found[0], odd or "")
        print(f"{'ok  ' if ok else 'FAIL'} {name:40s} {time.time()-start:6.2f}s {found}", flush=True)
    print(f"{bad} bad")
