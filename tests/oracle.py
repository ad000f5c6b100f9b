"""Run registered queries on Spark and DuckDB and compare rows.

``python tests/oracle.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def data_dir(sf: str) -> str:
    return f"/root/testdata/sf{sf}"


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


KINDS = {
    "int": ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "tinyint", "smallint", "int", "bigint"),
    "float": ("DOUBLE", "FLOAT", "double", "float"),
    "text": ("VARCHAR", "string"),
    "bool": ("BOOLEAN", "boolean"),
    "time": ("TIMESTAMP", "timestamp", "timestamp_ntz"),
    "date": ("DATE", "date"),
}


def kind(type_name):
    return next((k for k, names in KINDS.items() if type_name in names), type_name)


def compare(spark_df, con, sql):
    """Message of the first difference, or ``None``; row count beside it."""
    got_names, got = rows_of(spark_df.columns, spark_df.collect())
    res = con.execute(sql)
    want_names, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}", len(got)
    kinds = {d[0]: kind(str(d[1])) for d in res.description}
    odd = [(c, t, kinds[c]) for c, t in spark_df.dtypes if kind(t) != kinds[c]]
    if odd:
        return f"types {odd}", len(got)
    if len(got) != len(want):
        extra = sorted(set(map(repr, got)) - set(map(repr, want)))[:3]
        lack = sorted(set(map(repr, want)) - set(map(repr, got)))[:3]
        return f"rows {len(got)} != {len(want)}; only spark {extra}; only sql {lack}", len(got)
    for a, b in zip(got, want):
        if a != b:
            return f"{got_names}: {a} != {b}", len(got)
    return None, len(got)


def main(argv):
    from homeload.queries import ORACLES, QUERIES
    from homeload.session import local_session

    sf = argv[0] if argv else "0.01"
    spark = local_session()
    con = connect(data_dir(sf))
    bad = 0
    for name in argv[1:] or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[name](spark, data_dir(sf))
            if name in ORACLES:
                diff, n = compare(df, con, ORACLES[name])
            else:
                diff, n = None, df.count()
        except Exception as e:  # noqa: BLE001 - reported per query
            diff, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} rows={n} {time.time() - start:.1f}s {diff or ''}"[:1500], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
