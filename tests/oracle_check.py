"""Run registered queries and their oracle SQL side by side: ``oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPENT = [0.0]
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "VARCHAR": "string",
    "DOUBLE": "double", "FLOAT": "float", "DATE": "date", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>", "INTEGER[]": "array<int>",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, sql) -> str | None:
    """None when equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    got_types = dict(df.dtypes)
    rel = con.sql(sql)
    want_types = {
        n: SPARK_TYPES.get(str(t), str(t).lower().replace(" ", "")) for n, t in
        zip(rel.columns, rel.types)
    }
    if got_types != want_types:
        diff = {k: (got_types.get(k), want_types.get(k)) for k in {*got_types, *want_types}
                if got_types.get(k) != want_types.get(k)}
        return f"schema (spark, oracle): {diff}"
    begin = time.time()
    collected = df.collect()
    SPENT[0] = time.time() - begin
    got = rows_of(df.columns, collected)
    want = rows_of(rel.columns, rel.fetchall())
    if got != want:
        there, here = set(want), set(got)
        extra = [r for r in got if r not in there][:2]
        lack = [r for r in want if r not in here][:2]
        return f"rows {len(got)} vs {len(want)}; only spark {extra}; only oracle {lack}"
    if not got:
        return "EMPTY"
    return None


def main(argv):
    import __spark_entry__ as e
    from conftest import make_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(sf_dir)
    queries, oracle = e.queries(), e.oracle_sql()
    names = argv[1:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                res = compare(spark, con, sf_dir, queries[name], oracle[name])
            else:
                res = f"no oracle, {queries[name](spark, sf_dir).count()} rows"
        except Exception as err:  # report and go on
            res = f"{type(err).__name__}: {str(err)[:1500]}"
        bad += res is not None
        print(f"{name:32s} {time.time() - start:6.1f}s spark {SPENT[0]:5.1f}s {'ok' if res is None else res}", flush=True)
    print("not ok:", bad, "of", len(names))


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main(sys.argv[1:])
