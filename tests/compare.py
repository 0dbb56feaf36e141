"""Run registered queries next to their SQL in DuckDB and compare rows."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 5) + 0.0)
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, job, sql):
    t0 = time.time()
    df = job(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if sql is None:
        return None, f"{len(got)} rows, no oracle", took
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return False, f"columns differ: spark {sorted(df.columns)} sql {sorted(cols)}", took
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        return True, f"{len(a)} rows", took
    only_a = sorted(set(a) - set(b))[:3]
    only_b = sorted(set(b) - set(a))[:3]
    return False, f"rows {len(a)} vs {len(b)} {sorted(cols)}\n   spark {only_a}\n   sql   {only_b}", took


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from paceline.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    jobs, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    for name, job in jobs.items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        try:
            ok, note, took = compare(spark, con, sf_dir, job, sqls.get(name))
        except Exception as exc:
            ok, note, took = False, f"{type(exc).__name__}: {str(exc)[:900]}", 0.0
        print(f"{'ok ' if ok else '-- ' if ok is None else 'BAD'} {name:32s} {took:6.2f}s {note}", flush=True)
        if ok is False:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")


if __name__ == "__main__":
    main(sys.argv)
