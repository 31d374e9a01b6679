"""Run registered queries on Spark and DuckDB and compare the rows exactly."""

import glob
import os
import sys
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    return [d[0] for d in cur.description], [str(d[1]) for d in cur.description], cur.fetchall()


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([row[i] for i in order]) for row in rows)


# Spark type names and what DuckDB calls them.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}


def type_difference(df, names, kinds) -> dict:
    duck = dict(zip(names, kinds))
    spark = {c: TYPES.get(t, t.upper().replace(" ", "")) for c, t in df.dtypes}
    return {c: (t, duck[c]) for c, t in spark.items() if t != duck[c]}


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    spark_rows = [tuple(r) for r in df.collect()]
    names, rows = normal(df.columns, spark_rows)
    duck_names, kinds, duck = duck_rows(con, sql)
    want_names, want = normal(duck_names, duck)
    if names != want_names:
        return f"columns {set(names) ^ set(want_names)}"
    if types := type_difference(df, duck_names, kinds):
        return f"types {types}"
    if len(rows) != len(want):
        return f"rows {len(rows)} vs {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    return f"{len(bad)} of {len(rows)} rows, first {names}\n  {bad[0][0]}\n  {bad[0][1]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from cdrlake.session import local_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracle:
                diff = difference(query(spark, sf_dir), con, oracle[name])
                rows = ""
            else:
                rows = query(spark, sf_dir).count()
                diff = None
        except Exception as e:
            diff, rows = f"{type(e).__name__}: {str(e)[:600]}", ""
        print(f"{'OK ' if diff is None else 'BAD'} {name} {time.time() - start:.1f}s {rows} {diff or ''}", flush=True)
