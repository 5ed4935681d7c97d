"""Side-by-side comparison of a Spark result and its SQL statement."""

import glob
import os

import duckdb


def open_tables(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sortable(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def differences(df, con, sql, limit=5):
    """(columns, spark rows, sql rows, first differing pairs)."""
    names = sorted(df.columns)
    spark_rows = [tuple(r[n] for n in names) for r in df.collect()]
    cur = con.execute(sql)
    sql_names = [d[0] for d in cur.description]
    where = {n: i for i, n in enumerate(sql_names)}
    if sorted(sql_names) != names:
        return f"columns differ: {sorted(set(names) ^ set(sql_names))}"
    sql_rows = [tuple(r[where[n]] for n in names) for r in cur.fetchall()]
    a, b = sorted(spark_rows, key=_sortable), sorted(sql_rows, key=_sortable)
    if len(a) != len(b):
        return f"row counts differ: spark {len(a)}, sql {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
    if bad:
        shown = []
        for x, y in bad[:limit]:
            shown.append({n: (u, v) for n, u, v in zip(names, x, y) if u != v or type(u) is not type(v)})
        return f"{len(bad)} rows differ: {shown}"
    return None
