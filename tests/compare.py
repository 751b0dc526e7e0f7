"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6f}".rstrip("0").rstrip(".")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())
