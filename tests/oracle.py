"""Compare a Spark result with DuckDB's, as multisets of rows with columns taken by name."""

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {got.column_names} / {want.column_names}"
    names = sorted(got.column_names)
    types = [(n, got.schema.field(n).type, want.schema.field(n).type) for n in names]
    odd = [t for t in types if str(t[1]).replace("large_", "") != str(t[2]).replace("large_", "")]
    if odd:
        return f"types {odd}"
    left = Counter(zip(*[got.column(n).to_pylist() for n in names]))
    right = Counter(zip(*[want.column(n).to_pylist() for n in names]))
    if left != right:
        return (
            f"rows {got.num_rows} / {want.num_rows}; only Spark {list((left - right).items())[:3]}; "
            f"only SQL {list((right - left).items())[:3]}"
        )
    return None
