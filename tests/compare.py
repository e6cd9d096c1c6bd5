"""Run registered queries and their SQL side by side: python tests/compare.py <sf_dir> [names...]"""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    rel = con.execute(sql)
    cols = [c[0] for c in rel.description]
    want = rel.fetchall()
    t2 = time.time()
    a, b = rows(df.columns, got), rows(cols, want)
    same = sorted(cols) == sorted(df.columns) and a == b
    types = {c[0]: str(c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    note = f"{name:26s} {'ok ' if same else 'BAD'} rows {len(a)}/{len(b)} spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s"
    spark_types = dict(df.dtypes)
    pairs = {c: (spark_types.get(c), types.get(c)) for c in cols}
    known = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT"}
    odd = {c: p for c, p in pairs.items() if known.get(p[0]) != p[1]}
    if odd:
        note += f" types {odd}"
    if not same:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        note += f"\n   {sorted(df.columns)} {sorted(cols)}\n   first differences {bad}"
    return same, note


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sys.argv[1])
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        try:
            print(compare(spark, con, name, query, oracles[name], sys.argv[1])[1], flush=True)
        except Exception as e:
            print(name, "FAILED", type(e).__name__, str(e)[:900], flush=True)
