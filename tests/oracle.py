"""Compare registered queries with their SQL: ``python tests/oracle.py SF_DIR [name ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, int):
        return value
    return str(value)


def canonical(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in records), key=repr)


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def compare(spark, con, folder, fn, sql):
    """NULL when equal, else a short account of the difference."""
    df = fn(spark, folder)
    got = canonical(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    rel = con.sql(sql)
    names = rel.columns
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    want = canonical(names, rel.fetchall())
    if got == want:
        return None
    extra = [r for r in got if r not in want][:3] if len(got) < 20000 else [r for r, w in zip(got, want) if r != w][:3]
    lacking = [r for r in want if r not in got][:3] if len(want) < 20000 else [w for r, w in zip(got, want) if r != w][:3]
    return f"{len(got)} vs {len(want)} rows {sorted(names)}; spark {extra} sql {lacking}"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, fn, oracles.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {'' if name in oracles else '(rows only)'} {problem or ''}"[:1500], flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
