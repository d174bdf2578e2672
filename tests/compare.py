"""Compare a query with its SQL the way the driver does: columns by name, rows as a multiset."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def rows(frame) -> Counter:
    """Every row as a tuple of its values, columns in order of their names."""
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    return Counter(
        tuple(float(v) if isinstance(v, (int, float)) else v for v in row)
        for row in frame.itertuples(index=False))


def difference(spark, con, folder: str, query, sql: str) -> str | None:
    got, want = query(spark, folder).toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(want.columns)}"
    if want.empty:
        return "the SQL gives no rows"
    extra, lacking = rows(got) - rows(want), rows(want) - rows(got)
    if extra or lacking:
        return (f"{len(got)} rows instead of {len(want)}; extra {list(extra)[:3]}, "
                f"lacking {list(lacking)[:3]}")
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, only = sys.argv[1], sys.argv[2:]
    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    duck, oracle = connect(folder), entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        begun = time.time()
        try:
            if name in oracle:
                found = difference(session, duck, folder, query, oracle[name]) or "same"
            else:
                found = f"{query(session, folder).count()} rows, no SQL"
        except Exception as problem:
            found = "FAILED " + str(problem)[:500]
        print(f"{name}: {found} ({time.time() - begun:.1f} s)", flush=True)
