"""Runs registered queries against DuckDB: ``python tests/compare.py SF_DIR [name...]``."""

from __future__ import annotations

import hashlib
import pathlib
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    """Rows as text tuples with columns by name, sorted."""

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, bool) or str(type(v).__name__) == "bool_":
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            f = float(v) if not isinstance(v, pd.Timestamp) else v
            return repr(f + 0.0)
        return str(v)

    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(cell(v) for v in row) for row in pdf.itertuples(index=False))


def rows_of_spark(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)


def rows_of_duckdb(con, sql: str) -> pd.DataFrame:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return pd.DataFrame(cur.fetchall(), columns=cols, dtype=object)


def differences(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(mine.columns) ^ set(theirs.columns))}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    a, b = canonical(mine), canonical(theirs)
    if hashlib.sha1(repr(a).encode()).digest() == hashlib.sha1(repr(b).encode()).digest():
        return None
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}"


def main(sf_dir: str, wanted: list[str]) -> int:
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            t0 = time.time()
            mine = rows_of_spark(fn(spark, sf_dir))
            t1 = time.time()
            verdict = "rows only"
            if name in oracle:
                verdict = differences(mine, rows_of_duckdb(con, oracle[name])) or "ok"
            t2 = time.time()
        except Exception as exc:  # report and go on with the next query
            verdict, t2 = f"ERROR {type(exc).__name__}: {str(exc)[:600]}", time.time()
            mine, t1 = pd.DataFrame(), t2
        if verdict not in ("ok", "rows only"):
            failed += 1
        print(f"{name:45s} {len(mine):8d} rows spark {t1 - t0:6.1f}s sql {t2 - t1:6.1f}s  {verdict[:900]}", flush=True)
    spark.stop()
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
