"""Run registered queries against their DuckDB oracle SQL and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive multiset of rows
(columns sorted by name). Values are normalized to plain Python: floats by
``repr``, timestamps as naive datetimes, dates as dates.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duckdb(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]


def arrow_types(spark_df, con, sql) -> tuple[list, list]:
    """(name, Arrow type) pairs of both results, sorted by name."""
    s = spark_df.limit(1).toArrow().schema
    d = con.sql(sql).limit(1).arrow()
    d = d.schema if hasattr(d, "schema") else d.read_all().schema
    return sorted((f.name, str(f.type)) for f in s), sorted((f.name, str(f.type)) for f in d)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    import __spark_entry__ as E

    t0 = time.time()
    s_cols, s_rows = rows_of_spark(E.queries()[name](spark, sf_dir))
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return {"name": name, "rows": len(s_rows), "oracle": None, "spark_s": round(t1 - t0, 2)}
    d_cols, d_rows = rows_of_duckdb(con, sql)
    same_vals = Counter(s_rows) == Counter(d_rows)
    s_types, d_types = arrow_types(E.queries()[name](spark, sf_dir), con, sql)
    out = {
        "name": name,
        "rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": s_cols == d_cols,
        "types_match": s_types == d_types,
        "values_match": same_vals,
        "spark_s": round(t1 - t0, 2),
    }
    if s_cols != d_cols:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    if s_types != d_types:
        out["type_diff"] = [(a, b) for a, b in zip(s_types, d_types) if a != b]
    if not same_vals:
        only_s = list((Counter(s_rows) - Counter(d_rows)).elements())[:3]
        only_d = list((Counter(d_rows) - Counter(s_rows)).elements())[:3]
        out["only_spark"], out["only_oracle"] = only_s, only_d
    return out


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = (
            r.get("values_match")
            and r.get("columns_match")
            and r.get("types_match")
            and r.get("rows") == r.get("oracle_rows")
        )
        bad += 0 if ok or r.get("oracle", 1) is None else 1
        print(("OK  " if ok else "FAIL") + " " + str(r), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
