"""Run queries in Spark and DuckDB and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import ORACLES, QUERIES
from kpiloom.session import RUNTIME_CONF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    """A sortable text form; doubles to nine significant digits."""
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return f"{float(value) + 0.0:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(v) for v in value) + "]"
    return str(value)


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def column_kinds(columns, rows):
    kinds = {c: set() for c in columns}
    for r in rows:
        for c, v in zip(columns, r):
            if v is not None:
                kinds[c].add(kind(v))
    return kinds


def compare(df: DataFrame, con, sql: str) -> list[str]:
    """Differences as text; empty when both sides agree."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    cols, a = rows_of(df.columns, got)
    wcols, b = rows_of(want_cols, want)
    if cols != wcols:
        return [f"columns {cols} != {wcols}"]
    out = []
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a = sorted(set(a) - set(b))[:3]
        only_b = sorted(set(b) - set(a))[:3]
        out.append(f"spark only {only_a}\n      duckdb only {only_b}")
    ka, kb = column_kinds(df.columns, got), column_kinds(want_cols, want)
    types = {c: (ka[c], kb[c]) for c in cols if ka[c] != kb[c]}
    if types:
        out.append(f"types {types}")
    return out


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("kpiloom-checks")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config(map=RUNTIME_CONF).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark, con, bad = session(), duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                diff = compare(df, con, ORACLES[name])
                size = ""
            else:
                diff, size = [], f" rows only: {df.count()}"
        except Exception as exc:
            diff, size = [f"{type(exc).__name__}: {str(exc)[:1500]}"], ""
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - start:.1f}s{size}", *diff, sep="\n      " if diff else "", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
