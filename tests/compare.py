"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def canonical(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, pd.Timestamp):
            return v.isoformat().replace("T00:00:00", "") if v == v.normalize() else v.isoformat()
        if hasattr(v, "item"):
            v = v.item()
        return str(v) if not isinstance(v, (int, float, bool)) else v

    columns = sorted(df.columns)
    rows = [tuple(cell(v) for v in row) for row in df[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


def difference(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else a short description."""
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} / {sorted(duck_df.columns)}"
    a, b = canonical(spark_df), canonical(duck_df)
    if len(a) != len(b):
        return f"{len(a)} rows / {len(b)} rows"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0][0]} / {wrong[0][1]}"
    return None


def type_difference(spark_types: dict[str, str], duck_types: dict[str, str]) -> str | None:
    """Column types that do not correspond."""
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    odd = {c: (t, duck_types[c]) for c, t in spark_types.items() if same.get(t, t) != duck_types[c]}
    return f"types {odd}" if odd else None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from liftline.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, connection = local_session(8), duck(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            frame = query(spark, sf_dir)
            got = frame.toPandas()
            spent = time.time() - started
            started = time.time()
            if name in oracles:
                wanted = connection.sql(oracles[name])
                types = dict(zip(wanted.columns, map(str, wanted.types)))
                problem = difference(got, wanted.df()) or type_difference(dict(frame.dtypes), types)
            else:
                problem = "no SQL"
            print(f"{'ok ' if problem is None else 'BAD'} {name} rows={len(got)} {spent:.1f}s sql={time.time() - started:.1f}s {problem or ''}", flush=True)
        except Exception as error:  # report and go on with the next query
            problem = str(error)[:600]
            print(f"ERR {name} {problem}", flush=True)
        failed += problem is not None
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
