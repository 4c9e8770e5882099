"""Compare registered queries with their SQL on DuckDB: python tests/check.py [sf] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

DATA = "/root/testdata"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def database(sf_dir: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def normal(rows: list[tuple]) -> list[str]:
    def cell(x):
        return "nan" if isinstance(x, float) and math.isnan(x) else repr(x)

    return sorted("|".join(map(cell, row)) for row in rows)


def compare(db, df, sql: str) -> str | None:
    """None when columns, types and rows agree."""
    columns = sorted(df.columns)
    mine = df.select(*columns)
    found = db.sql(sql)
    if sorted(found.columns) != columns:
        return f"columns {columns} != {sorted(found.columns)}"
    theirs = found.project(", ".join(f'"{c}"' for c in columns))
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = [kinds.get(t, t) for _, t in mine.dtypes]
    if types != [str(t) for t in theirs.types]:
        return f"types {types} != {theirs.types}"
    left, right = normal([tuple(r) for r in mine.collect()]), normal(theirs.fetchall())
    if left != right:
        extra, lost = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        return f"{len(left)} rows != {len(right)} rows; only here {extra[:3]}; missing {lost[:3]}"
    return None if left else "no rows"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"{DATA}/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles = database(sf_dir), oracle_sql()
    names = sys.argv[2:] or list(queries())
    for name in names:
        begin = time.time()
        try:
            problem = compare(db, queries()[name](spark, sf_dir), oracles[name])
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:22s} {time.time() - begin:6.1f}s  {problem or 'ok'}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
