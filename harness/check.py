"""Run registered queries in Spark and their twins in DuckDB and compare the results cell by cell.

    python -m harness.check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(value) -> str:
    if pd.isna(value):
        return ""
    if isinstance(value, float):
        return repr(float(value))
    return str(value).removesuffix(" 00:00:00")


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    text = df[sorted(df.columns)].apply(lambda c: c.astype(object).map(cell))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def difference(mine: pd.DataFrame, twin: pd.DataFrame) -> str:
    """Empty if equal, else what differs."""
    if sorted(mine.columns) != sorted(twin.columns):
        return f"columns {sorted(mine.columns)} / {sorted(twin.columns)}"
    if len(mine) != len(twin):
        return f"rows {len(mine)} / {len(twin)}"
    kinds = {c: (str(mine[c].dtype), str(twin[c].dtype)) for c in mine.columns}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and "date" not in k[0] + k[1] and len(mine)}
    a, b = canonical(mine), canonical(twin)
    wrong = [c for c in a.columns if not a[c].equals(b[c])]
    if wrong:
        i = next(i for i in range(len(a)) if not a.loc[i].equals(b.loc[i]))
        shown = [c for c in wrong if a.loc[i, c] != b.loc[i, c]]
        return f"values in {wrong}: {a.loc[i, shown].to_dict()} / {b.loc[i, shown].to_dict()}"[:700]
    return f"types {odd}" if odd else ""


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from harness import catalog

    spark, con = session(), connect(args.sf)
    bad = 0
    for name in args.names or list(catalog.QUERIES):
        start = time.time()
        try:
            mine = catalog.QUERIES[name](spark, args.sf).toPandas()
            spent = time.time() - start
            if name in catalog.ORACLES:
                twin = con.sql(catalog.ORACLES[name]).df()
                result = difference(mine, twin)
            else:
                result = "" if len(mine) else "no rows"
        except Exception as error:
            result, spent, mine = f"{type(error).__name__}: {str(error)[:700]}", time.time() - start, ()
        bad += bool(result)
        kind = "sql " if name in catalog.ORACLES else "rows"
        print(f"{'FAIL' if result else 'ok  '} {kind} {name:28s} {len(mine):8d} rows {spent:6.2f}s "
              f"{time.time() - start - spent:6.2f}s {result}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
