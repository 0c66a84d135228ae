"""Compare registered queries with their oracles: ``python -m suite.check <data folder> [names]``.

``CHECK_BROADCAST=-1`` turns broadcasts off, so the paths for large tables are checked too.
"""

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from lociweave.session import recommended_conf
from suite.inputs import BASE_TABLES
from suite.registry import ORACLES, QUERIES, run


def local_session(cores: int | str = 8, partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", partitions)
    builder = builder.config("spark.driver.memory", "8g")
    if "CHECK_BROADCAST" in os.environ:
        builder = builder.config("spark.sql.autoBroadcastJoinThreshold", os.environ["CHECK_BROADCAST"])
    for key, value in recommended_conf().items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_rows(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con.execute(sql).df()


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples with columns by name; all kinds of missing become None."""
    df = df[sorted(df.columns)]
    columns = []
    for c in df.columns:
        values = df[c].astype(object).where(df[c].notna(), None)
        columns.append([float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in values])
    return sorted(zip(*columns), key=repr)


def compare(name: str, spark: SparkSession, sf_dir: str) -> str:
    """Empty if the query matches its oracle, else what differs."""
    got = run(name, spark, sf_dir).toPandas()
    want = oracle_rows(sf_dir, ORACLES[name])
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for x, y in zip(a, b):
        if x != y:
            return f"{sorted(got.columns)}\n  got  {x}\n  want {y}"
    return "" if len(a) else "no rows"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session()
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(name, spark, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
