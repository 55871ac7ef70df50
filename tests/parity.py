"""Run queries next to their SQL in DuckDB and compare whole results.

    python tests/parity.py /root/testdata/sf0.01 [query ...]

With PARITY_LARGE=1 nothing counts as small: no broadcast, no table ordered in one task, no
lookup written out as an expression.
"""

from __future__ import annotations

import inspect
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(sf_dir: str):
    """DuckDB with the tables as views."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _bag(frame):
    frame = frame[sorted(frame.columns)]
    return Counter(
        tuple(None if pd.isna(v) else v for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    )


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[bool, str]:
    """Whether a query and its SQL give the same columns, types and rows."""
    got = driver.queries()[name](spark, sf_dir).toPandas()
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = [c for c in got.columns if got[c].dtype.kind != want[c].dtype.kind and len(got) and not (got[c].isna().any())]
    a, b = _bag(got), _bag(want)
    if a != b:
        return False, f"{len(got)} / {len(want)} rows; only here {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
    widths = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if got[c].dtype != want[c].dtype}
    return not kinds, f"{len(got)} rows" + (f"; types differ {widths}" if widths else "")


def as_if_large(spark: SparkSession) -> None:
    """Send all operators down the ways meant for large tables."""
    from stayscope.operators import joins, ordering

    small = {
        joins.attach: "max_broadcast",
        ordering.running_totals: "one_task_rows",
        ordering.row_numbers: "one_task_rows",
        ordering.quantiles_of: "one_task_rows",
        ordering.select_groups_within: "one_task_rows",
    }
    for fn, name in small.items():
        params = [p for p in inspect.signature(fn).parameters.values() if p.default is not p.empty]
        fn.__defaults__ = tuple(0 if p.name == name else p.default for p in params)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")


def main() -> None:
    """Compare the named queries, or all."""
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(driver.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("PARITY_LARGE"):
        as_if_large(spark)
    con, bad = connect(sf_dir), []
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok ' if ok else 'BAD'} {time.time() - start:6.1f}s {name}: {note}", flush=True)
        bad += [] if ok else [name]
    print(f"{len(names) - len(bad)} of {len(names)} agree; not: {bad}")
    spark.stop()


if __name__ == "__main__":
    main()
