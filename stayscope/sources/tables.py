"""Delimited text tables with a declared schema, and small looks at a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
ROWS_PER_TASK = 2_000_000


def _header_order(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> T.StructType:
    """`schema` in the column order of the file, since delimited files bind by position."""
    header = spark.read.csv(path, header=True, sep=sep).columns
    missing = set(schema.names) ^ set(header)
    if missing:
        raise ValueError(f"columns of {path} and of the schema differ: {sorted(missing)}")
    return T.StructType([schema[name] for name in header])


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    compressed_parts: int | None = None,
    keep_corrupt: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Scan delimited text with a header and a declared schema, without an inference pass.

    Compressed text cannot be split, so `compressed_parts` spreads the rows right after the
    scan. `keep_corrupt` keeps the text of rows that do not fit the schema in a last column.
    With `multi_line` quoted texts may hold line breaks; each file is then read by one task.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    ordered = _header_order(spark, path, schema, sep)
    columns = schema.names
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    reader = reader.option("escape", '"').option("multiLine", multi_line)
    if keep_corrupt:
        ordered = T.StructType([*ordered.fields, T.StructField(CORRUPT, T.StringType())])
        columns = [*columns, CORRUPT]
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    table = reader.schema(ordered).csv(path).select(*columns)
    return table.repartition(compressed_parts) if compressed_parts else table


def in_file_order(scan: DataFrame, out: str = "ord") -> DataFrame:
    """Number the rows of a small lookup file, scanned in one piece, as they stand in it."""
    if scan.rdd.getNumPartitions() != 1:
        raise ValueError("only a file that is scanned in one piece has an order")
    return scan.withColumn(out, F.monotonically_increasing_id())


def spread_rows(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a plain file scan if it has fewer splits than the cluster has cores.

    A table kept as a few large row groups would otherwise be worked on by as few tasks; one
    with enough splits is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def even_rows(scan: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Deal out the rows of a plain file scan if its splits hold more than `rows` each on average.

    Files are split by their compressed bytes, and a few small whole numbers per row take few, so
    one split may hold tens of millions of rows that a task then keeps as vectors.
    """
    tasks = -(-scan.count() // rows)
    return scan.repartition(tasks) if tasks > scan.rdd.getNumPartitions() else scan


def head_rows(df: DataFrame, n: int, order_by: Sequence[Column | str]) -> DataFrame:
    """First `n` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long")
    )


def column_types(df: DataFrame) -> DataFrame:
    """One row per column: name and type."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")
