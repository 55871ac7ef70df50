"""Scans, checkpoints and looks at tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.base import RAW, Entries, raw_reviews, table
from stayscope.operators.quality import null_counts
from stayscope.sources import (
    column_types,
    head_rows,
    load_checkpoint,
    read_table,
    save_checkpoint,
    shape,
    shared_folder,
)

entries = Entries()


def _fresh_folder(spark):
    return f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"


ORDERS = """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
o_orderdate string, o_orderpriority string"""


@entries.add(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""
)
def csv_scan(spark, sf_dir):
    """Orders written as compressed CSV and scanned with a declared schema."""
    folder = _fresh_folder(spark)
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders.write.csv(folder, header=True, compression="gzip")
    return read_table(spark, folder, ORDERS, compressed_parts=8)


@entries.add("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def tab_separated_scan(spark, sf_dir):
    """Suppliers written and scanned as tab-separated text."""
    folder = _fresh_folder(spark)
    table(spark, sf_dir, "supplier").write.csv(folder, header=True, sep="\t")
    schema = T.StructType.fromDDL("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    return read_table(spark, folder, schema, sep="\t")


@entries.add("SELECT c_custkey, c_name, c_acctbal FROM customer")
def checkpoint_round_trip(spark, sf_dir):
    """Customers saved under a name, overwritten and read back."""
    folder = _fresh_folder(spark)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    save_checkpoint(customer.select("c_custkey"), folder, "customer")
    save_checkpoint(customer, folder, "customer")
    return load_checkpoint(spark, folder, "customer")


@entries.add(
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"""
)
def preview_rows(spark, sf_dir):
    """First rows in a stated order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return head_rows(orders, 20, [F.desc("o_totalprice"), "o_orderkey"])


@entries.add("SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def table_shape(spark, sf_dir):
    """Rows and columns of the line items."""
    return shape(table(spark, sf_dir, "lineitem"))


_TYPES = {
    "Additional_Number_of_Scoring": "int",
    "Average_Score": "double",
    "Hotel_Name": "string",
    "Negative_Review": "string",
    "Reviewer_Score": "double",
    "Total_Number_of_Reviews": "int",
    "lat": "string",
}


@entries.add(
    f"WITH {RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) FILTER ({c} IS NULL) AS nulls FROM raw"
        for c, t in _TYPES.items()
    )
)
def column_profile(spark, sf_dir):
    """Type and NULLs of each column."""
    reviews = raw_reviews(spark, sf_dir).select(*_TYPES)
    return column_types(reviews).join(null_counts(reviews), "column")
