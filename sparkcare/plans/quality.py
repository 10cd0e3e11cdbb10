"""Proof queries for data quality (W5) and the default-value row."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.defaults import add_row
from ..session import ensure_checkpoint_dir
from .registry import register

RUN_DATE = "2024-02-01"          # run date printed in the accuracy table (fixed for the proof)
ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("dq_row_count", """
SELECT CAST(10000 AS BIGINT) AS expected_min_rowcount, CAST(20000 AS BIGINT) AS expected_max_rowcount,
  count(*) AS row_count, count(*) BETWEEN 10000 AND 20000 AS meets_rowcount_expectation FROM orders""")
def q_dq_row_count(t, spark):
    """Q1: row count of orders between 10,000 and 20,000."""
    return Q.row_count_between(t["orders"], 10_000, 20_000)


@register("dq_unique", """
SELECT 'o_orderkey' AS "column", count(*) AS duplicate_values, count(*) = 0 AS is_unique
FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL
SELECT 'l_orderkey', count(*), count(*) = 0
FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)""")
def q_dq_unique(t, spark):
    """Q3: uniqueness of order keys in orders (unique) and in lineitem (not unique)."""
    return Q.column_unique(t["orders"], "o_orderkey").unionByName(Q.column_unique(t["lineitem"], "l_orderkey"))


def _orders_exp():
    return Q.Expectations(min_rows=10_000, max_rows=20_000, columns=ORDERS_COLUMNS, unique_column="o_orderkey",
                          type_column="o_totalprice", expected_type="double")


@register("dq_accuracy", """
SELECT '02/01/24' AS date_time, 'orders' AS process_name, CAST(10000 AS BIGINT) AS expected_min_rowcount,
  CAST(20000 AS BIGINT) AS expected_max_rowcount, count(*) BETWEEN 10000 AND 20000 AS meets_rowcount_expectation,
  true AS all_columns_match, count(DISTINCT o_orderkey) = count(o_orderkey) AS columns_are_unique,
  'o_totalprice' AS "column", 'double' AS column_type_expected, 'double' AS column_type_actual,
  true AS column_type_matches
FROM orders""")
def q_dq_accuracy(t, spark):
    """Q2/Q4/Q5: the one-row accuracy table of orders (one aggregate pass)."""
    return Q.accuracy_table(t["orders"], "orders", _orders_exp(), run_date=RUN_DATE)


@register("dq_suite", """
SELECT '02/01/24' AS date_time, 'orders' AS process_name, CAST(10000 AS BIGINT) AS expected_min_rowcount,
  CAST(20000 AS BIGINT) AS expected_max_rowcount, count(*) BETWEEN 10000 AND 20000 AS meets_rowcount_expectation,
  true AS all_columns_match, count(DISTINCT o_orderkey) = count(o_orderkey) AS columns_are_unique,
  'o_totalprice' AS "column", 'double' AS column_type_expected, 'double' AS column_type_actual,
  true AS column_type_matches
FROM orders
UNION ALL
SELECT '02/01/24', 'lineitem', CAST(50000 AS BIGINT), CAST(70000 AS BIGINT), count(*) BETWEEN 50000 AND 70000,
  false, count(DISTINCT l_orderkey) = count(l_orderkey), 'l_linenumber', 'bigint', 'int', false
FROM lineitem
UNION ALL
SELECT '02/01/24', 'customer', NULL, CAST(1000 AS BIGINT), count(*) <= 1000, true,
  count(DISTINCT c_custkey) = count(c_custkey), NULL, NULL, NULL, NULL
FROM customer""")
def q_dq_suite(t, spark):
    """Q6: accuracy rows for several entities in one frame."""
    ents = {"orders": t["orders"], "lineitem": t["lineitem"], "customer": t["customer"]}
    exps = {
        "orders": _orders_exp(),
        "lineitem": Q.Expectations(min_rows=50_000, max_rows=70_000, columns=["l_orderkey"],
                                   unique_column="l_orderkey", type_column="l_linenumber", expected_type="bigint"),
        "customer": Q.Expectations(max_rows=1_000, columns=["c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                            "c_mktsegment"], unique_column="c_custkey"),
    }
    return Q.run_suite(ents, exps, run_date=RUN_DATE)


@register("concat_parquet", """
SELECT '02/01/24' AS date_time, 'lineitem' AS process_name, CAST(50000 AS BIGINT) AS expected_min_rowcount,
  CAST(70000 AS BIGINT) AS expected_max_rowcount, count(*) BETWEEN 50000 AND 70000 AS meets_rowcount_expectation,
  true AS all_columns_match, count(DISTINCT line_key) = count(line_key) AS columns_are_unique,
  'l_extendedprice' AS "column", 'double' AS column_type_expected,
  CASE typeof(any_value(l_extendedprice)) WHEN 'DOUBLE' THEN 'double' END AS column_type_actual,
  typeof(any_value(l_extendedprice)) = 'DOUBLE' AS column_type_matches
FROM (SELECT l_orderkey * 8 + l_linenumber AS line_key, * FROM lineitem)""")
def q_concat_parquet(t, spark):
    """Two extracts of lineitem concatenated, written as Parquet, read back, checked."""
    li = t["lineitem"].select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_key"),
                              "l_returnflag", "l_quantity", "l_extendedprice")
    parts = [li.where(F.col("l_returnflag") == "R"), li.where(F.col("l_returnflag") != "R")]
    exp = Q.Expectations(min_rows=50_000, max_rows=70_000, unique_column="line_key", type_column="l_extendedprice",
                         expected_type="double", columns=["l_quantity", "line_key", "l_returnflag", "l_extendedprice"])
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    return Q.checked_concat(parts, path, "lineitem", exp, run_date=RUN_DATE)


_DEFAULT_SRC_SQL = """SELECT o_orderkey AS order_id, o_custkey AS cust_no, o_orderstatus AS status_cd,
  o_totalprice AS total_amt, o_orderpriority AS priority_txt, CAST(o_orderdate AS DATE) AS order_dt,
  o_orderdate AS order_ts, CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS open_flg,
  o_orderpriority AS comment, CAST(o_orderkey % 7 AS INTEGER) AS line_cnt, CAST(o_custkey % 4 AS INTEGER) AS ship_type,
  o_totalprice / 1000 AS price_ratio, CAST(o_totalprice AS DECIMAL(12,2)) AS disc_amt,
  CAST(o_totalprice - 100 * floor(o_totalprice / 100) AS DECIMAL(10,2)) AS fee,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' ELSE 'N' END AS rush_yn,
  o_orderstatus = 'O' AS is_open, CAST(o_totalprice AS FLOAT) AS weight
FROM orders"""


def _default_src(t):
    o = t["orders"]
    return o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_no"),
        F.col("o_orderstatus").alias("status_cd"), F.col("o_totalprice").alias("total_amt"),
        F.col("o_orderpriority").alias("priority_txt"), F.col("o_orderdate").cast("date").alias("order_dt"),
        F.col("o_orderdate").alias("order_ts"),
        F.when(F.col("o_orderstatus") == "O", "Y").otherwise("N").alias("open_flg"),
        F.col("o_orderpriority").alias("comment"), (F.col("o_orderkey") % 7).cast("int").alias("line_cnt"),
        (F.col("o_custkey") % 4).cast("int").alias("ship_type"),
        (F.col("o_totalprice") / 1000).alias("price_ratio"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("disc_amt"),
        (F.col("o_totalprice") - 100 * F.floor(F.col("o_totalprice") / 100)).cast("decimal(10,2)").alias("fee"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Y").otherwise("N").alias("rush_yn"),
        (F.col("o_orderstatus") == "O").alias("is_open"), F.col("o_totalprice").cast("float").alias("weight"))


@register("default_row", f"""
{_DEFAULT_SRC_SQL}
UNION ALL
SELECT -1, -1, '~', 0.0, '~', DATE '9999-01-01', TIMESTAMP '9999-01-01 00:00:00', 'N', 'Not Available', 0, -1,
  -0.9999, CAST(0.00 AS DECIMAL(12,2)), CAST(-1.00 AS DECIMAL(10,2)), 'N', NULL, NULL""")
def q_default_row(t, spark):
    """Orders-derived frame plus its default-value row (type x suffix grid)."""
    return add_row(_default_src(t))
