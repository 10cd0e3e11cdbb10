import datetime as dt
import decimal

import numpy as np
import pytest
from pyspark.sql.types import BooleanType, StringType

from sparkcare.operators import profile as P
from sparkcare.operators import quality as Q
from sparkcare.operators.combine import SchemaMismatch, concat_by_name, concat_strict
from sparkcare.operators.defaults import (add_row, assign_default_values, default_value, diagnose_object,
                                          replicate_schema)


def test_value_counts_null_handling(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert [tuple(r) for r in P.value_counts(df, "c").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in P.group_count(df, "c").collect()] == [(None, 3), ("a", 2), ("b", 1)]
    s = P.value_counts_struct(df, "c")
    assert s.columns == ["category_value", "instance_count"]
    assert [tuple(r) for r in P.top_values(df, "c", 1).collect()] == [("a", 2)]


def test_group_lists_chunks_keep_every_value(spark):
    rows = [("k", i) for i in range(25)] + [("j", 1)]
    out = P.group_lists(spark.createDataFrame(rows, "key string, v int"), "key", ["v"], chunk_size=10).collect()
    k = sorted((r.chunk_no, r.n_values) for r in out if r.key == "k")
    assert k == [(0, 10), (1, 10), (2, 5)]
    allv = sorted(int(x) for r in out if r.key == "k" for x in r["values"].split("|"))
    assert allv == list(range(25))


def test_group_arrays_keep_types_nulls_and_bars(spark):
    rows = [("k", i, f"v|{i % 3}" if i % 2 else None) for i in range(25)] + [("j", None, "a|b"), (None, 1, None)]
    df = spark.createDataFrame(rows, "key string, n int, t string")
    out = sorted(P.group_arrays(df, "key", ["n", "t"], chunk_size=10).collect(), key=lambda r: (str(r.key), r.chunk_no))
    k = [r for r in out if r.key == "k"]
    assert [(len(r.n), len(r.t), r.group_count) for r in k] == [(10, 10, 25), (10, 10, 25), (5, 5, 25)]
    assert sum((r.n for r in k), []) == list(range(25))
    assert sum((r.t for r in k), []) == [None] * 13 + sorted(t for _, _, t in rows[:25] if t)
    assert [tuple(r) for r in out if r.key == "j"] == [("j", 0, 1, [None], ["a|b"])]
    assert [tuple(r) for r in out if r.key is None] == [(None, 0, 1, [1], [None])]
    counts = P.group_value_counts(df, "key", "t", chunk_size=3).collect()
    got = {(r.key, r.chunk_no): [tuple(x) for x in r.value_counts] for r in counts}
    assert got == {("k", 0): [(None, 13), ("v|0", 4), ("v|1", 4)], ("k", 1): [("v|2", 4)],
                   ("j", 0): [("a|b", 1)], (None, 0): [(None, 1)]}


def test_profiles(spark):
    rnd = np.random.default_rng(0)
    x, y = rnd.normal(size=200), rnd.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), None if i % 10 == 0 else "t") for i, (a, b) in enumerate(zip(x, y))],
                               "x double, y double, s string")
    nc = {r.column_name: r.null_count for r in P.null_counts(df).collect()}
    assert nc == {"x": 0, "y": 0, "s": 20}
    tp = {r.column_name: (r.data_type, r.non_null, r.row_count) for r in P.table_profile(df).collect()}
    assert tp["s"] == ("string", 180, 200)
    d = {r.column_name: r for r in P.describe(df, ["x", "y"]).collect()}
    assert d["x"]["count"] == 200 and abs(d["x"].p50 - round(float(np.median(x)), 4)) < 1e-9
    assert abs(d["x"].std - round(float(np.std(x, ddof=1)), 4)) < 1e-9
    c = {(r.col_a, r.col_b): r.corr for r in P.correlation(df, ["x", "y"]).collect()}
    assert abs(c[("x", "y")] - round(float(np.corrcoef(x, y)[0, 1]), 6)) < 1e-9 and c[("x", "x")] == 1.0
    h = P.histogram(df, ["x"], bins=30).collect()
    counts, _ = np.histogram(x, bins=30)
    assert [r["count"] for r in sorted(h, key=lambda r: r.bin)] == list(counts)


def test_concat(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2, 3.0)], "a string, id int, z double")
    u = concat_by_name(a, b)
    assert u.columns == ["id", "a", "z"] and sorted(map(tuple, u.collect()), key=str) == [(1, "x", None), (2, "y", 3.0)]
    assert concat_strict(a, a).count() == 2
    with pytest.raises(SchemaMismatch):
        concat_strict(a, b)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id bigint, name string")
    rc = Q.row_count_between(df, 1, 2).first()
    assert rc.row_count == 3 and rc.meets_rowcount_expectation is False
    assert Q.column_count_between(df, 2, 2) and Q.column_set_match(df, ["name", "id"])
    assert not Q.column_set_match(df, ["id"])
    assert Q.column_type_is(df, "id", "bigint") == ("bigint", "bigint", True)
    u = Q.column_unique(df, "id").first()
    assert u.duplicate_values == 1 and u.is_unique is False
    acc = Q.accuracy_table(df, "t", Q.Expectations(min_rows=1, max_rows=5, columns=["id", "name"], unique_column="name",
                                                   type_column="id", expected_type="int"), run_date="2024-03-09").first()
    assert acc.date_time == "03/09/24" and acc.meets_rowcount_expectation and acc.all_columns_match
    assert acc.columns_are_unique and acc.column_type_actual == "bigint" and acc.column_type_matches is False
    suite = Q.run_suite({"a": df, "b": df}, {"a": Q.Expectations(max_rows=1), "b": Q.Expectations(min_rows=1)})
    assert sorted((r.process_name, r.meets_rowcount_expectation) for r in suite.collect()) == [("a", False), ("b", True)]


def test_default_values_reference_cases(spark):
    for pairs in ([(StringType(), "name")], [(BooleanType(), "project")], [(StringType(), "options_ts")]):
        assert assign_default_values(pairs) == ("Not Available",)
    df = spark.createDataFrame([(1, "a"), (2, "b")], ["id", "name"])
    assert diagnose_object(df) == df.schema
    assert [(t.simpleString(), s) for t, s in replicate_schema(df)] == [("bigint", "id"), ("string", "name")]


def test_default_row_grid(spark):
    ddl = ("a_flg string, b_cd string, c_txt string, d int, e_cnt int, f_type int, g_type bigint, h_amt double, "
           "i_no double, j double, k_amt decimal(10,2), l_id decimal(10,2), m decimal(10,2), n_ts timestamp_ntz, "
           "o timestamp, p_dt date, q date, r boolean, s float")
    df = spark.createDataFrame([], ddl)
    row = add_row(df).first()
    assert tuple(row)[:10] == ("N", "~", "~", -9999, 0, -1, -9999, 0.0, -1.0, -0.9999)
    assert row.k_amt == decimal.Decimal("0.00") and row.l_id == decimal.Decimal("-1.10")
    assert row.m == decimal.Decimal("-1.00")
    assert row.n_ts == dt.datetime(9999, 1, 1) and row.o.year == 1111
    assert row.p_dt == dt.date(9999, 1, 1) and row.q == dt.date(1111, 1, 1)
    assert row.r is None and row.s is None
    assert default_value(BooleanType(), "x") == "Not Available"
    # appending twice adds twice unless asked to skip a present row
    two = add_row(add_row(df))
    assert two.count() == 2 and add_row(add_row(df), skip_if_present=True).count() == 1


def test_values_are_not_dealt_by_group(spark):
    """Two groups: dealt by group, all values would meet in two tasks."""
    from pyspark.sql import functions as F
    from sparkcare.operators.ranking import exact_quantiles
    df = spark.range(60_000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        q = exact_quantiles(df, "v", [0.25, 0.5], ["g"])
        plan = q._jdf.queryExecution().executedPlan().toString()
        got = {(r.g, r.prob): r.value for r in q.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("BroadcastHashJoin") >= 2
    assert got == {(0, 0.25): 14999.5, (0, 0.5): 29999.0, (1, 0.25): 15000.5, (1, 0.5): 30000.0}
