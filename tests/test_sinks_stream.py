import os

import pytest
from pyspark.sql import functions as F

from sparkcare.session import clear_stored, stored_copy
from sparkcare.sinks import jdbc_writer_options, preview, refresh_table, truncate_and_load, write_csv, write_parquet, write_table
from sparkcare.sources import jdbc_reader_options, key_predicates, read_csv, read_csv_columns, read_report_lines, read_table
from sparkcare.streaming import start_report_ingest


def test_csv_roundtrip_and_pruning(spark, tmp_out):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, name string, v double") \
        .withColumn("s", F.struct("id", "v"))
    p = os.path.join(tmp_out, "csv")
    write_csv(df, p)
    back = read_csv(spark, p, schema="id int, name string, v double, s string")
    assert sorted(map(tuple, back.select("id", "name", "v").collect())) == [(1, "a", 2.5), (2, "b", None)]
    assert back.where("id = 1").first().s == '{"id":1,"v":2.5}'
    one = read_csv_columns(spark, p, ["name"], schema="id int, name string, v double, s string")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan


def test_table_overwrite_and_refresh(spark, tmp_out):
    df = spark.range(5).withColumnRenamed("id", "k")
    write_table(df, "sc_test_t", mode="overwrite")
    write_table(df.limit(2), " sc_test_t ", mode="overwrite")
    assert read_table(spark, "sc_test_t").count() == 2
    t = refresh_table(df, "sc_test_mv", comment="claims in one place")
    assert t.count() == 5
    assert spark.catalog.getTable("sc_test_mv").description == "claims in one place"
    write_table(df, "sc_test_b", bucket_by=["k"], num_buckets=4)
    assert read_table(spark, "sc_test_b").count() == 5


def test_truncate_and_load(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    out = truncate_and_load(df, [F.col("x")], "seq", table="sc_test_seq")
    assert sorted((r.x, r.seq) for r in spark.read.table("sc_test_seq").collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert out.count() == 3
    assert preview(df, 2).count() == 2


def test_jdbc_options():
    o = jdbc_reader_options("jdbc:oracle:thin:@//h:1521/s", query="select * from t where x like '%1%'",
                            partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4, user="u")
    assert o["dbtable"].startswith("(select") and o["numPartitions"] == "4" and "query" not in o
    assert jdbc_reader_options("jdbc:x", table="t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        jdbc_reader_options("jdbc:x")
    w = jdbc_writer_options("jdbc:x", "OPS.LOG")
    assert w["truncate"] == "true"


def test_parquet_and_report_source(spark, tmp_out):
    src = os.path.join(tmp_out, "reports")
    os.makedirs(src)
    with open(os.path.join(src, "bCDWBase.txt"), "w") as f:
        f.write("Job Name Started Finished\n")
        f.write("bCDWBase 2024-01-01 02:00:00 Mon 2024-01-03 05:00:00 Wed 51:00:00 CDW Finished Sequence bCDWBase\n")
    lines = read_report_lines(spark, src)
    assert set(r.source_file for r in lines.collect()) == {"bCDWBase.txt"}
    write_parquet(lines, os.path.join(tmp_out, "pq"))
    assert spark.read.parquet(os.path.join(tmp_out, "pq")).count() == 2
    # streaming ingest of the same folder
    q = start_report_ingest(spark, src, os.path.join(tmp_out, "sink"), os.path.join(tmp_out, "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(tmp_out, "sink")).collect()
    assert [(r.job_name, r.status) for r in got] == [("bCDWBase", "Finished")]


def test_key_predicates_cover_each_row_once():
    import duckdb
    rows = [None, *range(-30, 31), 10 ** 15 + 7, -10 ** 15 - 7]
    for parts in (1, 2, 3, 8):
        conditions = key_predicates("k", parts)
        assert len(conditions) == parts
        con = duckdb.connect()
        con.execute("CREATE TABLE t (k BIGINT)")
        con.executemany("INSERT INTO t VALUES (?)", [(r,) for r in rows])
        counts = [con.execute(f"SELECT count(*) FROM t WHERE {c}").fetchone()[0] for c in conditions]
        assert sum(counts) == len(rows)
        both = con.execute("SELECT count(*) FROM t WHERE " + " AND ".join(f"NOT coalesce(({c}), false)" for c in conditions)).fetchone()[0]
        assert both == 0


def test_stored_copies_are_cleared(spark):
    clear_stored(spark)
    one, two = stored_copy(spark.range(5)), stored_copy(spark.range(3))
    files = [f.removeprefix("file:") for df in (one, two) for f in df.inputFiles()]
    assert one.count() + two.count() == 8 and all(os.path.exists(f.replace("//", "", 1) if f.startswith("//") else f) for f in files)
    assert clear_stored(spark) == 2 and clear_stored(spark) == 0
    assert not any(os.path.exists(f.replace("//", "", 1) if f.startswith("//") else f) for f in files)
