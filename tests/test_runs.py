import datetime as dt

from pyspark.sql import functions as F

from sparkcare.operators import runs as RUN

LINES = [
    "Job Name        Started   Finished   Elapsed  Project  Status",
    "bDropCdwIndex   2024-01-01 01:00:00 Mon   2024-01-01 01:10:00 Mon   0:10:00  CDW   Finished  Sequence bDropCdwIndex",
    "bCDWBase 2024-01-01 02:00:00 Mon 2024-01-03 05:00:00 Wed 51:00:00 CDW Finished Sequence bCDWBase",
    "bStorkBase 2024-01-01 02:00:00 Mon 2024-01-06 01:00:00 Sat 1:00:00 CDW (Status = Aborted)",
    "bStorkBase 2024-01-01 02:00:00 Mon 2024-01-06 01:00:00 Sat 1:00:00 CDW Finished Sequence bStorkBase",
    "bLate 2024-01-01 02:00:00 Mon 2024-01-06 01:00:01 Sat 1:00:00 CDW Finished Sequence bLate",
    "bShort 2024-01-01 01:00:00",
    "   ",
]


def _lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_parse_report(spark):
    runs = RUN.parse_report(_lines(spark))
    got = {(r.job_name, r.status) for r in runs.collect()}
    assert got == {("bDropCdwIndex", "Finished"), ("bCDWBase", "Finished"), ("bStorkBase", "Aborted"),
                   ("bStorkBase", "Finished"), ("bLate", "Finished")}
    assert runs.columns == RUN.JOB_COLUMNS
    rej = [r.value for r in RUN.report_rejects(_lines(spark)).collect()]
    assert rej == ["bShort 2024-01-01 01:00:00"]


def test_box_elapsed_latest_end_within_window(spark):
    runs = RUN.parse_report(_lines(spark))
    box = RUN.box_elapsed(runs, "bDropCdwIndex", 5).collect()
    assert len(box) == 1
    b = box[0]
    # start 2024-01-01 01:00:00; ends: 01-03 05:00 and 01-06 01:00 (=start+5d, included); 01-06 01:00:01 is out
    assert (b.end_date, b.end_time, b.end_day) == ("2024-01-06", "01:00:00", "Sat")
    assert b.total_elapsed_time == "5 days and 0:00:00" and b.run_data == ""


def test_box_without_end_dropped_or_kept(spark):
    runs = spark.createDataFrame([("bDropCdwIndex", "2024-01-01", "00:00:00", "Mon", "2024-01-01", "00:00:01", "Mon",
                                   "0:00:01", "CDW", "Finished")], ",".join(f"{c} string" for c in RUN.JOB_COLUMNS))
    assert RUN.box_elapsed(runs).count() == 0
    kept = RUN.box_elapsed(runs, keep_unmatched=True).collect()
    assert len(kept) == 1 and kept[0].end_date is None


def test_filter_and_sequence(spark):
    runs = RUN.parse_report(_lines(spark))
    assert RUN.filter_jobs(runs, ["bCDWBase"]).count() == 1
    jobs = spark.createDataFrame([("bStorkBase",)], "name string")
    assert RUN.filter_jobs(runs, jobs).count() == 2
    seq = RUN.sequence_runs(runs).collect()
    assert sorted(r.record_num for r in seq) == [1, 2, 3, 4, 5]


def test_register_new_and_run_summary(spark):
    reg = spark.createDataFrame([(1, "a.py"), (2, "b.py")], "batch_run_id long, batch_name string")
    progs = spark.createDataFrame([("/x/a.py",), ("/y/c.py",), ("/z/c.py",), ("d.py",)], "program string")
    out = {r.batch_name: (r.batch_run_id, r.is_new) for r in RUN.register_new(reg, progs).collect()}
    assert out == {"a.py": (1, False), "b.py": (2, False), "c.py": (3, True), "d.py": (4, True)}
    t0 = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, "load", t0, "FS"), (1, "load", t0 + dt.timedelta(seconds=90), "FL")],
                               "run_id long, step string, ts timestamp_ntz, status string")
    s = RUN.run_summary(ev).first()
    assert s.n_events == 2 and s.last_status == "FL" and s.duration_us == 90_000_000


def test_run_summary_of_start_and_stop_events(spark):
    at = [dt.datetime(2024, 1, 1, 0, 0, x) for x in range(10)]
    rows = [(1, "load", "start", at[0], "RN"), (1, "load", "stop", at[3], None),
            (1, "open", "start", at[1], "RN"),
            (1, "again", "start", at[0], "RN"), (1, "again", "stop", at[2], "FL"), (1, "again", "start", at[4], "RN"),
            (1, "tie", "stop", at[5], "FS"), (1, "tie", "start", at[5], "RN"),
            (1, "stray", "stop", at[6], "FL"), (1, None, "start", at[0], "RN")]
    df = spark.createDataFrame(rows, "run_id long, step string, event string, ts timestamp_ntz, status string")
    got = {r.step: (r.started_ts, r.finished_ts, r.duration_us, r.last_status)
           for r in RUN.run_summary(df, event_col="event").collect()}
    assert got == {"load": (at[0], at[3], 3_000_000, "FS"), "open": (at[1], None, None, "RN"),
                   "again": (at[0], None, None, "RN"), "tie": (at[5], at[5], 0, "FS"),
                   "stray": (None, at[6], None, "FL"), None: (at[0], None, None, "RN")}
    for order in (rows, rows[::-1]):  # records without a kind: equal times are decided by status
        same = spark.createDataFrame([(1, "s", at[0], r[4]) for r in order if r[4]],
                                     "run_id long, step string, ts timestamp_ntz, status string")
        assert RUN.run_summary(same).first().last_status == "RN"


def test_register_new_with_times(spark):
    now, then = dt.datetime(2024, 5, 1), dt.datetime(2023, 1, 1)
    reg = spark.createDataFrame([(1, "a.py", 7, then)], "batch_run_id long, batch_name string, batch_system_id int, insert_ts timestamp_ntz")
    out = {r.batch_name: tuple(r)[3:] for r in RUN.register_new(
        reg, spark.createDataFrame([("/x/a.py",), ("/x/b.py",)], "program string"), now=now).collect()}
    assert out == {"a.py": (7, then, None, None), "b.py": (None, now, now, None)}


def test_report_lines_are_not_dealt_by_split(spark, tmp_path):
    from sparkcare.sources.files import read_report_lines
    (tmp_path / "a.txt").write_text("one\ntwo\nthree\n")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = read_report_lines(spark, str(tmp_path), numbered=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.line_no, r.value) for r in df.collect()) == [(1, "one"), (2, "two"), (3, "three")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
