"""Quantiles by selection, numbering by content, sweeps over a line, numbered lines."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkcare.operators import ranking, runs as RUN
from sparkcare.operators.joins import interval_counts, range_argmax_join
from sparkcare.operators.profile import correlation, empty_tables, is_empty
from sparkcare.sources import read_report_lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("small", [20, 20_000])
def test_quantiles_of_mostly_equal_values(spark, small):
    rnd = np.random.default_rng(3)
    groups = {"ties": np.where(rnd.random(4000) < .9, 5.0, rnd.normal(5, 3, 4000)), "spread": rnd.exponential(1, 3000),
              "one": np.array([7.0]), "two": np.array([1.0, 2.0]), None: rnd.integers(0, 3, 500).astype(float),
              "huge": np.concatenate([[-1e308, 1e308], rnd.normal(0, 1, 998)])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("ties", None), ("empty", None)]
    probs = [0.0, 1 / 16, 0.25, 0.5, 0.7, 15 / 16, 1.0]
    before = ranking.SMALL
    ranking.SMALL = small  # small: every group is bracketed by a sketch
    try:
        got = ranking.exact_quantiles(spark.createDataFrame(rows, "g string, x double").repartition(6), "x", probs, ["g"])
        assert "Checkpoint" not in _plan(got)
        found = {(r.g, r.prob): (r.n, r.value) for r in got.collect()}
    finally:
        ranking.SMALL = before
    assert {g for g, _ in found} == set(groups)
    for g, xs in groups.items():
        for p in probs:
            n, v = found[(g, p)]
            assert n == len(xs) and v == pytest.approx(np.quantile(xs, p), rel=1e-12, abs=1e-12), (g, p)
    whole = ranking.exact_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", [0.5])
    assert [tuple(r) for r in whole.collect()] == [(0.5, sum(map(len, groups.values())), pytest.approx(
        np.median(np.concatenate(list(groups.values())))))]


def test_numbers_do_not_depend_on_the_cuts(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, "a", "b", "é"]), rnd.choice([None, 1.5, 2.5]), i % 700) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, k double, i int")
    seen = []
    for parts, layout in ((1, df), (2, df.repartition(9)), (40, df.orderBy("i"))):
        out = ranking.with_sequence(layout, ["k"], "seq", num_partitions=parts)
        assert "Checkpoint" not in _plan(out)
        seen.append(sorted((r.seq, str(r.g), str(r.k), r.i) for r in out.collect()))
    assert seen[0] == seen[1] == seen[2] and [r[0] for r in seen[0]] == list(range(1, 1501))
    ks = [r[2] for r in seen[0]]
    assert ks == sorted(ks, key=lambda k: (k != "None", k))
    grouped = ranking.rank_rows(df, ["k"], ["g"], "r", num_partitions=16).collect()
    for g in (None, "a", "b", "é"):
        mine = sorted((r.r, r.k is not None, r.k or 0) for r in grouped if r.g == g)
        assert [r for r, _, _ in mine] == list(range(1, sum(x[0] == g for x in rows) + 1))
        assert [x[1:] for x in mine] == sorted(x[1:] for x in mine)
    assert ranking.with_sequence(df.limit(0), ["k"]).count() == 0


def test_ties_spread_over_parts(spark):
    df = spark.range(4000).select(F.lit("same").alias("k"), "id")
    out = ranking.with_sequence(df, ["k"], "seq", num_partitions=16)
    cuts = ranking.cut_points(df.withColumn("d", F.md5(F.col("id").cast("string"))), ["k", "d"], 16)
    assert len(cuts) == 15
    sizes = [r["count"] for r in df.withColumn("d", F.md5(F.col("id").cast("string"))).groupBy(
        ranking.part_of(F.struct("k", "d"), cuts).alias("p")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 4 * 4000 / 16
    assert sorted(r.seq for r in out.collect()) == list(range(1, 4001))


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000))
def test_interval_counts_and_asof_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    width = rnd.choice([5, 300, 10 ** 15])
    lows = [rnd.choice([None, 0, rnd.randint(-width, width)]) for _ in range(120)]
    left = [(i, lo, rnd.choice([None, lo, (lo or 0) + rnd.randint(-3, width)])) for i, lo in enumerate(lows)]
    right = [(rnd.choice([None, 7, rnd.randint(-width, width)]), rnd.choice("abc")) for _ in range(rnd.choice([0, 1, 150]))]
    lf = spark.createDataFrame(left, "id long, lo long, hi long").withColumn("c", F.lit("clash"))
    rf = spark.createDataFrame(right, "k long, name string")
    keys = [k for k, _ in right if k is not None]
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r.id: (r.n_matches, r.first_match, r.last_match) for r in interval_counts(lf, rf, "lo", "hi", "k").collect()}
        best = {r.id: (r.m_k, r.m_name) for r in range_argmax_join(lf, rf, "lo", "hi", "k", ["name"], ["name"], "left").collect()}
    assert len(got) == len(best) == len(left)
    for i, lo, hi in left:
        inside = [k for k in keys if lo is not None and hi is not None and lo < k <= hi]
        assert got[i] == (len(inside), min(inside, default=None), max(inside, default=None))
        assert best[i] == ((max(inside), min(n for k, n in right if k == max(inside))) if inside else (None, None))


def test_sweep_keeps_no_copy(spark):
    left = spark.range(100).select(F.col("id").alias("lo"), (F.col("id") + 9).alias("hi"))
    plan = _plan(interval_counts(left, spark.range(50), "lo", "hi", "id"))
    assert "Checkpoint" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_lines_are_numbered_across_splits(spark, tmp_out):
    rnd = random.Random(2)
    files = {f"r{k}.txt": [f"{k} line {i} " + "x" * rnd.randrange(60) for i in range(n)]
             for k, n in enumerate((400, 1, 3, 900, 0))}
    for name, lines in files.items():
        with open(os.path.join(tmp_out, name), "w") as f:
            f.write("".join(line + "\n" for line in lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # several splits a file, several files a task
    try:
        rows = read_report_lines(spark, tmp_out, numbered=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(r.source_file, r.line_no): r.value for r in rows}
    assert len(rows) == len(got) == sum(map(len, files.values()))
    assert got == {(name, i + 1): line for name, lines in files.items() for i, line in enumerate(lines)}


def test_first_line_of_each_report_goes_by_position(spark, tmp_out):
    run = "{} 2024-01-01 02:00:00 Mon 2024-01-03 05:00:00 Wed 51:00:00 CDW Finished Sequence {}"
    reports = {"a": [run.format("aTitle", "x"), run.format("one", "one"), "Job Name is a run here " + "w " * 9],
               "b": ["anything at all"], "c": ["Job Name   Started", run.format("two", "two"), "too short", ""]}
    for name, lines in reports.items():
        with open(os.path.join(tmp_out, name), "w") as f:
            f.write("\n".join(lines))
    lines = read_report_lines(spark, tmp_out, numbered=True)
    assert sorted(r.job_name for r in RUN.parse_report(lines, header_lines=1).collect()) == ["Job", "one", "two"]
    assert [r.value for r in RUN.report_rejects(lines, header_lines=1).collect()] == ["too short"]


def test_correlation_with_gaps_and_a_large_offset(spark):
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(500, 4)) @ rnd.normal(size=(4, 4))
    rows = [tuple(float(v) if rnd.random() > gap else None for v, gap in zip(r, (0, 0, .2, .4))) + (1.0, None) for r in x]
    names = ["a", "b", "c", "d", "same", "none"]
    import pandas as pd
    want = pd.DataFrame(rows, columns=names, dtype=float).corr()
    schema = ", ".join(f"{n} double" for n in names)
    for offset in (0.0, 1e9):
        df = spark.createDataFrame([tuple(None if v is None else v + offset for v in r) for r in rows], schema)
        got = {(r.col_a, r.col_b): r["corr"] for r in correlation(df, names).collect()}
        assert len(got) == 36
        for i in names:
            for j in names:
                if i == j:
                    assert got[i, j] == 1.0
                elif {i, j} & {"same", "none"}:
                    assert got[i, j] is None
                else:
                    assert got[i, j] == pytest.approx(want.loc[i, j], abs=2e-6)
    wide = spark.createDataFrame([tuple(map(float, rnd.normal(size=16))) for _ in range(60)], ", ".join(f"c{i} double" for i in range(16)))
    assert correlation(wide, wide.columns).count() == 256  # more sums than one aggregate holds


def test_empty(spark):
    df = spark.createDataFrame([(10, "individual"), (22, "group")], "test_cnt int, product_nm string")
    assert not is_empty(df) and is_empty(df.where("test_cnt > 99"))
    got = {r.table_name: r.is_empty for r in empty_tables({"full": df, "none": df.where("test_cnt > 99")}).collect()}
    assert got == {"full": False, "none": True}
