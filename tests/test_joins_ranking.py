import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkcare.operators import joins
from sparkcare.operators.joins import asof_join, interval_join, range_argmax_join
from sparkcare.operators.ranking import exact_quantiles, rank_rows, with_sequence


def _brute_best(L, R):
    out = {}
    for i, lo, hi in L:
        c = [(k, n) for _, k, n in R if lo < k <= hi]
        if c:
            mk = max(k for k, _ in c)
            out[i] = (mk, min(n for k, n in c if k == mk))
    return out


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10_000))
def test_range_argmax_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    L = [(i, lo, lo + rnd.randint(0, 900)) for i, lo in enumerate(rnd.randint(-4000, 4000) for _ in range(150))]
    R = [(j, rnd.randint(-5000, 5000), rnd.choice("abc")) for j in range(200)]
    left = spark.createDataFrame(L, "id long, lo long, hi long")
    right = spark.createDataFrame(R, "rid long, k long, name string")
    got = {r.id: (r.m_k, r.m_name) for r in
           range_argmax_join(left, right, "lo", "hi", "k", ["rid"], tie_cols=["name"]).collect()}
    assert got == _brute_best(L, R)
    pairs = interval_join(left, right, "lo", "hi", "k", 300).count()
    assert pairs == sum(1 for _, lo, hi in L for _, k, _n in R if lo < k <= hi)


def test_pairs_of_a_hot_bucket_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "CELL_ROWS", 50)
    monkeypatch.setattr(joins, "TASK_PAIRS", 10_000)
    rnd = random.Random(3)
    L = [(i, k, k + 90) for i, k in enumerate(rnd.choices(range(100), k=600))] + [(None, 5, 7), (1, None, 3), (2, 3, None), (3, 9, 2)]
    R = [(i, rnd.randrange(200)) for i in range(900)] + [(None, 50), (None, 50), (5, None)]
    pairs = interval_join(spark.createDataFrame(L, "id long, lo long, hi long"), spark.createDataFrame(R, "rid long, k long"),
                          "lo", "hi", "k", 100).withColumn("task", F.spark_partition_id()).collect()
    want = Counter((i, j, k) for i, lo, hi in L for j, k in R if None not in (lo, hi, k) and lo < k <= hi)
    assert Counter((r.id, r.rid, r.k) for r in pairs) == want
    tasks = Counter(r.task for r in pairs)
    assert len(tasks) > 20 and max(tasks.values()) < len(pairs) / 5


def test_dense_buckets_are_shuffled_once(spark, monkeypatch):
    sent, kind = [], type(spark.range(0))
    for name in ("repartition", "repartitionById"):
        deal = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, *a, deal=deal: sent.append(self.count()) or deal(self, *a))
    left = spark.range(240_000).select("id", (F.col("id") % 40 * 100).alias("lo"), (F.col("id") % 40 * 100 + 99).alias("hi"))
    right = spark.range(240_000).select("id", (F.col("id") % 40 * 100).alias("k"))
    out = interval_join(left, right, "lo", "hi", "k", 100, "l_", "r_")
    assert sent == [240_000, 240_000]  # 6,000 rows a side in each bucket: more than a cell
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in plan
    assert out.count() == 0  # the only keys lie at lo


def test_interval_edges_and_asof(spark):
    day = 86_400
    left = spark.createDataFrame([(1, 100), (2, 10_000)], "id long, s long").withColumn("h", F.col("s") + 5 * day)
    right = spark.createDataFrame([(1, 100, "x"), (2, 100 + 5 * day, "b"), (3, 100 + 5 * day, "a"),
                                   (4, 100 + 5 * day + 1, "z")], "rid long, e long, job string")
    m = {r.id: (r.m_e, r.m_job) for r in
         range_argmax_join(left, right, "s", "h", "e", ["rid"], tie_cols=["job"], how="left").collect()}
    # an end exactly at the start is excluded, one at start + 5 days included, ties -> smallest job
    assert m[1] == (100 + 5 * day, "a")
    assert m[2] == (100 + 5 * day + 1, "z")
    a = asof_join(spark.createDataFrame([(1, 50), (2, 99)], "id long, t long"),
                  spark.createDataFrame([(10, "p"), (60, "q")], "k long, v string"),
                  "t", "k", ["v"], tolerance=45, how="left")
    got = {r.id: r.m_v for r in a.collect()}
    assert got == {1: "p", 2: "q"}


def test_ranges_of_any_width(spark):
    left = spark.createDataFrame([(1, 0, 10**15), (2, -10**15, -1), (3, 5, 5), (4, None, 3), (5, 0, None)], "id long, lo long, hi long")
    right = spark.createDataFrame([(1, 7, "a"), (2, -10**14, "b"), (3, None, "c")], "rid long, k long, name string")
    got = {r.id: r.m_k for r in range_argmax_join(left, right, "lo", "hi", "k", ["rid"], how="left").collect()}
    assert got == {1: 7, 2: -10**14, 3: None, 4: None, 5: None}


def test_with_sequence_is_global_order(spark):
    vals = [(random.Random(1).randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(vals, "k int, i int")
    rows = with_sequence(df, [F.col("k"), F.col("i")], "seq", num_partitions=7).collect()
    assert sorted(r.seq for r in rows) == list(range(1, 501))
    by_seq = [(r.k, r.i) for r in sorted(rows, key=lambda r: r.seq)]
    assert by_seq == sorted(vals)


def test_rank_rows_within_hot_group(spark):
    # one group holds most rows: positions stay exact and contiguous per group
    data = [("hot", i) for i in range(400)] + [("cold", i) for i in range(20)]
    out = rank_rows(spark.createDataFrame(data, "g string, v int"), [F.col("v")], ["g"], "r", num_partitions=6)
    for g, n in (("hot", 400), ("cold", 20)):
        rs = sorted((r.v, r.r) for r in out.where(F.col("g") == g).collect())
        assert [r for _, r in rs] == list(range(1, n + 1))


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(3)
    a, b = rnd.normal(size=301), rnd.exponential(size=40)
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("b", None)]
    probs = [0.0625, 0.25, 0.5, 0.9375, 1.0]
    q = exact_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", probs, ["g"])
    got = {(r.g, r.prob): r.value for r in q.collect()}
    for g, arr in (("a", a), ("b", b)):
        for p in probs:
            assert abs(got[(g, p)] - np.quantile(arr, p)) < 1e-9
