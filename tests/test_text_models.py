"""Rule sentiment, learned vectors, pairwise machines, registry sync, the checked concat flow."""

import datetime as dt
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcare.operators import cost as C
from sparkcare.operators import quality as Q
from sparkcare.operators import runs as RUN
from sparkcare.operators import svm
from sparkcare.operators import text as TX
from sparkcare.operators.combine import SchemaMismatch
from sparkcare.plans import models

LEX = [("good", 2.0), ("bad", -2.0), ("pain", -1.0), ("not", -9.0)]


def _plain(text):
    """The rules of with_rule_sentiment, word by word, in valence points."""
    import re
    raw = [w for w in re.split("[^A-Za-z']+", text or "") if w]
    low = [w.lower() for w in raw]
    table = {w: v for w, v in LEX if w not in {*TX.NEGATORS, *TX.BOOSTERS, *TX.DAMPERS}}
    mixed, but = any(w != w.upper() for w in raw), max((i for i, w in enumerate(low) if w == "but"), default=None)
    found = []
    for i, w in enumerate(low):
        if w not in table:
            continue
        v, sign = table[w], np.sign(table[w])
        if mixed and len(w) > 1 and raw[i] == raw[i].upper():
            v += sign * TX.CAPITALS / 1000
        near = [(low[i - d], TX.BOOST_AT[d - 1] / 1000) for d in range(1, TX.REACH + 1) if i - d >= 0]
        for x, b in near:
            v += sign * (b if x in TX.BOOSTERS else -b if x in TX.DAMPERS else 0)
        if any(x in TX.NEGATORS for x, _ in near):
            v *= -0.75
        found.append(v if but is None else v * (0.5 if i < but else 1.5))
    s = sum(found)
    s += np.sign(s) * min(TX.MOST_EXCLAMATIONS, (text or "").count("!")) * TX.EXCLAMATION / 1000
    pos, neg = sum(v + 1 for v in found if v > 0), -sum(v - 1 for v in found if v < 0)
    neu = len(raw) - sum(v != 0 for v in found)
    total = pos + neg + neu
    share = [round(x / total, 3) if total else 0.0 for x in (neg, neu, pos)]
    return (*share, round(s / np.sqrt(s * s + 15), 4), len(found))


def test_rules_of_sentiment(spark):
    texts = ["good", "not good", "It is not very good", "GOOD day", "GOOD", "really GOOD!!!", "good!!!!!!!!", "slightly bad",
             "good but bad", "bad but very good", "without pain", "not a b c good", "no! pain", "don't feel bad", None, "", "!!!", "so so good"]
    rnd = random.Random(3)
    bits = ["good", "BAD", "pain", "not", "never", "very", "Slightly", "but", "x", "Y!", "don't", "GOOD,", "so"]
    texts += [" ".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14))) for _ in range(300)]
    lex = spark.createDataFrame(LEX, "word string, valence double")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = {r.id: r for r in TX.with_rule_sentiment(df, "text", lex).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.neg, r.neu, r.pos, r.compound, r.n_hits) == pytest.approx(_plain(t), abs=1.1e-3), t  # halves round apart
    by = {t: rows[i].compound for i, t in enumerate(texts)}
    assert by["not good"] < 0 < by["good"] < by["GOOD day"] and by["GOOD"] == by["good"] and by["without pain"] > 0
    assert by["bad but very good"] > 0 > by["good but bad"] and by["slightly bad"] > -abs(by["good"])
    with pytest.raises(ValueError):
        TX.with_rule_sentiment(df, "text", lex, max_words=2)


def test_inline_and_joined_words_score_alike(spark):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["good", "Good's", "bad", "x", "meh", "..."]) for _ in range(rnd.randint(0, 30))) for _ in range(80)]
    lex = spark.createDataFrame([("good", 1.9), ("good", 0.1), ("bad", -2.5), ("meh", 0.0), (None, 3.0)], "word string, valence double")
    df = spark.createDataFrame([(t,) for t in [*texts, None, texts[0]]], "text string")
    inline, joined = (sorted(map(str, TX.with_sentiment(df, "text", lex, max_inline=n).collect())) for n in (100, 1))
    assert inline == joined
    assert "Exchange" not in TX.with_sentiment(df, "text", lex)._jdf.queryExecution().executedPlan().toString()


def test_learned_vectors_put_like_words_near(spark):
    rnd = random.Random(1)
    body, tool = ["knee", "hip", "ankle"], ["hammer", "wrench", "pliers"]
    rows = []
    for i in range(600):
        a, b = rnd.choice(body), rnd.choice(tool)
        rows.append((i, f"the surgeon healed my {a} after surgery"))
        rows.append((i, f"a mechanic dropped that {b} behind machines"))
    rows += [(1, None), (2, ""), (3, "rare word")]
    got = {r.word: np.array(r.vector, float) for r in TX.learned_vectors(
        spark.createDataFrame(rows, "id int, text string"), "text").collect()}
    assert "rare" not in got and {*body, *tool} <= set(got) and all(len(v) == 64 for v in got.values())
    cos = lambda a, b: got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
    near = [cos(x, y) for side in (body, tool) for x in side for y in side if x < y]
    far = [cos(x, y) for x in body for y in tool]
    assert min(near) > 0.95 and max(far) < 0.6
    assert TX.learned_vectors(spark.createDataFrame([], "text string"), "text").count() == 0


def _newton(x, y, reg, rounds=60):
    """One pair by itself: squared hinge, plain Newton with step halving."""
    x, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    penalty = np.append(np.full(x.shape[1] - 1, reg), svm.BIAS_REG)
    loss = lambda w: (np.maximum(0, 1 - y * (x @ w)) ** 2).mean() + (penalty * w * w).sum() / 2
    for _ in range(rounds):
        m = 1 - y * (x @ w)
        a = x[m > 0]
        g = -2 * (y[m > 0] * m[m > 0]) @ a / len(x) + penalty * w
        step = np.linalg.solve(2 * a.T @ a / len(x) + np.diag(penalty), g)
        t = 1.0
        while loss(w - t * step) > loss(w) + 1e-15 and t > 1e-9:
            t /= 2
        w = w - t * step
    return w


def test_all_pairs_are_the_single_fits(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(4, 5)) * 2
    y = rnd.integers(0, 4, 800)
    x = centres[y] + rnd.normal(size=(800, 5))
    df = spark.createDataFrame([([float(v) for v in r], int(c)) for r, c in zip(x, y)] + [(None, 1), ([0.0] * 5, None)],
                               "features array<double>, label int").repartition(5)
    model = svm.fit_pairs(df, 4)
    assert model.pairs == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)] and model.rounds < 30
    for p, (i, j) in enumerate(model.pairs):
        mine = (y == i) | (y == j)
        assert model.weights[p] == pytest.approx(_newton(x[mine], np.where(y[mine] == i, 1.0, -1.0), 0.01), abs=1e-5)
    got = svm.predict(model, df).collect()
    votes = model.votes(x)
    want = {tuple(r): (int(v.argmax()), int(v.max())) for r, v in zip(x, votes)}
    scored = [r for r in got if r.features is not None and r.label is not None]
    assert all((r.prediction, r.votes) == want[tuple(r.features)] for r in scored)
    assert np.mean([r.prediction == r.label for r in scored]) > 0.85
    assert [r.prediction for r in got if r.features is None] == [None]
    tied = svm.PairwiseSvm([(0, 1), (0, 2), (1, 2)], np.array([[1.0, 0], [-1.0, 0], [1.0, 0]]), 1)
    assert tied.votes(np.array([[1.0]])).tolist() == [[1, 1, 1]] and tied.votes(np.array([[0.0]])).argmax() == 0
    lone = svm.fit_pairs(df.where("label = 2"), 3)
    assert {r.prediction for r in svm.predict(lone, df.where("label = 2")).collect()} == {2}


def test_vectors_of_rare_and_frequent_words(spark, monkeypatch):
    rnd = random.Random(5)
    vocabulary = ["the", "a'b"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    texts = [" ".join(rnd.choices(vocabulary, [40, 20] + [6] * 10 + [1] * 50, k=rnd.randint(0, 300))) for _ in range(40)]
    texts += [None, "", "...", "lone", "The THE\nthe"]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)] + [(None, "wab the"), (3, "waa waa")], "id long, text string")
    words = [TX.WORD.findall((r.text or "").lower()) for r in docs.collect()]
    n = Counter(w for ws in words for w in ws)
    spots = {}
    for w, k in n.items():
        weight, digest = (sum(n.values()) // k).bit_length(), hashlib.md5(f"7:{w}".encode()).hexdigest()
        x = [int(digest[4 * j:4 * j + 4], 16) for j in range(4)]
        spots[w] = np.zeros(64, np.int64)
        for v in x:
            spots[w][v % 64] += -weight if v // 64 % 2 else weight
    want = {w: sum((spots[ws[j]] for ws in words for i in range(len(ws)) if ws[i] == w
                    for j in range(max(i - 2, 0), min(i + 3, len(ws))) if j != i), np.zeros(64, np.int64)) for w, k in n.items() if k >= 5}
    found = TX.learned_vectors(docs, "text")
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()  # no row for each word or pair
    for most in (1 << 18, 3):
        for name, value in (("FREQUENT_WORDS", most), ("HELD_WORDS", 16), ("SLICE_WORDS", 50)):
            monkeypatch.setattr(TX, name, value)
        got = TX.learned_vectors(docs, "text").collect()
        assert len(got) == len(want) and {r.word: r.n for r in got} == {w: n[w] for w in want}
        assert all(r.vector == want[r.word].tolist() for r in got)

    unit = {w: v / max(np.sqrt((v.astype(float) ** 2).sum()), 1) for w, v in want.items()}
    mean = {}
    for i in {r.id for r in docs.collect()}:
        mine = [unit[w] for r, ws in zip(docs.collect(), words) if r.id == i for w in ws if w in unit]
        mean[i] = sum(mine) / len(mine) if mine else np.zeros(64)
    vectors = spark.createDataFrame([(r.word, r.n, r.vector) for r in got], "word string, n long, vector array<long>")
    for most in (1 << 16, 7):
        monkeypatch.setattr(TX, "COMMON_WORDS", most)
        monkeypatch.setattr(TX, "BLOCK_TEXTS", 15)
        out = TX.document_vectors(docs, "id", "text", vectors, count_col="n", unit=True).collect()
        assert Counter(r.id for r in out) == Counter(r.id for r in docs.collect())
        assert all(np.allclose(r.features.toArray(), mean[r.id], atol=1e-12) for r in out)
    plain = TX.document_vectors(docs, "id", "text", vectors, unit=True, rows=docs.select("id", "text")).collect()
    assert len(plain) == len(texts) + 2 and all(np.allclose(r.features.toArray(), mean[r.id], atol=1e-12) for r in plain)
    none = TX.document_vectors(docs, "id", "text", vectors.limit(0), count_col="n").collect()
    assert len(none) == len(texts) + 2 and all(len(r.features) == 0 for r in none)
    assert TX.learned_vectors(docs.limit(0), "text").count() == 0


def test_classifier_is_fitted_on_all_training_documents(spark, monkeypatch):
    seen, fit = [], TX.train_classifier
    monkeypatch.setattr(TX, "train_classifier", lambda train, **k: seen.append(train.count()) or fit(train, max_iter=2, **k))
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 5 < 3, "aa bb").otherwise("cc dd").alias("text"),
        F.when(F.col("id") % 100 == 99, None).when(F.col("id") % 5 < 3, "x").otherwise("y").alias("lang"))
    vectors = spark.createDataFrame([(i, [float(i == j) for j in range(8)]) for i in range(8)], "vec_id long, embedding array<float>")
    got = models.q_text_classify({"documents": docs, "embeddings": vectors}, spark).first()
    assert seen == [C.hash_split(docs.where("lang is not null"), "doc_id").where("is_train").count()] and seen[0] > 20_000
    assert (got.n_documents, got.n_unknown_class, got.better_than_majority) == (30_000, 0, True)


def test_registry_follows_snapshots(spark):
    days = [F.lit(dt.datetime(2024, 1, d)).cast("timestamp_ntz") for d in range(1, 5)]
    snap = lambda rows: spark.createDataFrame(rows, "program string, sys long")
    sync = lambda reg, rows, day: RUN.sync_registry(reg, snap(rows), days[day], system_col="sys")
    reg = sync(None, [("/x/b.py", 2), ("/y/a.py", 1), ("a.py", 5), (None, 1), ("", 1), ("c.py", None)], 0)
    reg = sync(reg, [("a.py", 1), ("b.py", 9), ("d.py", 4)], 1)
    now = {r.batch_name: r for r in reg.collect()}
    first, second, third = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
    assert {n: (r.batch_run_id, r.batch_system_id, r.insert_ts, r.mod_ts, r.delete_ts, r.action) for n, r in now.items()} == {
        "a.py": (1, 1, first, first, None, "keep"), "b.py": (2, 9, first, second, None, "change"),
        "c.py": (3, None, first, second, second, "delete"), "d.py": (4, 4, second, second, None, "insert")}
    reg = sync(reg, [("c.py", 7), ("b.py", 9)], 2)
    assert {r.batch_name: (r.batch_system_id, r.mod_ts, r.delete_ts, r.action) for r in reg.collect()} == {
        "a.py": (1, third, third, "delete"), "b.py": (9, second, None, "keep"),
        "c.py": (7, third, None, "reinsert"), "d.py": (4, third, third, "delete")}
    gone = sync(reg, [], 3)
    assert {r.action for r in gone.collect() if r.batch_name in ("a.py", "d.py")} == {"keep"} and gone.count() == 4


def test_checked_concat(spark, tmp_out):
    one, two = (spark.range(a, b).select("id", F.lit("x").alias("t")) for a, b in ((0, 50), (50, 80)))
    exp = Q.Expectations(min_rows=80, max_rows=80, columns=["t", "id"], unique_column="id", type_column="id", expected_type="bigint")
    r = Q.checked_concat([one, two], f"{tmp_out}/flow", "ids", exp).first()
    assert r.meets_rowcount_expectation and r.all_columns_match and r.columns_are_unique and r.column_type_matches
    assert spark.read.parquet(f"{tmp_out}/flow").count() == 80
    with pytest.raises(SchemaMismatch):
        Q.checked_concat([one, two.withColumn("id", F.col("id").cast("int"))], f"{tmp_out}/bad", "ids", exp)
    assert not Q.checked_concat([one, one], f"{tmp_out}/twice", "ids", exp).first().columns_are_unique
