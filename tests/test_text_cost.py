import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkcare.operators import cost as C
from sparkcare.operators import text as TX


def test_sentiment_edges(spark):
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("meh", 0.2), ("ugh", -0.2)], "word string, valence double") \
        .select("word", F.col("valence").cast("decimal(6,3)").alias("valence"))
    df = spark.createDataFrame([(1, "Good good day"), (2, None), (3, ""), (4, "bad"), (5, "meh"), (6, "ugh")],
                               "id int, text string")
    r = {x.or_case_id: x for x in TX.response_ratings(df.withColumn("p", F.lit("x")), "text", "p", "id", lex).collect()}
    s = 3.8
    assert r[1].total_sentiment_data.compound == round(s / np.sqrt(s * s + 15), 4)
    assert r[1].positive_rating == "85.3%" and r[1].overall_rating == "Positive"  # (2.9*2)/(2.9*2+1)
    assert r[2].overall_rating == "Neutral" and r[2].total_sentiment_data.compound == 0.0
    assert r[3].neutral_rating == "0.0%"
    assert r[4].overall_rating == "Negative"
    # compound exactly at the thresholds: 0.2/sqrt(0.04+15) = 0.0516 -> Positive; mirror -> Negative
    assert r[5].overall_rating == "Positive" and r[6].overall_rating == "Negative"


def test_all_periods_one_pass(spark):
    df = spark.createDataFrame([(1, "p", "good", None, "bad")], "or_case_id int, pat_id string, a string, b string, c string")
    out = TX.all_period_ratings(df, {"preop": "a", "m3": "b", "y1": "c"}, "pat_id", "or_case_id",
                                TX.default_lexicon(spark))
    got = {r.period: r.overall_rating for r in out.collect()}
    assert got == {"preop": "Positive", "m3": "Neutral", "y1": "Negative"}


def test_linear_regression_matches_lstsq(spark):
    rnd = np.random.default_rng(1)
    X = rnd.normal(size=(300, 5))
    y = X @ np.array([1.5, -2.0, 0.3, 4.0, 0.0]) + 7 + rnd.normal(scale=0.1, size=300)
    rows = [tuple(float(v) for v in x) + (float(t),) for x, t in zip(X, y)]
    df = spark.createDataFrame(rows, "age double, bmi double, children double, smoker double, region double, label double")
    m = C.fit_cost_model(df)
    A = np.hstack([X, np.ones((300, 1))])
    coef = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose(list(m.coefficients) + [m.intercept], coef, atol=1e-6)
    pred = C.predict(m, df)
    assert abs(C.r2(pred) - C.r2_frame(pred).first().r2) < 1e-9


def test_encode_split_and_simple_regression(spark):
    df = spark.createDataFrame([("male", "yes", "northeast"), ("female", "no", "central")], "gender string, smoker string, region string")
    r = [tuple(x) for x in C.encode_categories(df).collect()]
    assert r == [(0, 1, 4), (1, 0, None)]
    s = C.hash_split(spark.range(1000), "id").agg(F.avg(F.col("is_train").cast("int"))).first()[0]
    assert 0.6 < s < 0.8
    lr = C.simple_regression(spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double"), "y", "x").first()
    assert (lr.slope, lr.intercept, lr.r2, lr.n) == (2.0, 1.0, 1.0, 3)


def test_document_vectors_and_classifier(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "c")], "doc_id int, text string")
    wv = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [2.0, 2.0])], "word string, vector array<double>")
    dv = {r.doc_id: list(r.features) for r in TX.document_vectors(docs, "doc_id", "text", wv).collect()}
    assert np.allclose(dv[1], [1 / 3, 2 / 3]) and np.allclose(dv[2], [2.0, 2.0])
    pts = [(float(c), [float(c) * 3 + 0.1 * i, -float(c) * 3 + 0.05 * i]) for c in range(3) for i in range(10)]
    tr = spark.createDataFrame(pts, "label double, f array<double>").select("label", array_to_vector("f").alias("features"))
    m = TX.train_classifier(tr, max_iter=50)
    acc = TX.classify(m, tr).where("label = prediction").count() / tr.count()
    assert acc >= 0.6


def test_sentiment_any_ids_and_lexicon_size(spark):
    words = [(f"w{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}", 0.5) for i in range(10_000)]
    for extra in ([], words):
        lex = spark.createDataFrame([("good", 1.9), ("good", 1.5), ("bad", -2.5), *extra], "word string, valence double")
        df = spark.createDataFrame([(1, "good"), (1, "bad bad"), (None, "good"), (2, None)], "id int, text string")
        got = sorted((r.text or "", r.compound) for r in TX.with_sentiment(df, "text", lex).collect())
        assert [t for t, _ in got] == ["", "bad bad", "good", "good"]
        assert got[0][1] == 0.0 and got[1][1] == round(-5 / np.sqrt(25 + 15), 4)
        assert got[2][1] == got[3][1] == round(1.9 / np.sqrt(1.9 ** 2 + 15), 4)


def test_unscored_rows_are_null_and_counted(spark):
    rows = [(float(i), 1.0, i % 3, i % 2, 1 + i % 4, 3.0 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "age double, bmi double, children int, smoker int, region int, label double")
    pred = C.predict(C.fit_cost_model(df), df.unionByName(df.limit(2).withColumn("region", F.lit(None).cast("int"))))
    assert pred.where("prediction is null").count() == 2 and pred.where("isnan(prediction)").count() == 0
    r = C.r2_frame(pred).first()
    assert (r.n, r.unscored) == (40, 2) and abs(r.r2 - 1) < 1e-9


def test_hashed_document_vectors(spark):
    import hashlib
    docs = spark.createDataFrame([(1, "Pain is better, much better"), (2, ""), (3, "x"), (None, None)], "doc_id int, text string")
    table = {10: [0.5, 1.0], 11: [2.0, -1.0], 50: [4.0, 0.25]}  # ids need not be 0..n-1
    vecs = spark.createDataFrame(list(table.items()), "vec_id int, embedding array<double>")
    got = {r.doc_id: r.features for r in TX.hashed_document_vectors(docs, "doc_id", "text", vecs, "vec_id", "embedding").collect()}
    pick = lambda w: list(table.values())[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 3]
    want = np.mean([pick(w) for w in ("pain", "is", "better", "much", "better")], axis=0)
    assert np.allclose(got[1], want) and got[2] == got[None] == [0.0, 0.0] and got[3] == pick("x")


def test_vectors_travel_once_for_each_block_of_texts(spark, monkeypatch):
    """Many texts with the same wide vectors: what is shuffled holds a block's vectors, not each text's."""
    rows = [(i, " ".join(f"w{'abcdefghij'[(i + j) % 10]}" for j in range(30))) for i in range(400)] + [(3, "wa zz"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wv = spark.createDataFrame([(f"w{c}", [float(k), 1.0]) for k, c in enumerate("abcdefghij")] + [("wa", [10.0, 3.0])],
                               "word string, vector array<double>")
    vectors = {"abcdefghij"[k]: [(float(k), 1.0)] for k in range(10)}
    vectors["a"].append((10.0, 3.0))

    def expected(key):
        hits = [v for i, t in rows if i == key for w in (t or "").split() if w[1:] in vectors for v in vectors[w[1:]]]
        return [round(sum(v[d] for v in hits) / len(hits), 9) for d in (0, 1)] if hits else [0.0, 0.0]

    for chars in (1 << 25, 500):
        monkeypatch.setattr(TX, "BLOCK_CHARS", chars)
        df = TX.document_vectors(docs, "doc_id", "text", wv)
        got = [(r.doc_id, [round(x, 9) for x in r.features]) for r in df.collect()]
        assert sorted(got, key=str) == sorted(((i, expected(i)) for i, _ in rows), key=str)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "Summarizer" not in plan
