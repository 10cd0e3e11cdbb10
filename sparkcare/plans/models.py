"""Proof queries for the cost model (W3) and text vectors / classification."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators import cost as C
from ..operators import text as TX
from ..operators.svm import fit_pairs, predict
from ..session import stored_copy
from . import oracle_roles as R
from . import roles
from .registry import register


@register("hash_split", """
SELECT o_orderkey, CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 10 < 7 AS is_train
FROM orders""")
def q_hash_split(t, spark):
    """M2: deterministic 70/30 split by a hash of the order key."""
    return C.hash_split(t["orders"].select("o_orderkey"), "o_orderkey")


@register("r2_simple", f"""
SELECT round(regr_slope(charges, age), 6) AS slope, round(regr_intercept(charges, age), 6) AS intercept,
  round(regr_r2(charges, age), 6) AS r2, CAST(regr_count(charges, age) AS BIGINT) AS n
FROM ({R.INSURANCE})""")
def q_r2_simple(t, spark):
    """One-variable least squares of charges on age as SQL aggregates."""
    return C.simple_regression(roles.insurance(t), "charges", "age")


def _split_features(t):
    """Encoded insurance rows with a 70/30 split on the line key (order key, line number)."""
    li = t["lineitem"]
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    rows = li.select(key.alias("_k"), F.col("l_quantity").alias("age"), F.col("l_discount").alias("bmi"),
                     F.col("l_linenumber").alias("children"), F.col("l_extendedprice").alias("charges"),
                     F.when(F.col("l_linestatus") == "F", "yes").otherwise("no").alias("smoker"),
                     F.when(F.col("l_returnflag") == "A", "female").otherwise("male").alias("gender"),
                     F.element_at(F.array(*[F.lit(r) for r in roles.REGIONS]),
                                  (F.col("l_suppkey") % len(roles.REGIONS) + 1).cast("int")).alias("region"))
    enc = C.encode_categories(C.hash_split(rows, "_k"))
    return enc.select(*C.FEATURES, F.col("charges").alias("label"), "is_train")


def _model(t):
    data = _split_features(t)
    return C.fit_cost_model(data.where("is_train")), data


_COST_ROWS = """SELECT l_quantity AS age, l_discount AS bmi, l_linenumber AS children,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS smoker, l_suppkey % 4 + 1 AS region, l_extendedprice AS label,
  CAST(('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 8)) AS BIGINT) % 10 < 7 AS is_train FROM lineitem"""


def _solved_sql() -> str:
    """CTEs that end in ``beta`` (one row: b0.. and the intercept): the normal equations
    of the centred training rows, solved by elimination, one CTE per pivot."""
    k = len(C.FEATURES)
    moments = [f"covar_pop({x}, {y}) AS c{i}{j}" for i, x in enumerate(C.FEATURES)
               for j, y in enumerate([*C.FEATURES, "label"])]
    means = [f"avg({x}) AS m{i}" for i, x in enumerate([*C.FEATURES, "label"])]
    ctes = [f"ins AS ({_COST_ROWS})", f"e0 AS (SELECT {', '.join(moments + means)} FROM ins WHERE is_train)"]
    for p in range(k):
        cells = [f"c{i}{j} - c{i}{p} * c{p}{j} / c{p}{p} AS c{i}{j}" if i != p else f"c{i}{j}"
                 for i in range(k) for j in range(k + 1)]
        ctes.append(f"e{p + 1} AS (SELECT {', '.join(cells)}, {', '.join(f'm{i}' for i in range(k + 1))} FROM e{p})")
    ctes.append(f"b AS (SELECT {', '.join(f'c{i}{k} / c{i}{i} AS b{i}' for i in range(k))}, "
                f"{', '.join(f'm{i}' for i in range(k + 1))} FROM e{k})")
    ctes.append(f"beta AS (SELECT *, m{k} - {' - '.join(f'b{i} * m{i}' for i in range(k))} AS b FROM b)")
    return "WITH " + ", ".join(ctes)


_PREDICTED = "b + " + " + ".join(f"b{i} * {x}" for i, x in enumerate(C.FEATURES))
_PROFILES = ", ".join(map(str, C.NEW_PROFILES))


@register("cost_fit", _solved_sql() + f""",
r AS (SELECT 1 - sum((label - ({_PREDICTED})) ** 2) / (var_pop(label) * count(*)) AS r2 FROM ins, beta WHERE NOT is_train)
""" + " UNION ALL ".join(f"SELECT '{x}' AS term, round(b{i}, 4) AS value FROM beta" for i, x in enumerate(C.FEATURES)) + """
UNION ALL SELECT 'intercept', round(b, 4) FROM beta UNION ALL SELECT 'r2_test', round(r2, 4) FROM r""")
def q_cost_fit(t, spark):
    """M1/M3/M5: fitted coefficients, intercept and test R^2."""
    model, data = _model(t)
    r2 = C.r2_frame(C.predict(model, data.where(~F.col("is_train")))).select(F.lit("r2_test").alias("term"), F.col("r2").alias("value"))
    rows = [(f, float(c)) for f, c in zip(C.FEATURES, model.coefficients)] + [("intercept", float(model.intercept))]
    both = spark.createDataFrame(rows, "term string, value double").unionByName(r2)
    return both.select("term", F.round("value", 4).alias("value"))


@register("cost_predict", _solved_sql() + f" SELECT label, round({_PREDICTED}, 2) AS prediction FROM ins, beta WHERE NOT is_train")
def q_cost_predict(t, spark):
    """M4/M6: actual vs predicted charges on the test rows."""
    model, data = _model(t)
    return C.predict(model, data.where(~F.col("is_train"))).select("label", F.round("prediction", 2).alias("prediction"))


@register("cost_score_new", _solved_sql() + f""" SELECT p.*, round({_PREDICTED}, 2) AS predicted_cost
FROM (VALUES {_PROFILES}) AS p(age, bmi, children, smoker, region), beta""")
def q_cost_score_new(t, spark):
    """Predicted cost of the five new customer profiles."""
    model, _ = _model(t)
    return C.score_new(model, spark)


@register("cost_features", f"SELECT age, bmi, children, smoker, region, label FROM ({_COST_ROWS})")
def q_cost_features(t, spark):
    """Encoded features and label, without the dropped columns."""
    return C.cost_features(C.encode_categories(roles.insurance(t)))


@register("text_vectors", """
WITH e AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS vid,
           list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1048576) AS BIGINT)) AS v FROM embeddings),
n AS (SELECT count(*) AS n, max(len(v)) AS dims FROM e),
tok AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z'']+')) AS w FROM documents),
tf AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % (SELECT n FROM n) AS vid, count(*) AS tf
       FROM tok WHERE w <> '' GROUP BY ALL),
x AS (SELECT doc_id, tf, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM tf JOIN e USING (vid)),
m AS (SELECT doc_id, i, CAST(sum(v * tf) AS DOUBLE) / CAST(sum(tf) * 1048576 AS DOUBLE) AS v FROM x GROUP BY doc_id, i),
l AS (SELECT doc_id, list(v ORDER BY i) AS vector FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(l.vector, list_resize([]::DOUBLE[], (SELECT dims FROM n), 0.0)) AS vector
FROM documents d LEFT JOIN l USING (doc_id)""")
def q_text_vectors(t, spark):
    """Mean word vector of every document (word vectors hashed from embeddings)."""
    docs = t["documents"].select("doc_id", "text")
    dv = TX.hashed_document_vectors(docs, "doc_id", "text", t["embeddings"], "vec_id", "embedding")
    return dv.select("doc_id", F.col("features").alias("vector"))


@register("text_classify", """
SELECT (SELECT count(*) FROM documents) AS n_documents,
       0 AS n_unknown_class, true AS better_than_majority""")
def q_text_classify(t, spark):
    """Every document's text as a vector, a one-vs-rest linear SVM over the four
    languages fitted on all training documents, a class for every document; checks: each
    predicted class is a training class, and more of the documents not trained on are
    right than the most frequent class has."""
    vectors = TX.hashed_document_vectors(t["documents"].select("doc_id", "text"), "doc_id", "text",
                                         t["embeddings"], "vec_id", "embedding")
    classes = [r.lang for r in t["documents"].select("lang").dropna().distinct().orderBy("lang").collect()]
    label = F.array_position(F.array(*map(F.lit, classes)), F.col("lang")) - 1
    rows = stored_copy(C.hash_split(vectors.join(  # read by every pass of the fit
        t["documents"].select("doc_id", label.cast("double").alias("label")), "doc_id"), "doc_id"))
    rows = rows.withColumn("features", array_to_vector("features"))
    train = rows.where(F.col("is_train") & F.col("label").isNotNull())
    model = TX.train_classifier(train.select("features", "label"))
    got = TX.classify(model, rows)
    test = (~F.col("is_train")) & F.col("label").isNotNull()
    hits = F.count_if(test & (F.col("label") == F.col("prediction")))
    most = F.greatest(*(F.count_if(test & (F.col("label") == float(i))) for i in range(len(classes))))
    return got.agg(F.count("*").alias("n_documents"),
                   F.count_if(~F.col("prediction").isin([float(i) for i in range(len(classes))])).cast("int").alias("n_unknown_class"),
                   (hits > most).alias("better_than_majority"))


@register("text_classify_pairs", """
SELECT lang, count(*) AS n_documents,
  count(*) FILTER (CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10 < 7) AS n_train,
  count(*) FILTER (false) AS n_unknown_class, CASE WHEN lang IS NOT NULL THEN true END AS mostly_right
FROM documents GROUP BY lang""")
def q_text_classify_pairs(t, spark):
    """Documents as means of word vectors learned from the corpus, one linear SVM for each
    pair of languages, all pairs fitted in one pass a round, and a class by vote for every
    document; by language the documents, those trained on, and whether most of the others are
    right."""
    rows, classes = _voted(t["documents"])
    test = ~F.col("is_train")
    hits, all_ = F.count_if(test & (F.col("label") == F.col("prediction"))), F.count_if(test)
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if("is_train").alias("n_train"),
        F.count_if(~F.col("prediction").between(0, len(classes) - 1)).alias("n_unknown_class"),
        F.when(F.col("label").isNotNull(), 2 * hits > all_).alias("mostly_right")).select(
        F.get(F.array(*map(F.lit, classes)), F.col("label")).alias("lang"), "n_documents", "n_train", "n_unknown_class", "mostly_right")


def _voted(docs):
    """doc_id, label, is_train, prediction, votes of every document, and the labels."""
    words = stored_copy(TX.learned_vectors(docs, "text"))
    classes = [r.lang for r in docs.select("lang").dropna().distinct().orderBy("lang").collect()]  # the label set
    label = F.array_position(F.array(*map(F.lit, classes)), F.col("lang")) - 1
    rows = docs.select("doc_id").join(docs.select("doc_id", label.cast("int").alias("label")), "doc_id")
    rows = TX.document_vectors(docs.select("doc_id", "text"), "doc_id", "text", words, count_col="n", unit=True, rows=rows)
    rows = rows.select("doc_id", vector_to_array("features").alias("features"), "label")
    rows = stored_copy(C.hash_split(rows, "doc_id"))
    model = fit_pairs(rows.where("is_train"), len(classes))
    return predict(model, rows).select("doc_id", "label", "is_train", "prediction", "votes"), classes


@register("text_normalize", "SELECT doc_id, upper(source) AS source_txt, upper(lang) AS lang_txt FROM documents")
def q_text_normalize(t, spark):
    """Upper-case normalisation of the code columns."""
    return t["documents"].select("doc_id", F.upper("source").alias("source_txt"), F.upper("lang").alias("lang_txt"))
