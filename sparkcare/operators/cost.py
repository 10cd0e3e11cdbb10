"""Insurance cost model (W3: P8, P9, M1-M8, A16).

Spark ML: ``VectorAssembler`` + ``LinearRegression(solver='normal')`` - one
distributed pass builds the normal equations (the Gram matrix is features x
features, independent of row count).  The train/test split is a hash of a row
key, so it is the same on every run and every partitioning (``randomSplit``
depends on partition layout).
"""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encode import encode_map

# Fixed category codes of the cost study.
GENDER_CODES = {"male": 0, "female": 1}
SMOKER_CODES = {"yes": 1, "no": 0}
REGION_CODES = {"southwest": 1, "southeast": 2, "northwest": 3, "northeast": 4}

FEATURES = ["age", "bmi", "children", "smoker", "region"]
LABEL = "charges"

# The five new customer profiles scored by the study (age, bmi, children, smoker, region).
NEW_PROFILES = [
    (50.0, 25.0, 2, 0, 2),
    (50.0, 34.0, 0, 1, 2),
    (50.0, 17.0, 4, 1, 2),
    (17.0, 31.0, 0, 1, 4),
    (17.0, 23.0, 0, 0, 4),
]


def encode_categories(df: DataFrame) -> DataFrame:
    """Gender, smoker, region text -> fixed integer codes (unmapped -> null)."""
    return (df.withColumn("gender", encode_map("gender", GENDER_CODES))
              .withColumn("smoker", encode_map("smoker", SMOKER_CODES))
              .withColumn("region", encode_map("region", REGION_CODES)))


def cost_features(encoded: DataFrame) -> DataFrame:
    """Drop the target and the weakly correlated gender -> features; keep label."""
    return encoded.select(*FEATURES, F.col(LABEL).alias("label"))


def hash_bucket(key, buckets: int = 10) -> Column:
    """Deterministic bucket of a key: first 8 hex digits of md5(text) mod ``buckets``."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets)


def hash_split(df: DataFrame, key, train_buckets: int = 7, buckets: int = 10) -> DataFrame:
    """M2: adds ``is_train`` (70/30 by default) from a hash of ``key``."""
    return df.withColumn("is_train", hash_bucket(key, buckets) < train_buckets)


def fit_cost_model(train: DataFrame, features: list[str] = FEATURES) -> LinearRegressionModel:
    """M3: ordinary least squares on the features (rows with a null feature are skipped)."""
    data = train.dropna(subset=[*features, "label"])
    asm = VectorAssembler(inputCols=features, outputCol="features")
    return LinearRegression(featuresCol="features", labelCol="label", solver="normal",
                            regParam=0.0, elasticNetParam=0.0).fit(asm.transform(data))


def predict(model: LinearRegressionModel, df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """M4/M6: adds ``prediction``; null for a row with a null feature, as such rows are
    skipped in training too."""
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    scored = model.transform(asm.transform(df)).drop("features")
    missing = F.array_contains(F.array(*(F.col(c).isNull() for c in features)), True)
    return scored.withColumn("prediction", F.when(~missing, F.col("prediction")))


def r2(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """R^2 with Spark ML's evaluator."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="r2").evaluate(pred)


def r2_frame(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A16 as one aggregate pass over the scored rows: 1 - SS_res / SS_tot, their number
    ``n`` and that of the rows without label or prediction, ``unscored``."""
    y = F.when(F.col(prediction).isNotNull(), F.col(label))
    p = F.col(prediction)
    g = pred.agg(F.sum((y - p) * (y - p)).alias("ss_res"), (F.var_pop(y) * F.count(y)).alias("ss_tot"),
                 F.count(y).alias("n"), F.count("*").alias("rows"))
    return g.select((1 - F.col("ss_res") / F.col("ss_tot")).alias("r2"), "n", (F.col("rows") - F.col("n")).alias("unscored"))


def simple_regression(df: DataFrame, y: str, x: str, digits: int = 6) -> DataFrame:
    """M8: one-variable least squares as SQL aggregates (slope, intercept, R^2)."""
    return df.agg(F.round(F.regr_slope(y, x), digits).alias("slope"),
                  F.round(F.regr_intercept(y, x), digits).alias("intercept"),
                  F.round(F.regr_r2(y, x), digits).alias("r2"),
                  F.regr_count(y, x).alias("n"))


def score_new(model: LinearRegressionModel, spark, profiles=NEW_PROFILES) -> DataFrame:
    """Predicted cost of new customer profiles, rounded to cents."""
    new = spark.createDataFrame(profiles, "age double, bmi double, children int, smoker int, region int")
    return predict(model, new).withColumn("predicted_cost", F.round("prediction", 2)).drop("prediction")
