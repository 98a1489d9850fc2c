"""Weighted classifiers (M1-M5) on preprocessed, persisted feature vectors."""

from __future__ import annotations

import time

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.spec import DT_PARAMS, LR_PARAMS, RF_PARAMS

MODEL_ORDER = ("Logistic Regression", "Decision Tree", "Random Forest")


def logistic_regression(weight_col: str | None = "class_weight", **params) -> LogisticRegression:
    """M1."""
    kw = dict(LR_PARAMS, **params)
    if weight_col:
        kw["weightCol"] = weight_col
    return LogisticRegression(featuresCol="features", labelCol="label", **kw)


def decision_tree(weight_col: str | None = "class_weight", **params) -> DecisionTreeClassifier:
    """M2."""
    kw = dict(DT_PARAMS, **params)
    if weight_col:
        kw["weightCol"] = weight_col
    return DecisionTreeClassifier(featuresCol="features", labelCol="label", **kw)


def random_forest(weight_col: str | None = "class_weight", **params) -> RandomForestClassifier:
    """M3."""
    kw = dict(RF_PARAMS, **params)
    if weight_col:
        kw["weightCol"] = weight_col
    return RandomForestClassifier(featuresCol="features", labelCol="label", **kw)


def classifiers(weight_col: str | None = "class_weight") -> dict:
    return {
        "Logistic Regression": logistic_regression(weight_col),
        "Decision Tree": decision_tree(weight_col),
        "Random Forest": random_forest(weight_col),
    }


def fit_timed(estimator, train: DataFrame):
    start = time.perf_counter()
    model = estimator.fit(train)
    return model, time.perf_counter() - start


def score(model, df: DataFrame, keep=("row_key", "label")) -> DataFrame:
    """M4: prediction, raw_prediction and probability (arrays), plus score = P(label 1)."""
    out = model.transform(df)
    cols = [c for c in keep if c in out.columns]
    return out.select(*cols, "prediction", vector_to_array("rawPrediction").alias("raw_prediction"),
                      vector_to_array("probability").alias("probability")).withColumn("score", F.col("probability")[1])


def linear_terms(model) -> list[tuple[str, int, float]]:
    """LR coefficients in long form: (term, index, value); the intercept first."""
    coef = model.coefficients.toArray().tolist()
    rows = [("intercept", -1, float(model.intercept))] + [("coefficient", i, float(v)) for i, v in enumerate(coef)]
    return rows


def importances(model) -> list[tuple[int, float]]:
    return [(i, float(v)) for i, v in enumerate(model.featureImportances.toArray().tolist())]
