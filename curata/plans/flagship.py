"""Flagship plan: corrupt -> clean -> derive -> split -> weighted logistic
regression -> metrics of the held-out rows, as one small result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.plans.artifacts import artifacts
from curata.spec import DEFAULT_SPEC, EncounterSpec


def readmission_report(spark: SparkSession, sf_dir: str, model: str = "Logistic Regression",
                       spec: EncounterSpec = DEFAULT_SPEC) -> DataFrame:
    a = artifacts(spark, sf_dir, spec)
    row = a.metrics_row(model)
    return row.select("model", *[F.round(c, 4).alias(c) for c in
                                 ("auc_roc", "accuracy", "f1", "weighted_precision", "weighted_recall")])
