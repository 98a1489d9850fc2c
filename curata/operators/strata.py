"""Preprocessing statistics of nested samples from one pass.

Nested samples differ by strata: a row belongs to the stratum of the smallest fraction that takes it.  All
that the preprocessing learns (label order, medians, standard deviations) follows from how often each
value stands in each stratum, and counts add up, so every fraction's statistics are sums over its strata
of one counted table; the training rows are read once for all fractions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.keyed import hash_uniform
from curata.operators.preprocess import assembler, encoder, feature_columns, imputer, scaler
from curata.operators.value_counts import counted_quantiles
from curata.sources.sinks import written_table
from curata.spec import CURVE_FRACTIONS, CURVE_SAMPLE_SEED, DEFAULT_SPEC, EncounterSpec


def stratum_counts(train: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, fractions: Sequence[float] = CURVE_FRACTIONS,
                   sample_seed: int = CURVE_SAMPLE_SEED) -> DataFrame:
    """(stratum, i, label, v, n): how often column ``i`` (categorical columns first) has the label or value in each stratum.

    Rows that no fraction takes are left out.  Written, so that later steps read the counts alone.
    """
    categorical, numeric = feature_columns(train, spec)
    u = hash_uniform(sample_seed, spec.row_key)
    stratum = F.lit(None).cast("int")
    for k in reversed(range(len(fractions))):
        stratum = F.when(u < fractions[k], k).otherwise(stratum)
    none = F.lit(None)
    entries = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("label"), none.cast("double").alias("v")) for i, c in enumerate(categorical)]
    entries += [F.struct(F.lit(len(categorical) + i).alias("i"), none.cast("string").alias("label"), F.col(c).cast("double").alias("v")) for i, c in enumerate(numeric)]
    rows = train.select(stratum.alias("stratum"), F.inline(F.array(*entries))).where("stratum IS NOT NULL")
    return written_table(rows.groupBy("stratum", "i", "label", "v").agg(F.count(F.lit(1)).alias("n")), "stratum-counts")


def fraction_counts(counts: DataFrame, k: int) -> DataFrame:
    """(i, label, v, n) of the sample of fraction number ``k``: the sums over its strata."""
    return counts.where(F.col("stratum") <= k).groupBy("i", "label", "v").agg(F.sum("n").alias("n"))


def label_orders(counted: DataFrame, categorical: Sequence[str]) -> list[list[tuple[str, int]]]:
    """Each categorical column's labels with their counts, the most frequent first, ties in text order."""
    found: list[list[tuple[str, int]]] = [[] for _ in categorical]
    for r in counted.where((F.col("i") < len(categorical)) & F.col("label").isNotNull()).select("i", "label", "n").collect():
        found[r["i"]].append((r["label"], r["n"]))
    return [sorted(x, key=lambda y: (-y[1], y[0])) for x in found]


def numeric_statistics(counted: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> dict[str, tuple[float | None, float]]:
    """Column -> (median, sample standard deviation once gaps hold the median)."""
    shift = len(categorical)
    values = counted.where(F.col("i") >= shift).select((F.col("i") - shift).alias("i"), "v", "n")
    medians = counted_quantiles(values, numeric, 0.5)
    fill = F.get(F.array(*[F.lit(medians[c]).cast("double") for c in numeric]), F.col("i"))
    filled = values.select("i", "n", F.when(F.col("v").isNull() | F.isnan("v"), fill).otherwise(F.col("v")).alias("v"))
    means = filled.groupBy("i").agg((F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("mean"))
    spread = filled.join(means, "i").groupBy("i").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))).alias("m2")).collect()
    deviations = {r["i"]: math.sqrt(r["m2"] / (r["rows"] - 1)) if r["m2"] is not None and r["rows"] > 1 else 0.0 for r in spread}
    return {c: (medians[c], deviations.get(i, 0.0)) for i, c in enumerate(numeric)}


def fit_from_counts(counts: DataFrame, k: int, train: DataFrame, spec: EncounterSpec = DEFAULT_SPEC) -> PipelineModel:
    """The preprocessing fitted on the sample of fraction number ``k``, from the counts; of ``train`` only the columns' names are used.

    The stages are MLlib's, fitted on a few rows that have exactly these statistics.
    """
    categorical, numeric = feature_columns(train, spec)
    spark = train.sparkSession
    counted = fraction_counts(counts, k)
    orders = label_orders(counted, categorical)
    statistics = numeric_statistics(counted, categorical, numeric)
    size = counted.where(F.col("i") == len(categorical)).agg(F.sum("n")).first()[0] or 0
    deviations = [statistics[c][1] for c in numeric]
    deviations += [math.sqrt(max(0.0, (n - n * n / size) / (size - 1))) if size > 1 else 0.0 for labels in orders for _, n in labels]
    stages = []
    if categorical:
        indexers = [StringIndexerModel.from_labels([x for x, _ in labels], inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep")
                    for c, labels in zip(categorical, orders)]
        blank = spark.createDataFrame([tuple(None for _ in categorical)], ", ".join(f"`{c}` string" for c in categorical))
        stages += [*indexers, encoder(categorical).fit(PipelineModel(indexers).transform(blank))]
    medians = spark.createDataFrame([tuple(statistics[c][0] for c in numeric)], ", ".join(f"`{c}` double" for c in numeric))
    half = [s / math.sqrt(2) for s in deviations]
    pair = spark.createDataFrame([(Vectors.dense(half),), (Vectors.dense([-x for x in half]),)], ["features_raw"])
    stages += [imputer(numeric).fit(medians), assembler(categorical, numeric), scaler().fit(pair)]
    return PipelineModel(stages)


def curve_statistics(train: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, fractions: Sequence[float] = CURVE_FRACTIONS,
                     sample_seed: int = CURVE_SAMPLE_SEED) -> DataFrame:
    """(fraction, column_name, n_labels, median, deviation) of every input column in every nested sample, from one read of ``train``."""
    categorical, numeric = feature_columns(train, spec)
    counts = stratum_counts(train, spec, fractions, sample_seed)
    rows = []
    for k, f in enumerate(fractions):
        counted = fraction_counts(counts, k)
        rows += [(float(f), c, len(labels), None, None) for c, labels in zip(categorical, label_orders(counted, categorical))]
        rows += [(float(f), c, None, m, s) for c, (m, s) in numeric_statistics(counted, categorical, numeric).items()]
    return train.sparkSession.createDataFrame(rows, "fraction double, column_name string, n_labels int, median double, deviation double")
