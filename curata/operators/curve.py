"""Learning curve (L1): growing nested samples, a forest fitted on each.

Samples are nested (u(44, key) < fraction, so each sample contains the
smaller ones) and split by a different seed (u(42, key) < 0.8): with one
seed for both, every sampled row of the 25% step would be a training row.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions.exprs import existing
from curata.functions.keyed import hash_uniform
from curata.operators.classifiers import random_forest, score
from curata.operators.evaluation import evaluate
from curata.operators.preprocess import preprocessing_stages
from curata.operators.sampling import nested_sample, split_by_key
from curata.sources.sinks import persist
from curata.spec import CURVE_FRACTIONS, CURVE_RF_PARAMS, CURVE_SAMPLE_SEED, DEFAULT_SPEC, EncounterSpec

#: Up to so many rows the fractions run concurrently, as series of small jobs; beyond, one fraction fills the cores.
CONCURRENT_ROWS = 1_000_000


def curve_rows(df: DataFrame, fractions: Sequence[float] = CURVE_FRACTIONS, key: str = "row_key",
               sample_seed: int = CURVE_SAMPLE_SEED, split_seed: int = 42, train_fraction: float = 0.8) -> DataFrame:
    """(fraction, n_rows, n_train) for every fraction from ONE aggregate."""
    u_sample = hash_uniform(sample_seed, key)
    in_train = hash_uniform(split_seed, key) < train_fraction
    aggs = []
    for i, f in enumerate(fractions):
        aggs += [F.count_if(u_sample < f).alias(f"n{i}"), F.count_if((u_sample < f) & in_train).alias(f"t{i}")]
    wide = df.agg(*aggs)
    entries = []
    for i, f in enumerate(fractions):
        entries += [F.lit(float(f)), F.col(f"n{i}"), F.col(f"t{i}")]
    return wide.select(F.stack(F.lit(len(fractions)), *entries).alias("fraction", "n_rows", "n_train"))


def learning_curve(df: DataFrame, spec: EncounterSpec = DEFAULT_SPEC, fractions: Sequence[float] = CURVE_FRACTIONS,
                   sample_seed: int = CURVE_SAMPLE_SEED, weight_col: str | None = None, parallelism: int | None = None) -> list[dict]:
    """Fit preprocessing + forest on the training part of each sample and
    evaluate on its test part; one dict per fraction (rows and metrics).

    Each fraction's training rows, then its vectors, then its scores are
    persisted, so that each is computed once, and released as soon as the next
    is there.  ``parallelism`` fractions run at a time; without it, four up to
    ``CONCURRENT_ROWS`` rows and one beyond, so that large samples are not held
    beside each other.
    """
    if parallelism is None:
        parallelism = 4 if df.count() <= CONCURRENT_ROWS else 1

    def point(f: float) -> dict:
        sample = nested_sample(df, f, spec.row_key, sample_seed)
        train, test = split_by_key(sample, spec.row_key, spec.train_fraction, spec.split_seed)
        columns = [*spec.categorical_columns, *spec.numeric_columns, spec.label, spec.row_key, *([weight_col] if weight_col else [])]
        held = []

        def keep(table: DataFrame) -> DataFrame:
            held.append(persist(table))
            return table

        try:
            train = keep(train.select(*existing(train, columns)))
            prep = Pipeline(stages=preprocessing_stages(train, spec)).fit(train)
            vectors = keep(prep.transform(train).select("features", spec.label, *([weight_col] if weight_col else [])))
            vectors.count()
            train.unpersist()
            model = random_forest(weight_col, **CURVE_RF_PARAMS).fit(vectors)
            vectors.unpersist()
            scored = keep(score(model, prep.transform(test)).select(spec.label, "prediction", "score"))
            m = evaluate(scored, spec.label, "prediction", "score").first()
        finally:
            for table in held:
                table.unpersist()
        return {"fraction": float(f), "auc_roc": m["auc_roc"], "f1": m["f1"], "accuracy": m["accuracy"]}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(point, fractions))
