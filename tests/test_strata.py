"""Preprocessing of nested samples from one counted table equals a fit on each sample."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from curata.operators import strata
from curata.operators.preprocess import fit_preprocessing
from curata.operators.sampling import nested_sample, split_by_key
from curata.plans.artifacts import artifacts
from curata.spec import CURVE_FRACTIONS, CURVE_SAMPLE_SEED, DEFAULT_SPEC as SPEC
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def train(spark):
    rows = artifacts(spark, SF_SMALL).prepared
    return split_by_key(rows, SPEC.row_key, SPEC.train_fraction, SPEC.split_seed)[0]


def test_every_fraction_equals_its_own_fit(train):
    counts = strata.stratum_counts(train)
    for k, f in enumerate(CURVE_FRACTIONS):
        sample = nested_sample(train, f, SPEC.row_key, CURVE_SAMPLE_SEED)
        mine, own = strata.fit_from_counts(counts, k, train), fit_preprocessing(sample, SPEC)
        assert [list(x.labels) for x in mine.stages[:len(SPEC.categorical_columns)]] == [list(x) for x in own.stages[0].labelsArray]
        assert list(mine.stages[-4].categorySizes) == list(own.stages[-4].categorySizes)
        assert mine.stages[-3].surrogateDF.first() == own.stages[-3].surrogateDF.first()
        assert list(mine.stages[-1].std) == pytest.approx(list(own.stages[-1].std), rel=1e-9, abs=1e-12)
        vector = vector_to_array("features").alias("x")
        both = mine.transform(train).select(SPEC.row_key, vector).join(own.transform(train).select(SPEC.row_key, vector_to_array("features").alias("y")), SPEC.row_key)
        apart = F.exists(F.zip_with("x", "y", lambda a, b: F.abs(a - b) > 1e-9), lambda z: z)
        assert both.count() == train.count() and both.where(apart).count() == 0


def test_samples_without_rows(train):
    counts = strata.stratum_counts(train.limit(0))
    assert counts.count() == 0
    assert strata.label_orders(strata.fraction_counts(counts, 0), ["gender"]) == [[]]
    assert strata.numeric_statistics(strata.fraction_counts(counts, 0), ["gender"], ["x"]) == {"x": (None, 0.0)}


def test_rows_that_no_fraction_takes_are_left_out(train):
    counts = strata.stratum_counts(train, fractions=(0.2, 0.5))
    taken = nested_sample(train, 0.5, SPEC.row_key, CURVE_SAMPLE_SEED).count()
    assert counts.where("i = 0").agg(F.sum("n")).first()[0] == taken
