"""What the learning curve holds while it runs (F1)."""

import threading
import time

import pytest

from curata.operators import curve
from curata.operators.curve import learning_curve
from curata.plans import artifacts as art
from curata.sources.sinks import persist


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).selectExpr(
        "id AS row_key", "CAST(id % 3 AS STRING) AS race", "CASE WHEN id % 7 > 0 THEN CAST(id % 5 AS INT) END AS num_procedures",
        "CAST(id % 11 AS DOUBLE) AS age_ordinal", "CAST(id % 11 > 6 AS INT) AS label")


def _fits(monkeypatch, seen):
    """Records (fits at a time, tables held besides those held before) for each forest."""
    lock, running, original = threading.Lock(), [0], curve.random_forest

    class Watched:
        def __init__(self, forest):
            self.forest = forest

        def fit(self, vectors):
            held = vectors.sparkSession.sparkContext._jsc.getPersistentRDDs().size()
            with lock:
                running[0] += 1
                seen.append((running[0], held))
            time.sleep(0.5)
            try:
                return self.forest.fit(vectors)
            finally:
                with lock:
                    running[0] -= 1

    monkeypatch.setattr(curve, "random_forest", lambda *a, **k: Watched(original(*a, **k)))


def test_large_samples_are_not_held_beside_each_other(spark, rows, monkeypatch):
    small = learning_curve(rows)
    seen = []
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    _fits(monkeypatch, seen)
    monkeypatch.setattr(curve, "CONCURRENT_ROWS", 399, raising=False)
    assert learning_curve(rows) == small
    assert [n for n, _ in seen] == [1, 1, 1, 1]
    assert max(h for _, h in seen) == before + 1        # the vectors; the training rows are released
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_a_persisted_partition_is_small_and_stays_as_objects(spark):
    held = persist(spark.range(10))
    assert held.storageLevel.deserialized and held.storageLevel.useDisk
    held.unpersist()
    assert art.ROWS_PER_PART <= 250_000
