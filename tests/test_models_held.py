"""What a run of models holds and reads (F2): one fit at a time on large tables, one draw of the split, rows counted without a job."""

import threading
import time

from curata.operators import classifiers as clf
from curata.plans import artifacts as art
from curata.plans.artifacts import Artifacts
from curata.sources import files
from curata.sources.files import row_count


def _watched(monkeypatch, held):
    lock, running, most, original = threading.Lock(), [0], [0], clf.fit_timed

    def fit(estimator, train):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
            held.append(train.sparkSession.sparkContext._jsc.getPersistentRDDs().size())
        time.sleep(0.5)
        try:
            return original(estimator, train)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(clf, "fit_timed", fit)
    return most


def test_large_fits_follow_each_other_without_the_prepared_rows(spark, sf_small, monkeypatch):
    held, before = [], spark.sparkContext._jsc.getPersistentRDDs().size()
    most = _watched(monkeypatch, held)
    monkeypatch.setattr(art, "CONCURRENT_ROWS", 10, raising=False)
    run = Artifacts(spark, sf_small, models_only=True)
    try:
        run.fit_all()
        assert most == [1] and held == [before + 1] * 3         # the vectors alone
        assert run.predictions("Decision Tree").count() == run.test_vectors.count() > 0
    finally:
        run.release()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_the_split_is_drawn_once(spark, sf_small):
    run = Artifacts(spark, sf_small)
    try:
        assert run.tagged.storageLevel.useMemory and "split" not in run.prepared.columns
        assert run.prepared.count() == run.tagged.count()
        plan = run.prepared._jdf.queryExecution().withCachedData().toString()
        assert "InMemoryRelation" in plan
        drawn = run.tagged.where("split = 'train'")._jdf.queryExecution().withCachedData()
        assert "md5" not in drawn.toString().split("InMemoryRelation")[0]
    finally:
        run.release()


def test_rows_of_files_are_counted_without_a_job(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "some rows.parquet")
    spark.range(0, 1000, 1, 3).selectExpr("id", "id % 7 AS v").write.parquet(path)
    table = spark.read.parquet(path)
    context = spark.sparkContext
    context.setJobGroup("row-count", "")
    assert row_count(table) == row_count(table.select("v")) == 1000
    assert not context.statusTracker().getJobIdsForGroup("row-count")
    context.setJobGroup("tests", "")
    assert row_count(table.where("v = 1")) == table.where("v = 1").count() and row_count(table.limit(5)) == 5
    assert row_count(table.limit(0)) == 0 and row_count(spark.range(4)) == 4 and row_count(table.union(table)) == 2000
    monkeypatch.setattr(files, "FOOTERS", 2)
    assert row_count(table) == 1000
