"""Partitions follow the rows; the variants of the resilience table share their counted rows."""

from pyspark.sql import functions as F

from curata.operators import classifiers as clf
from curata.plans import artifacts as art
from curata.sources.sinks import in_parts


def test_partitions_have_bounded_rows(spark):
    rows = spark.range(0, 4000, 1, 2).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), (F.col("id") % 3).alias("v"))
    parted = in_parts(rows, 100)
    sizes = parted.groupBy(F.spark_partition_id()).count().collect()
    assert parted.rdd.getNumPartitions() == 40 and max(r["count"] for r in sizes) < 200
    assert sorted(map(str, parted.collect())) == sorted(map(str, rows.collect()))
    assert in_parts(rows, 2000).rdd.getNumPartitions() == 2 and in_parts(rows.limit(0), 10).count() == 0


def test_prepared_rows_are_in_bounded_partitions(spark, sf_small, monkeypatch):
    monkeypatch.setattr(art, "ROWS_PER_PART", 50, raising=False)
    run = art.Artifacts(spark, sf_small)
    try:
        rows = run.prepared.count()
        assert run.prepared.rdd.getNumPartitions() >= rows / 50
    finally:
        run.release()


def test_variants_share_counted_rows(spark, sf_small, monkeypatch):
    built, used = [], []
    monkeypatch.setattr(art.CountedRows, "build", classmethod(lambda cls, df, spec, *a: built.append(df) or object()))
    monkeypatch.setattr(art.Artifacts, "leaderboard_rows", lambda self: used.append((self.faults, self.valid_max, self.counted)) or spark.createDataFrame(
        [(1, clf.MODEL_ORDER[0], 0.5, 0.5, 0.5, 0.5, 0.5)], "position int, model string, a double, b double, c double, d double, e double"))
    assert art.resilience(spark, sf_small).count() == len(art.VARIANTS)
    assert len(built) == 2
    assert [(f, m) for f, m, _ in used] == [(False, None), (True, None), (True, 14)]
    assert used[1][2] is used[2][2] is not used[0][2]
