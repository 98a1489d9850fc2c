"""Counted rows and counted values: cleaning, histograms, medians and ranks from one table each."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from curata.functions import blocks
from curata.operators import cleaning as cl
from curata.operators import preprocess as pp
from curata.operators import profiling as pf
from curata.operators import value_counts as vc
from curata.sources.sinks import BucketedTable, written_table
from curata.spec import DEFAULT_SPEC as SPEC


@pytest.fixture(scope="module")
def rows(spark):
    """Duplicates, NULLs, sentinels, an invalid category and a sparse column."""
    data = [(i, i % 7, ["a", "b", "?", None][i % 4], ["Male", "Female", "Unknown/Invalid"][i % 3], f"[{i % 2}0-10)", "x" if i % 10 == 0 else None,
             i % 5 if i % 11 else None, ["<30", "NO", None][i % 3 if i % 13 else 2]) for i in range(400)]
    return spark.createDataFrame(data, "encounter_id long, patient_nbr long, race string, gender string, age string, weight string, time_in_hospital int, readmitted string")


def test_clean_equals_the_steps_one_by_one(rows):
    step = cl.drop_sparse_columns(cl.sentinels_to_null(rows, SPEC.sentinels), SPEC.sparse_threshold, protect=[SPEC.key])
    step = cl.drop_identifiers(step, SPEC.id_columns, key=SPEC.key, key_alias=SPEC.row_key)
    step = cl.drop_invalid_category(cl.drop_null_critical(step, SPEC.critical_columns), SPEC.category_column, SPEC.invalid_category)
    step = cl.cap_outliers(cl.encode_target(cl.dedup_rows(step), SPEC.target, SPEC.positive_target, SPEC.label), SPEC.cap_columns, SPEC.cap_quantile)
    got = cl.clean(rows)
    assert got.columns == step.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, step.collect()))


def test_clean_and_audit_share_the_table_and_persist_nothing(spark, rows):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    counted = cl.CountedRows.build(rows)
    cleaned, audit = cl.clean(rows, counted=counted), cl.cleaning_audit(rows, counted=counted).orderBy("step_no").collect()
    assert audit[-1].rows_out == cleaned.count()
    assert audit[0].rows_in == rows.count()
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_clean_without_rows_or_key(rows):
    assert cl.clean(rows.limit(0)).count() == 0
    assert [r.rows_out for r in cl.cleaning_audit(rows.limit(0)).collect()] == [0, 0, 0, 0]
    unkeyed = cl.clean(rows, keep_key=False)
    assert SPEC.row_key not in unkeyed.columns and unkeyed.count() == unkeyed.distinct().count()
    with pytest.raises(ValueError):
        cl.clean(rows.drop("gender"))


def test_sparse_critical_column_filters_nothing(spark):
    data = [(i, None if i % 2 else "x", "Male", "NO") for i in range(10)]
    df = spark.createDataFrame(data, "encounter_id long, age string, gender string, readmitted string")
    assert [r.rows_out for r in cl.cleaning_audit(df).orderBy("step_no").collect()] == [10, 10, 10, 1]


def numbers(spark, n=5000, seed=1):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), np.round(rng.exponential(3, size=n), 1)
    data = [(i, float(x) if i % 7 else None, float(y) if i % 50 else float("nan"), 3.0, None) for i, (x, y) in enumerate(zip(a, b))]
    data += [(n, float("inf"), -1.0, 3.0, None)]
    return spark.createDataFrame(data, "k long, a double, b double, c double, d double")


def test_histogram_equals_numpy(spark):
    df = numbers(spark)
    columns = ["a", "b", "c", "d"]
    counted = written_table(vc.value_counts(df, columns), "t")
    got = {(r.column_name, r.bin): r.n for r in vc.counted_histogram(counted, columns, 30).collect()}
    table = df.toPandas()
    for c in columns:
        x = table[c].astype(float).to_numpy()
        odd = int(np.isinf(x).sum()) + (df.where(F.isnan(c)).count() if c in "ab" else 0)
        assert got.get((c, -1), 0) == odd
        x = x[np.isfinite(x)]
        want = np.histogram(x, 30)[0] if len(x) else []
        assert [got.get((c, i), 0) for i in range(len(want))] == list(want)
    by_rows = sorted(map(tuple, pf.histogram(df, columns, 30).collect()), key=repr)
    assert by_rows == sorted(map(tuple, vc.counted_histogram(counted, columns, 30).collect()), key=repr)


@pytest.mark.parametrize("per_block", [blocks.ROWS_PER_BLOCK, 300])
def test_quantiles_are_exact(spark, monkeypatch, per_block):
    monkeypatch.setattr(blocks, "ROWS_PER_BLOCK", per_block)
    monkeypatch.setattr(vc, "ROWS_PER_BLOCK", per_block)
    df = numbers(spark)
    table = df.toPandas()
    for q in (0.01, 0.5, 0.99, 1.0):
        got = cl.exact_quantiles(df, ["a", "b", "c", "d"], q)
        for c in "abc":
            x = np.sort(table[c].astype(float).dropna().to_numpy())
            assert got[c] == x[max(0, int(np.ceil(q * len(x) - 1e-9)) - 1)], (c, q)
        assert got["d"] is None


def test_median_is_exact_where_the_sketch_is_not(spark):
    df = spark.createDataFrame([(float(i * i % 100_003),) if i % 4 else (None,) for i in range(60_000)], "x double").repartition(6)
    median = cl.exact_quantile(df, "x", 0.5)
    exact = pp.exact_imputer(df, ["x"])
    assert {r.x_imp for r in exact.transform(df).where("x IS NULL").collect()} == {median}
    values = np.sort([r.x for r in df.where("x IS NOT NULL").collect()])
    assert median == values[(len(values) + 1) // 2 - 1]
    rough = pp.Imputer(inputCols=["x"], outputCols=["y"], strategy="median", relativeError=0.05).fit(df).surrogateDF.first()[0]
    assert rough != median
    with pytest.raises(ValueError):
        pp.exact_imputer(df.where("x IS NULL"), ["x"])


def test_ranks_equal_the_indexer(spark):
    values = [f"v{i * i % 3001}" for i in range(20_000)] + ["hot"] * 9000 + [None] * 500
    df = spark.createDataFrame(list(enumerate(values)), "k long, word string").repartition(5)
    ranks = vc.value_ranks(df, "word")
    assert sorted(r["rank"] for r in ranks.select("rank").collect()) == list(range(ranks.count()))
    mine = vc.index_by_ranks(df, "word", ranks, "mine")
    model = StringIndexer(inputCol="word", outputCol="theirs", handleInvalid="keep").fit(df)
    both = model.transform(mine)
    assert both.count() == df.count() and both.where("mine <> theirs").count() == 0
    unseen = spark.createDataFrame([(1, "never"), (2, None), (3, "hot")], "k long, word string")
    assert sorted((r.k, r.mine) for r in vc.index_by_ranks(unseen, "word", ranks, "mine").collect()) == [(1, float(ranks.count())), (2, float(ranks.count())), (3, 0.0)]
    empty = vc.value_ranks(df.limit(0), "word")
    assert empty.count() == 0 and [r.mine for r in vc.index_by_ranks(unseen, "word", empty, "mine").collect()] == [0.0] * 3


def test_correlations_by_null_pattern(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 3))
    x[:, 1] += x[:, 0]
    x[:, 2] = 1e9 + x[:, 2] * 1e-1 + x[:, 1]          # a spread that is small beside the mean
    data = [tuple(None if (i + 3 * j) % 11 == 0 else float(v) for j, v in enumerate(r)) + (5.0,) for i, r in enumerate(x)]
    data += [(float("nan"), 1.0, None, 5.0)]
    df = spark.createDataFrame(data, "a double, b double, c double, flat double")
    got = {(r.col_a, r.col_b): r["corr"] for r in pf.correlations(df, ["a", "b", "c", "flat"]).collect()}
    want = df.toPandas().astype(float).corr()
    assert len(got) == 16
    for p in "abc":
        for q in "abc":
            assert got[p, q] == pytest.approx(want.loc[p, q], abs=1e-6)
        assert got[p, "flat"] is None and got["flat", p] is None
    assert got["flat", "flat"] is None
    assert pf.pattern_moments(df, ["a", "b", "c"]).count() <= 8


def test_bucketed_tables_join_without_a_shuffle_and_are_released(spark, rows):
    left = BucketedTable(rows, "encounter_id", 4)
    right = BucketedTable(rows.select("encounter_id", F.lit(1).alias("one")), "encounter_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.read().join(right.read(), "encounter_id")
        assert joined.count() == rows.count()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, left.read().collect())) == sorted(map(repr, rows.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left.release()
    right.release()
    assert not spark.catalog.tableExists(left.table)
    path = spark._jvm.org.apache.hadoop.fs.Path(left.path)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
