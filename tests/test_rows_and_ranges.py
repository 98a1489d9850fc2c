"""No row is lost or misplaced: NULL keys, odd labels, infinite scores, bad CSV fields; caches and folders."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curata.operators import cleaning as cl
from curata.operators import evaluation as ev
from curata.operators import profiling as pf
from curata.operators.curve import curve_rows
from curata.operators.sampling import nested_sample, split_by_key, tag_split
from curata.plans.artifacts import Artifacts, artifacts
from curata.session import checkpoint_dir
from curata.sources import partition_count, read_csv, try_cast_columns
from curata.sources.encounters import encounters
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame([(None,), (1,), (2,), (None,), (3,)], "row_key bigint")


def test_null_keys_are_in_one_part(keyed):
    train, test = split_by_key(keyed)
    assert train.count() + test.count() == 5
    tagged = {r["split"]: r["count"] for r in tag_split(keyed).groupBy("split").count().collect()}
    assert tagged.get("train", 0) == train.count() and tagged.get("test", 0) == test.count()
    assert nested_sample(keyed, 0.9999999).count() == nested_sample(keyed, 1.0).count() == 5
    rows = {r.fraction: (r.n_rows, r.n_train) for r in curve_rows(keyed).collect()}
    assert rows[1.0] == (5, train.count())


def test_group_key_keeps_a_group_together(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("patient"), "id")
    sides = tag_split(df, "patient").groupBy("patient").agg(F.countDistinct("split").alias("n"))
    assert sides.agg(F.max("n")).first()[0] == 1


def test_labels_outside_zero_and_one_count(spark):
    df = spark.createDataFrame([(0, 0.0), (2, 2.0), (2, 1.0), (None, 1.0), (1, None), (1, float("nan"))], "label int, prediction double")
    m = ev.classification_metrics(df).first()
    assert (m.n_rows, m.n_unclassified) == (3, 3)
    assert m.accuracy == pytest.approx(2 / 3)
    c = ev.confusion_counts(df).first()
    assert c.tn + c.fp + c.fn + c.tp + c.n_other == 6 and c.n_other == 5


def test_unscored_and_infinite_scores(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, inf), (0, -inf), (1, 0.5), (0, 0.5), (1, None), (0, float("nan")), (None, 0.1)], "label int, score double")
    r = ev.auc_roc(df, blocks=3).first()
    assert (r.n_pos, r.n_neg, r.n_unscored) == (2, 2, 3)
    assert r.auc_roc == pytest.approx(3.5 / 4)
    empty = ev.auc_roc(df.limit(0)).first()
    assert empty.auc_roc is None and empty.n_pos == 0
    assert cl.exact_quantile(spark.createDataFrame([(inf,), (1.0,), (-inf,), (2.0,)], "v double"), "v", 0.5) == 1.0


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(3)
    columns = {f"a{n}": np.arange(n + 1, dtype=float) for n in (1, 7, 29, 30, 31, 59, 113, 300)}
    columns |= {f"d{k}": np.arange(0, 2 + k / 10, 0.1) for k in range(8)}
    columns |= {f"r{k}": rng.normal(size=200) * 10.0 ** (k - 3) for k in (0, 3, 8)}
    longest = max(map(len, columns.values()))
    rows = [tuple(float(v[i]) if i < len(v) else None for v in columns.values()) for i in range(longest)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    got = {}
    for r in pf.histogram(df, list(columns), 30).collect():
        got.setdefault(r.column_name, {})[r.bin] = (r.n, r.bin_lo, r.bin_hi)
    for c, v in columns.items():
        n, edges = np.histogram(v, 30)
        assert {b: x[0] for b, x in got[c].items()} == {i: k for i, k in enumerate(n) if k}
        assert all(math.isclose(x[1], edges[b], abs_tol=1e-12, rel_tol=1e-12) for b, x in got[c].items())


def test_histogram_counts_what_is_not_finite(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    got = {r.bin: r.n for r in pf.histogram(df, ["v"], 4).collect()}
    assert got == {0: 1, 2: 1, 3: 1, -1: 2}


def test_correlations_without_columns_and_with_odd_names(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0)], "`a'b` double, `c d` double")
    assert pf.correlations(df, ["missing"]).count() == 0
    got = {(r.col_a, r.col_b): r.corr for r in pf.correlations(df, ["a'b", "c d"]).collect()}
    assert got[("a'b", "c d")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])


def test_bad_csv_fields_are_seen(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id,value\n1,5\n2,?\n3,x\n")
    typed = read_csv(spark, str(path), "id int, value int")
    assert {r.id: (r.value, r.bad_record) for r in typed.collect()} == {1: (5, None), 2: (None, "2,?"), 3: (None, "3,x")}
    text = read_csv(spark, str(path), "id int, value string")
    cast = try_cast_columns(cl.sentinels_to_null(text, ("?",)), {"value": "int"})
    assert [r.value for r in cast.orderBy("id").collect()] == [5, None, None]
    inferred = read_csv(spark, str(path))
    assert dict(inferred.dtypes)["id"] == "int"
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(path), "id int, value int", mode="FAILFAST").collect()


def test_partition_count_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("partition-count", "")
    assert partition_count(encounters(spark, SF_SMALL)) >= 3
    assert not tracker.getJobIdsForGroup("partition-count")
    spark.sparkContext.setJobGroup("tests", "")


def test_checkpoint_folder_of_the_caller_stays(spark, tmp_path):
    before = checkpoint_dir(spark)
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert str(tmp_path) in checkpoint_dir(spark)
    spark.sparkContext.setCheckpointDir(before)


def test_release_leaves_no_cached_table(spark):
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    artifacts(spark, SF_SMALL).release()
    before = cached()
    run = Artifacts(spark, SF_SMALL)
    run.predictions("Decision Tree").count()
    assert cached() > before
    run.release()
    assert cached() == before


def test_clean_reads_its_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(rows):
        for r in rows:
            reads.add(r.num_rows)
            yield r

    source = encounters(spark, SF_SMALL)
    counted = source.mapInArrow(seen, source.schema)
    held = []
    cl.clean(counted, held=held).count()
    assert reads.value == source.count()
    cl.cleaning_audit(counted)
    assert reads.value == 2 * source.count()
    for df in held:
        df.unpersist()


def test_imputed_medians_are_within_the_stated_rank(spark):
    from curata.operators.preprocess import MEDIAN_RANK_ERROR, imputer

    df = spark.range(10_001).select((F.col("id") * 7919 % 10_007).cast("double").alias("v"), F.when(F.col("id") % 3 == 0, (F.col("id") % 11).cast("double")).alias("w"))
    found = imputer(["v", "w"]).fit(df).surrogateDF.first()
    for c in ("v", "w"):
        known = [r[0] for r in df.where(F.col(c).isNotNull()).select(c).collect()]
        low, high = sum(x < found[c] for x in known) / len(known), sum(x <= found[c] for x in known) / len(known)
        assert low - MEDIAN_RANK_ERROR <= 0.5 <= high + MEDIAN_RANK_ERROR
