"""Properties of the keyed draws, splits, samples, imputation and metrics."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from curata.operators import evaluation as ev
from curata.operators import faults as fx
from curata.operators.curve import curve_rows
from curata.operators.sampling import nested_sample, tag_split
from curata.plans.artifacts import artifacts, prepared_table
from curata.plans.registry import scored_fixture
from curata.sources.encounters import encounters
from tests.conftest import SF_MID, SF_SMALL


def _key_set(df, cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_faults_do_not_depend_on_partitioning(spark):
    enc = encounters(spark, SF_SMALL)
    cols = ["encounter_id", "age", "race", "readmitted", "time_in_hospital"]
    base = _key_set(fx.inject_faults(enc), cols)
    for n in (1, 7):
        assert _key_set(fx.inject_faults(enc.repartition(n)), cols) == base


def test_faults_touch_only_their_column(spark):
    enc = encounters(spark, SF_SMALL)
    other = [c for c in enc.columns if c not in ("age", "race", "readmitted", "time_in_hospital")]
    assert _key_set(fx.inject_faults(enc), other) == _key_set(enc, other)


def test_audit_counts_are_exact(spark):
    enc = encounters(spark, SF_SMALL)
    audit = {r.fault: r for r in fx.noise_audit(enc).collect()}
    before = enc.select("encounter_id", "age").withColumnRenamed("age", "a0")
    after = fx.inject_faults(enc).select("encounter_id", "age")
    changed = before.join(after, "encounter_id").where(~F.col("a0").eqNullSafe(F.col("age"))).count()
    assert audit["null_injection"].n_changed == changed
    assert audit["any_fault"].n_changed <= sum(audit[k].n_changed for k in audit if k != "any_fault")


def test_split_is_disjoint_complete_and_stable(spark):
    df = prepared_table(spark, SF_SMALL, faults=False)
    tagged = tag_split(df)
    again = tag_split(df.repartition(5))
    assert _key_set(tagged, ["row_key", "split"]) == _key_set(again, ["row_key", "split"])
    counts = {r.split: r["count"] for r in tagged.groupBy("split").count().collect()}
    assert sum(counts.values()) == df.count()
    assert 0.7 < counts["train"] / df.count() < 0.9


def test_nested_samples(spark):
    df = prepared_table(spark, SF_SMALL, faults=False)
    small = _key_set(nested_sample(df, 0.25), ["row_key"])
    big = _key_set(nested_sample(df, 0.5), ["row_key"])
    assert small <= big
    rows = curve_rows(df).orderBy("fraction").collect()
    assert [r.n_rows for r in rows] == sorted(r.n_rows for r in rows)
    assert rows[-1].n_rows == df.count()


def test_fixture_totals_without_faults(spark):
    """FIXTURES.md section 2 checked totals at sf0.001."""
    df = prepared_table(spark, SF_SMALL, faults=False)
    assert df.count() == 1496
    assert df.where("label = 1").count() == 216
    assert tag_split(df).where("split = 'train'").count() == 1185


def test_imputed_columns_have_no_nulls(spark):
    a = artifacts(spark, SF_SMALL)
    imp = [c for c in a.transformed.columns if c.endswith("_imp")]
    assert len(imp) == 13
    nulls = a.transformed.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in imp]).first()
    assert all(v == 0 for v in nulls)


def test_evaluators_agree_with_mllib(spark):
    scored = scored_fixture(spark, SF_SMALL)
    ours = ev.evaluate(scored).first()
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(scored)
    assert ours.auc_roc == pytest.approx(auc, abs=1e-9)
    for metric, name in [("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")]:
        mllib = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert ours[metric] == pytest.approx(mllib.evaluate(scored.withColumn("label", F.col("label").cast("double"))),
                                             abs=1e-9)
    assert ours.weighted_recall == pytest.approx(ours.accuracy)
    cm = ev.confusion_counts(scored).first()
    assert cm.tn + cm.fp + cm.fn + cm.tp == scored.count()


def test_auc_blocks_do_not_change_the_result(spark):
    scored = scored_fixture(spark, SF_SMALL).withColumn("score", F.col("score") + F.col("encounter_id") / 1e7)
    values = {round(ev.auc_roc(scored, blocks=b).first().auc_roc, 12) for b in (1, 3, 16)}
    assert len(values) == 1


def test_classifiers_learn_the_fixture(spark):
    """Without faults the label follows number_outpatient >= 3: AUC > 0.9."""
    from curata.operators import classifiers as clf
    from curata.operators.preprocess import fit_preprocessing
    from curata.operators.sampling import add_class_weights, split_by_key

    df = prepared_table(spark, SF_MID, faults=False)
    train, test = split_by_key(df)
    train, _ = add_class_weights(train)
    prep = fit_preprocessing(train)
    tv, sv = prep.transform(train), prep.transform(test)
    for name, est in clf.classifiers().items():
        model, again = est.fit(tv), est.fit(tv)
        scored = clf.score(model, sv)
        assert ev.auc_roc(scored).first().auc_roc > 0.9, name
        row = scored.first()
        assert len(row.raw_prediction) == len(row.probability) == 2 and row.score == row.probability[1]
        if name == "Logistic Regression":
            assert clf.linear_terms(model) == clf.linear_terms(again)
        else:
            assert clf.importances(model) == clf.importances(again)
            assert sum(v for _, v in clf.importances(model)) == pytest.approx(1.0)
