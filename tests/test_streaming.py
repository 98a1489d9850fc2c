"""Row-local operators give the same rows on a stream as in batch."""

import os

from curata.operators import cleaning as cl
from curata.operators.faults import inject_faults
from curata.operators.features import engineer_features
from curata.sources.encounters import encounters
from curata.streaming import clean_stream
from tests.conftest import SF_SMALL


def test_clean_stream_matches_batch(spark, tmp_path):
    src = os.path.join(str(tmp_path), "in")
    enc = inject_faults(encounters(spark, SF_SMALL))
    enc.repartition(3).write.parquet(src)
    batch = spark.read.parquet(src)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = clean_stream(stream, drop_columns=["weight"])
    q = (out.writeStream.format("memory").queryName("clean_stream_test").outputMode("append")
         .option("checkpointLocation", os.path.join(str(tmp_path), "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("clean_stream_test")
    b = cl.sentinels_to_null(batch).drop("weight")
    b = cl.drop_identifiers(b, key="encounter_id")
    b = cl.drop_invalid_category(cl.drop_null_critical(b))
    expected = engineer_features(cl.encode_target(b))
    assert sorted(got.columns) == sorted(expected.columns)
    assert got.count() == expected.count()
    assert got.exceptAll(expected.select(*got.columns)).count() == 0


def test_score_stream_matches_batch(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from curata.operators import classifiers as clf
    from curata.plans.artifacts import artifacts
    from curata.streaming import score_stream

    run = artifacts(spark, SF_SMALL)
    model = PipelineModel([*run.prep_model.stages, run.model("Decision Tree")])
    src = os.path.join(str(tmp_path), "rows")
    run.prepared.write.parquet(src)
    batch = spark.read.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    q = (score_stream(stream, model).writeStream.format("memory").queryName("score_stream_test").outputMode("append")
         .option("checkpointLocation", os.path.join(str(tmp_path), "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("score_stream_test")
    expected = clf.score(model, batch)
    assert got.columns == expected.columns and got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0
