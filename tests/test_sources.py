"""CSV scan, profile and sinks."""

import os

from curata.sources import checkpoint_table, partition_count, read_csv, source_profile, write_table
from curata.sources.encounters import encounters
from tests.conftest import SF_SMALL


def test_csv_sentinels_nulls_and_inference(spark, tmp_path):
    path = tmp_path / "enc.csv"
    path.write_text('id,race,count,note\n1,"A, quoted",3,None\n2,?,?,\n3,B,5,x\n')
    inferred = read_csv(spark, str(path))
    types = dict(inferred.dtypes)
    assert types["id"] == "int" and types["count"] == "string"   # one '?' makes the column text
    rows = inferred.orderBy("id").collect()
    assert rows[0].race == "A, quoted" and rows[0].note == "None" and rows[1].note is None
    typed = read_csv(spark, str(path), schema="id int, race string, count int, note string")
    assert [(r["count"], r.bad_record) for r in typed.orderBy("id").collect()] == [(3, None), (None, "2,?,?,"), (5, None)]


def test_profile_write_and_checkpoint(spark, tmp_path):
    enc = encounters(spark, SF_SMALL)
    prof = source_profile(enc).first()
    assert (prof.n_rows, prof.n_cols) == (1500, 19)
    assert partition_count(enc) >= 1
    out = os.path.join(str(tmp_path), "enc")
    write_table(enc, out)
    assert spark.read.parquet(out).count() == 1500
    assert checkpoint_table(enc.limit(10)).count() == 10
