"""Every query with an SQL oracle equals DuckDB on the same tables (sf0.001)."""

import math

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL, duck

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


def _norm_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_entry():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 45


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck(SF_SMALL).sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert _norm_rows(df.columns, rows) == _norm_rows(rel.columns, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_model_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["model", "auc_roc", "accuracy", "f1", "weighted_precision", "weighted_recall"]
    assert 0.5 < rows[0]["auc_roc"] <= 1.0
