"""Partitions of the encounters' aggregates and joins."""

from __future__ import annotations

import importlib

import pytest

from curata.sources.tables import SCHEMAS

en = importlib.import_module("curata.sources.encounters")


def _write(spark, path, lines, orders, customers):
    for name, rows in (("lineitem", lines), ("orders", orders), ("customer", customers)):
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(f"{path}/{name}.parquet")


def _line(order, supplier, quantity, flag="R", status="O", discount=0.1):
    return (order, 1, supplier, 1, quantity, 1.0, discount, 0.0, flag, status, None)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A hot order, lines without order or supplier, repeated orders and customers, orders without lines or customer."""
    path = str(tmp_path_factory.mktemp("encounter-parts"))
    lines = [_line(1, i % 7, 2.0) for i in range(300)] + [_line(o, s, 3.0, None, "F", None) for o in range(2, 40) for s in (1, 1, None)]
    lines += [_line(None, 5, 1.0), _line(None, None, None), _line(50, None, None)]
    orders = [(o, o % 9 if o % 11 else None, "O", 1.0, None, "2-HIGH") for o in [*range(60), 3, 3, 1]] + [(None, 4, "F", 1.0, None, None), (70, 999, "F", 1.0, None, None)]
    customers = [(c, "n", c % 5, 1.0, "BUILDING") for c in [*range(9), 2]] + [(None, "n", 1, 1.0, "AUTO")]
    _write(spark, path, lines, orders, customers)
    return path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rows_do_not_depend_on_the_partitions(spark, folder, monkeypatch):
    whole = _rows(en.encounters(spark, folder))
    monkeypatch.setattr(en, "ROWS_PER_PART", 20)
    assert _rows(en.encounters(spark, folder)) == whole
    assert len(whole) == sum(2 if r == 2 else 1 for r in (o % 9 for o in [*range(60), 3, 3, 1] if o % 11)) + 1
    hot = next(r for r in whole if r[0] == 1)
    assert (hot[7], hot[8], hot[9], hot[10], hot[11], hot[12]) == (600, 300, 300, 300, 300, 7)
    assert next(r for r in whole if r[0] == 50)[7:13] == (None, 1, 1, 1, 1, 0)


def test_a_task_has_a_bounded_number_of_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(en, "ROWS_PER_PART", 20)
    parts = en.parts_needed(spark.read.parquet(f"{folder}/lineitem.parquet"))
    assert parts >= 417 / 20
    held = en.encounters(spark, folder)
    assert held.count() > 0 and held.rdd.getNumPartitions() == parts
    assert en.lines_per_order(spark.read.parquet(f"{folder}/lineitem.parquet"), parts).rdd.getNumPartitions() == parts


def test_orders_that_outnumber_lines(spark, folder, monkeypatch):
    lines, orders = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("lineitem", "orders"))
    monkeypatch.setattr(en, "ROWS_PER_PART", 1)
    assert en.parts_needed(lines.limit(0), orders) >= 65 and en.parts_needed(lines.limit(0)) == 1
