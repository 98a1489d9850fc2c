"""Types inferred past sentinels, typed columns and the fields that do not fit."""

import datetime

from curata.sources.inference import apply_types, bad_fields, infer_types, type_table

ROWS = [("1", "1.5", "2024-01-31", "2024-01-31 10:00:00", "true", "x", None, "1", "7"),
        ("?", "2", "?", "2024-02-01", "FALSE", "1", "?", "two", "-8"),
        ("-30", "", "2023-02-28", "?", "?", "?", "", "3", "?"),
        (None, ".5e3", None, None, None, None, None, "4", "123456789012345678")]
COLUMNS = ["whole", "real", "day", "moment", "flag", "text", "nothing", "mostly", "odd `name`"]


def table(spark):
    return spark.createDataFrame(ROWS, ", ".join(f"`{c.replace('`', '``')}` string" for c in COLUMNS))


def test_types_past_sentinels(spark):
    df = table(spark)
    assert infer_types(df) == {"whole": "bigint", "real": "double", "day": "date", "moment": "timestamp", "flag": "boolean", "text": "string",
                               "nothing": "string", "mostly": "string", "odd `name`": "bigint"}
    assert infer_types(df, sentinels=())["whole"] == "string"
    assert infer_types(df, ["mostly"], max_bad_share=0.25) == {"mostly": "bigint"}
    counts = {r.column_name: r for r in type_table(df).collect()}
    assert (counts["whole"].n_values, counts["whole"].n_missing, counts["whole"].n_bigint, counts["whole"].n_double) == (2, 2, 2, 2)
    assert (counts["nothing"].n_values, counts["nothing"].n_missing, counts["nothing"].n_bad) == (0, 4, 0)


def test_impossible_dates_and_long_numbers_are_text(spark):
    df = spark.createDataFrame([("2023-02-30", "1" * 19, "1e5"), ("2023-02-01", "2", "2")], "d string, n string, e string")
    assert infer_types(df) == {"d": "string", "n": "double", "e": "double"}


def test_apply_types(spark):
    df = table(spark)
    typed = apply_types(df, infer_types(df))
    assert dict(typed.dtypes)["whole"] == "bigint" and typed.columns == COLUMNS
    rows = typed.collect()
    assert [r.whole for r in rows] == [1, None, -30, None]
    assert [r.real for r in rows] == [1.5, 2.0, None, 500.0]
    assert rows[0].day == datetime.date(2024, 1, 31) and rows[1].flag is False and rows[2].text is None


def test_bad_fields(spark):
    df = table(spark).union(table(spark))
    types = infer_types(df, max_bad_share=0.25)
    assert types["mostly"] == "bigint"
    assert [tuple(r) for r in bad_fields(df, types).collect()] == [("mostly", "two", 2)]
    assert [r.mostly for r in apply_types(df, types).collect()] == [1, None, 3, 4] * 2
    assert bad_fields(df, {}).count() == 0


def test_tables_without_rows_or_columns(spark):
    df = table(spark)
    empty = type_table(df.limit(0))
    assert {r.type for r in empty.collect()} == {"string"} and empty.count() == len(COLUMNS)
    assert type_table(df, []).count() == 0
