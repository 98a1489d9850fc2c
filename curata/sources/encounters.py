"""The ``encounters`` table: one row per order, shaped like a clinical
encounter record (ids, demographics, counts, lab results, target).

The DataFrame plan below and ``ENCOUNTERS_CTES`` (the same definition as SQL
text for the DuckDB oracles) must stay in step.

Plan: lineitem is aggregated per order and supplier first and then per order,
so a hot order key never reaches one task as raw rows.  Orders are joined with
customers while they are narrow, then with the line aggregate.  Partitions of
files and AQE's follow from compressed bytes and cores, and such rows are many
times larger in a task's memory; so from ``ROWS_PER_PART`` lines on, lines and
orders are dealt out by key into partitions of that many rows at most, on
average, and a task's memory does not grow with the input.  The join with
customers is left to Catalyst/AQE: a broadcast only when the runtime size of a
side is under the broadcast threshold, a sort-merge join (with AQE skew
splitting of a hot customer key) otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.sources.files import row_count
from curata.sources.tables import load_table

#: Lines or orders of a partition; in the aggregates and the join a line takes about 0.3 KB of a task's memory.
ROWS_PER_PART = 1_000_000


def parts_needed(*tables: DataFrame) -> int:
    """Partitions for the largest of the tables: 1 if it fits one, else no fewer than there are cores."""
    needed = max(math.ceil(row_count(t) / ROWS_PER_PART) for t in tables)
    return max(needed, tables[0].sparkSession.sparkContext.defaultParallelism) if needed > 1 else 1


def dealt_out(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` in ``parts`` partitions by the keys; for one partition it is left to what follows."""
    return df.repartition(parts, *keys) if parts > 1 else df


def lines_per_order(lineitem: DataFrame, parts: int = 1) -> DataFrame:
    lines = lineitem.selectExpr(
        "l_orderkey", "l_suppkey", "l_quantity",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_ret",
        "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_open",
        "CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS is_disc",
    )
    by_supplier = dealt_out(lines, parts, "l_orderkey", "l_suppkey").groupBy("l_orderkey", "l_suppkey").agg(
        F.expr("COUNT(*) AS n_lines"),
        F.expr("SUM(l_quantity) AS qty"),
        *[F.expr(f"SUM(is_{c}) AS n_{c}") for c in ("ret", "open", "disc")],
    )
    return dealt_out(by_supplier, parts, "l_orderkey").groupBy("l_orderkey").agg(
        F.expr("CAST(SUM(n_lines) AS INT) AS n_lines"),
        F.expr("CAST(COUNT(l_suppkey) AS INT) AS n_supp"),
        *[F.expr(f"CAST(SUM({c}) AS INT) AS {c}") for c in ("qty", "n_ret", "n_open", "n_disc")],
    )


# Column definitions of the encounter record over orders, customer and the
# per-order line aggregate (SQL expressions: one parse each on the JVM).
ENCOUNTER_COLUMNS = (
    "o_orderkey AS encounter_id",
    "o_custkey AS patient_nbr",
    "CASE WHEN o_orderkey % 45 = 0 THEN '?' ELSE c_mktsegment END AS race",
    "CASE WHEN o_orderkey % 499 = 0 THEN 'Unknown/Invalid' WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender",
    "concat('[', CAST(10 * (o_custkey % 10) AS STRING), '-', CAST(10 * (o_custkey % 10) + 10 AS STRING), ')') AS age",
    "CASE WHEN o_orderkey % 100 < 97 THEN '?' ELSE '[75-100)' END AS weight",
    "CAST(1 + o_orderkey % 14 AS INT) AS time_in_hospital",
    "qty AS num_lab_procedures",
    "n_disc AS num_procedures",
    "n_lines AS num_medications",
    "n_ret AS number_outpatient",
    "n_open AS number_emergency",
    "n_supp AS number_inpatient",
    "CAST(1 + o_custkey % 9 AS INT) AS number_diagnoses",
    "CASE o_orderpriority WHEN '1-URGENT' THEN '>300' WHEN '2-HIGH' THEN '>200' WHEN '3-MEDIUM' THEN 'Norm' "
    "ELSE 'None' END AS max_glu_serum",
    "CASE WHEN o_orderkey % 6 = 0 THEN '>8' WHEN o_orderkey % 6 = 1 THEN 'Norm' ELSE 'None' END AS A1Cresult",
    "CASE WHEN o_orderkey % 5 < 2 THEN 'Ch' ELSE 'No' END AS change",
    "CASE WHEN o_custkey % 4 = 0 THEN 'No' ELSE 'Yes' END AS diabetesMed",
    "CASE WHEN (n_ret >= 3 AND o_orderkey % 7 <> 0) OR o_orderkey % 50 = 0 THEN '<30' "
    "WHEN o_orderstatus = 'O' THEN '>30' ELSE 'NO' END AS readmitted",
)


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    lineitem = load_table(spark, sf_dir, "lineitem")
    parts = parts_needed(lineitem, orders)
    of_customers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
    joined = dealt_out(of_customers, parts, "o_orderkey").join(lines_per_order(lineitem, parts), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.selectExpr(*ENCOUNTER_COLUMNS)


# The same table as SQL common table expressions (DuckDB oracles).
ENCOUNTERS_CTES = """
li AS (
  SELECT l_orderkey,
         CAST(COUNT(*) AS INT) AS n_lines,
         CAST(COUNT(DISTINCT l_suppkey) AS INT) AS n_supp,
         CAST(SUM(l_quantity) AS INT) AS qty,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS n_ret,
         CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS INT) AS n_open,
         CAST(SUM(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS INT) AS n_disc
  FROM lineitem GROUP BY l_orderkey),
encounters AS (
SELECT o_orderkey AS encounter_id,
       o_custkey  AS patient_nbr,
       CASE WHEN o_orderkey % 45 = 0 THEN '?' ELSE c_mktsegment END AS race,
       CASE WHEN o_orderkey % 499 = 0 THEN 'Unknown/Invalid'
            WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       CONCAT('[', CAST(10 * (o_custkey % 10) AS STRING), '-', CAST(10 * (o_custkey % 10) + 10 AS STRING), ')') AS age,
       CASE WHEN o_orderkey % 100 < 97 THEN '?' ELSE '[75-100)' END AS weight,
       CAST(1 + o_orderkey % 14 AS INT) AS time_in_hospital,
       qty     AS num_lab_procedures,
       n_disc  AS num_procedures,
       n_lines AS num_medications,
       n_ret   AS number_outpatient,
       n_open  AS number_emergency,
       n_supp  AS number_inpatient,
       CAST(1 + o_custkey % 9 AS INT) AS number_diagnoses,
       CASE o_orderpriority WHEN '1-URGENT' THEN '>300' WHEN '2-HIGH' THEN '>200' WHEN '3-MEDIUM' THEN 'Norm' ELSE 'None' END AS max_glu_serum,
       CASE WHEN o_orderkey % 6 = 0 THEN '>8' WHEN o_orderkey % 6 = 1 THEN 'Norm' ELSE 'None' END AS A1Cresult,
       CASE WHEN o_orderkey % 5 < 2 THEN 'Ch' ELSE 'No' END AS change,
       CASE WHEN o_custkey % 4 = 0 THEN 'No' ELSE 'Yes' END AS diabetesMed,
       CASE WHEN (n_ret >= 3 AND o_orderkey % 7 <> 0) OR o_orderkey % 50 = 0 THEN '<30'
            WHEN o_orderstatus = 'O' THEN '>30' ELSE 'NO' END AS readmitted
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN li ON l_orderkey = o_orderkey)
"""


def with_encounters(*ctes: str) -> str:
    """``WITH li AS (...), encounters AS (...)[, more]`` prefix for an oracle."""
    parts = [ENCOUNTERS_CTES.strip()] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n"
