"""CSV scan (S1) and source profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = True,
    null_value: str | None = None,
    mode: str = "PERMISSIVE",
    bad_record: str | None = "bad_record",
) -> DataFrame:
    """CSV with header.

    Without a schema the types are inferred, which reads the files once more,
    and one ``?`` in a numeric column makes the whole column text.  With a
    schema, a field that does not fit becomes NULL and the raw line is kept in
    the column ``bad_record`` (NULL for a good line), so no value is lost
    unseen; ``mode`` FAILFAST raises instead and DROPMALFORMED drops the line.
    """
    reader = spark.read.option("header", header).option("mode", mode)
    if schema is not None:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if bad_record and mode.upper() == "PERMISSIVE":
            fields = T.StructType([*fields.fields, T.StructField(bad_record, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", bad_record)
        reader = reader.schema(fields)
    else:
        reader = reader.option("inferSchema", infer_schema)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def try_cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns after their sentinels are NULL; what does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def source_profile(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row table (one aggregate job)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("int"))


def partition_count(df: DataFrame) -> int:
    """Number of partitions in which the plan's sources are read; no job is run."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    return sum(leaves.apply(i).execute().getNumPartitions() for i in range(leaves.size()))


#: Up to so many files are counted by their footers.
FOOTERS = 200


def row_count(df: DataFrame) -> int:
    """Number of rows.  A plain scan of a few Parquet files is counted by their footers on the driver, without a job."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    files = df.inputFiles() if plan.nodeName() == "LogicalRelation" else []
    if not files or len(files) > FOOTERS or not all(f.endswith(".parquet") for f in files):
        return df.count()
    jvm, rows = df.sparkSession._jvm, 0
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(f))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            rows += reader.getRecordCount()
        finally:
            reader.close()
    return rows
