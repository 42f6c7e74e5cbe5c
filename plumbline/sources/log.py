"""The prediction log: append-only rows of (scored_at, payload), the payload being strict JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "scored_at timestamp, payload string"


def _strict(name: str, kind: T.DataType) -> Column:
    """JSON has no NaN or infinity, so both become NULL."""
    c = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c).alias(name)
    return c.alias(name)


def to_log(df: DataFrame, at: Column | None = None) -> DataFrame:
    """(scored_at, payload). NULL fields are written, so every record names every column."""
    fields = F.struct(*[_strict(f.name, f.dataType) for f in df.schema])
    stamp = F.current_timestamp() if at is None else at.cast("timestamp")
    return df.select(stamp.alias("scored_at"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("payload"))


def append_log(df: DataFrame, path: str, at: Column | None = None) -> None:
    to_log(df, at).write.mode("append").parquet(path)


def expand_log(log: DataFrame, schema: T.StructType | str) -> DataFrame:
    """scored_at and the payload's columns. The explicit schema keeps the type of a column that is all NULL."""
    parsed = log.select("scored_at", F.from_json("payload", schema).alias("p"))
    return parsed.select("scored_at", "p.*")


def read_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The expanded log in order of scored_at; a log nobody wrote to yet is an empty table with its columns."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        raw = spark.read.schema(LOG_SCHEMA).parquet(path)
    else:
        raw = spark.createDataFrame([], LOG_SCHEMA)
    return expand_log(raw, schema).orderBy("scored_at")
