"""Readers and sinks. Paths may be local or any Hadoop-readable URI; schemas are explicit, never inferred."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_URI = re.compile(r"^[a-z][a-z0-9+.-]*://[^/]+/.+$")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";") -> DataFrame:
    """Delimited text with a header; a leading byte-order mark is dropped, decimal commas stay text."""
    return (
        spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", "UTF-8")
        .option("enforceSchema", False).csv(path)
    )


def check_object_uri(uri: str) -> str:
    """scheme://bucket/object, anything else is refused before a job starts."""
    if not _URI.match(uri):
        raise ValueError(f"expected scheme://bucket/object, got {uri!r}")
    return uri


def read_csv_object(spark: SparkSession, uri: str, schema: T.StructType | str, sep: str = ";") -> DataFrame:
    return read_csv(spark, check_object_uri(uri), schema, sep)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


_SOURCES = {
    "csv": lambda s, c: read_csv(s, c["path"], c["schema"], c.get("sep", ";")),
    "object_csv": lambda s, c: read_csv_object(s, c["path"], c["schema"], c.get("sep", ";")),
    "parquet": lambda s, c: read_parquet(s, c["path"], c.get("columns")),
    "json": lambda s, c: read_json(s, c["path"], c["schema"]),
    "table": lambda s, c: read_table(s, c["name"]),
}


def read_source(spark: SparkSession, config: dict) -> DataFrame:
    """A source described by {'type': ..., ...}."""
    kind = config.get("type")
    if kind not in _SOURCES:
        raise ValueError(f"unknown source type {kind!r}; known: {', '.join(sorted(_SOURCES))}")
    return _SOURCES[kind](spark, config)


def write_features(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite") -> None:
    """The feature table, optionally partitioned by month so that time filters prune files."""
    writer = df.write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def export_split(df: DataFrame, path: str, split: str, label: str) -> DataFrame:
    """Writes the training file as CSV parts with a header and returns rows and event rate per split."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.groupBy(split).agg(F.count("*").alias("loans"), F.avg(F.col(label).cast("double")).alias("default_rate"))


def write_report(df: DataFrame, path: str) -> None:
    """A report table as JSON lines."""
    df.write.mode("overwrite").json(path)


SCORED_SCHEMA = "instance struct<{key}:string>, prediction struct<classes:array<string>, scores:array<double>>"


def read_scored_jsonl(spark: SparkSession, path: str | list[str], key: str, positive: str = "1") -> DataFrame:
    """(key, score): the score of the positive class whatever the order of the classes. Globs are accepted."""
    return positive_score(spark.read.schema(SCORED_SCHEMA.format(key=key)).json(path), key, positive)


def positive_score(df: DataFrame, key: str, positive: str = "1") -> DataFrame:
    at = F.array_position("prediction.classes", F.lit(positive))
    return df.select(F.col(f"instance.{key}").alias(key), F.get("prediction.scores", (at - 1).cast("int")).alias("score")).where(F.col(key).isNotNull())


def newest_directory(spark: SparkSession, pattern: str) -> str:
    """The newest directory that matches a glob, by modification time, through the Hadoop file system."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    dirs = [(s.getModificationTime(), s.getPath().toString()) for s in found if s.isDirectory()]
    if not dirs:
        raise FileNotFoundError(f"no directory matches {pattern}")
    return max(dirs)[1]
