"""Session helpers for tests and the bench; on a cluster the session comes from the submitter."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether the shuffle files of a query go when it ends, or when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "plumbline") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the JVM leaves methods above 8000 bytes of code uncompiled; Spark then splits them instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. A local session, which is one machine, gets a folder of its own where none is
    set; a cluster has to name one."""
    sc = spark.sparkContext
    target = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not target:
        if not (sc.master or "").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        target = tempfile.mkdtemp(prefix="plumbline-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(target)
    return target


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to a new folder below the shared checkpoint folder and read back, which cuts its lineage. What the write
    shuffled leaves the disk with it."""
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The written table and its folder, for a caller that deletes it when nothing reads it any more."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/plumbline-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path
