"""Contracts checked while a table is written: the write that publishes counts what breaks a rule, and only then is the table moved to its place.

The source plan runs once. Rule counts are metrics observed on the rows as they pass to the writer; the key is counted on the key columns of
the files just written. Readers of the target see the old table, no table or the whole new one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.validate import Contract, duplicate_keys, schema_faults
from plumbline.session import ensure_checkpoint_dir
from plumbline.sources import paths


@dataclass(frozen=True)
class Verdict:
    """What a write told about a table. refused names what no row can mend; broken counts the rows that break each rule."""

    refused: tuple[str, ...]
    rows: int = 0
    sound: int = 0
    broken: tuple[tuple[str, str, int], ...] = ()
    repeated_keys: int = 0

    @property
    def kept(self) -> bool:
        return not self.refused and not self.repeated_keys and self.sound == self.rows

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """(column, rule, n_bad) of every rule, with the key and the schema as rows of their own."""
        rows = [*self.broken, ("*", "key", self.repeated_keys), *[("*", f, 1) for f in self.refused]]
        return spark.createDataFrame(rows, "column string, rule string, n_bad long")


class ContractBroken(ValueError):
    def __init__(self, verdict: Verdict):
        told = [*verdict.refused, *[f"{c}:{r} {n} rows" for c, r, n in verdict.broken if n]]
        if verdict.repeated_keys:
            told.append(f"{verdict.repeated_keys} keys repeat")
        super().__init__("contract broken: " + "; ".join(told))
        self.verdict = verdict


def publish(df: DataFrame, contract: Contract, path: str, quarantine: str | None = None, overwrite: bool = False, partition: str | None = None) -> Verdict:
    """Writes the table to path if it keeps its contract, else raises ContractBroken and leaves path as it was.

    With a quarantine folder, rows that break a rule go there with the list of rules (broken_rules) and the others are published; columns,
    types and a repeated key still refuse the whole table. An existing target is refused before any work unless overwrite is set. An empty
    table keeps every rule. Files staged by a writer that died stay beside the target under a name of their own and are never read.
    """
    spark = df.sparkSession
    refused = tuple(schema_faults(df, contract))
    if refused:
        raise ContractBroken(Verdict(refused))
    if not overwrite and any(paths.exists(spark, p) for p in (path, quarantine) if p):
        raise FileExistsError(path)
    bad = contract.bad_conditions()
    mark = "broken_rules"
    if mark in df.columns:
        raise ValueError(f"a column is called {mark}")
    marked = df.withColumn(mark, F.array_compact(F.array(*[F.when(cond, F.lit(f"{c}:{r}")) for (c, r), cond in bad.items()]).cast("array<string>")))
    seen = Observation(f"contract-{uuid.uuid4().hex}")
    ok = F.size(mark) == 0
    watched = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("sound"), *[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(bad.values())])
    stage = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        if quarantine:
            # one write, two folders; the rows of each become a table by a rename
            parts = ["sound_rows", *([partition] if partition else [])]
            watched.withColumn("sound_rows", ok).write.partitionBy(*parts).parquet(stage)
        else:
            writer = watched.drop(mark).write
            (writer.partitionBy(partition) if partition else writer).parquet(stage)
        told = seen.get
        rows, sound = told.get("rows") or 0, told.get("sound") or 0
        good = f"{stage}/sound_rows=true" if quarantine else stage
        here = paths.exists(spark, good)
        repeated = duplicate_keys(spark.read.schema(df.schema).parquet(good), contract.key).count() if contract.key and here and rows else 0
        verdict = Verdict((), rows, sound, tuple((c, r, told.get(f"c{i}") or 0) for i, (c, r) in enumerate(bad)), repeated)
        if repeated or sound < rows and not quarantine:
            raise ContractBroken(verdict)
        if not here:
            df.limit(0).write.parquet(good)
        _replaced(spark, good, path)
        if quarantine:
            bad_rows = f"{stage}/sound_rows=false"
            if paths.exists(spark, bad_rows):
                _replaced(spark, bad_rows, quarantine)
            else:
                paths.delete(spark, quarantine)
        return verdict
    finally:
        paths.delete(spark, stage)


def quarantined(spark: SparkSession, like: DataFrame, path: str) -> DataFrame:
    """The rows set aside, with the rules they broke; none where no row was."""
    schema = like.withColumn("broken_rules", F.lit(None).cast("array<string>")).schema
    return spark.read.schema(schema).parquet(path) if paths.exists(spark, path) else spark.createDataFrame([], schema)


def _replaced(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in the place of another one; the old one goes after the new one stands."""
    old = f"{target.rstrip('/')}.old-{uuid.uuid4().hex}"
    before = paths.exists(spark, target)
    if before:
        paths.move(spark, target, old)
    paths.move(spark, source, target)
    if before:
        paths.delete(spark, old)


def checked(df: DataFrame, contract: Contract, name: str = "checked") -> DataFrame:
    """The rows of a table that keeps its contract, read back from the shared folder where the check wrote them. A broken contract raises."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/plumbline-{name}-{uuid.uuid4().hex}"
    publish(df, contract, path)
    return spark.read.schema(df.schema).parquet(path)
