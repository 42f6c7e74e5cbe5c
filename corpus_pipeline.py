"""The corpus pipeline: toxicity, near duplicates, source mix, token ids. Each stage is written and reread as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import chosenpath, mixing, pieces, toxicity
from plumbline.llm.common import stored

#: Bytes of a batch of rows that goes to Python, and characters that are encoded at once. An executor runs all stages, so what it has
#: kept of one counts in the next; the batches stand whole, in several copies, in its JVM and in its Python workers.
BATCH_BYTES, ENCODED_CHARS = 4 << 20, 500_000


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's batches for Python end at BATCH_BYTES and not at Spark's 64 MB. It stays so, as stages run when written."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class models do not call toxic."""
    bounded_batches(spark)
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group that near-duplicate links connect."""
    bounded_batches(spark)
    return chosenpath.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    bounded_batches(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids under seeded merge-dropout, with whether they decode to the text."""
    bounded_batches(spark)
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"), chars=ENCODED_CHARS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("token_ids", encode),
]
#: The stages fit models, compare sets and segment text, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES in turn over documents; rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
