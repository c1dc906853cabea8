"""Shared helpers: tables, word splitting, seeded order and learning samples."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, as UTF-8; null has none.

    ``bytes`` methods know ASCII only: ``lower`` changes A-Z, ``split`` cuts at
    0x20 and 0x09-0x0D.
    """
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def content(docs: DataFrame) -> Column:
    """What tells texts apart where ids are null or repeated."""
    return F.xxhash64(docs["text"])


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that a task holds few texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    # The worker stays for later tasks; what this one held of Arrow's pool goes back.
    pa.default_memory_pool().release_unused()


def limit_batches(spark: SparkSession, rows: int = 512) -> None:
    """From now on rows go to Python in batches of at most ``rows``; 10,000 texts a batch, the usual number, fill
    buffers that the executor and its workers keep for later tasks."""
    before = int(spark.conf.get(BATCH_ROWS))
    if not 0 < before <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """``limit_batches`` for what is written inside the block."""
    before = spark.conf.get(BATCH_ROWS)
    limit_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def bounded_sample(df: DataFrame, key: Column, rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows at most, chosen by a seeded hash of ``key``: the same rows at every run.

    The hash makes a cut near ``rows`` before the exact ``limit``, so that
    the top-k holds little more than it returns.
    """
    share = min(1.0, 1.2 * rows / max(1, df.count()))
    order = F.xxhash64(key, F.lit(seed))
    near = df.withColumn("_order", order).where(
        F.pmod("_order", F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1)
    )
    return near.orderBy("_order").limit(rows).drop("_order")
