"""Newly landed record files as a stream, with a dead-letter table.

Each micro-batch is looked at as a batch of files: those that break off, do not parse or have
an encoding that cannot be read go to the dead-letter table with a reason, and every other file is
normalized like in a batch run.  Both tables are written by batch number and replaced
when a batch is repeated, so a restart neither loses nor doubles a file.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowloom.config import PackageConfig
from rowloom.operators import validate
from rowloom.operators.cells import cells
from rowloom.operators.normalize import normalize
from rowloom.plans.scratch import materialize
from rowloom.sources import records, structure

BATCH = "batch_id"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
DEAD_LETTER = "app_name STRING, source_file STRING, file_size BIGINT, reason STRING"


def landed_chunks(
    spark: SparkSession, directory: str, end_tag: str = records.DEFAULT_END, files_per_batch: int | None = None,
) -> DataFrame:
    """Streaming chunks of the files that land in a directory or one level of ``name=value`` directories below it."""
    reader = spark.readStream.option("lineSep", end_tag)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(directory).select(
        records.local_path(F.col("_metadata.file_path")).alias("source_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value").alias("chunk"),
    )


def _readable(encodings: list[str]) -> list[str]:
    """Those of some encodings that records can be read in."""
    found = []
    for encoding in encodings:
        try:
            records.decoded(F.lit(""), encoding)
            found.append(encoding)
        except ValueError:
            pass
    return found


def sort_out(
    chunked: DataFrame, end_tag: str, config: PackageConfig
) -> tuple[DataFrame, DataFrame]:
    """Records of the sound files of a chunk table, and the others: ``source_file, file_size, reason``.

    A file is complete if its bytes, read chunk by chunk, end after a record, outside of comments and CDATA
    sections; with ``check_contents`` it must also be well-formed.
    """
    spark = chunked.sparkSession
    splits = materialize(structure.splits(chunked), "stream-splits")
    states = structure.inside_markup(splits, spark)
    sizes = splits.groupBy("source_file").agg(F.first("file_size").alias("file_size"))
    files = structure.files(splits, states, end_tag).join(sizes, "source_file").withColumn(
        "encoding", F.upper(F.coalesce("encoding", F.lit(config.encoding)))
    )
    found = [r["encoding"] for r in files.select("encoding").distinct().collect()]
    known = _readable(found)
    reason = F.when(F.col("incomplete"), F.lit("the last record has no end")).when(
        F.col("left_open"), F.lit("a comment, CDATA section or instruction has no end")
    ).when(~F.col("encoding").isin(known), F.concat(F.lit("encoding "), F.col("encoding"), F.lit(" cannot be read")))
    judged = materialize(files.withColumn("reason", reason), "stream-files")

    def of(encoding: str, cut: bool) -> DataFrame:
        # Files of one micro-batch: a few rows each, bounded by what one trigger lists.
        own = judged.where((F.col("encoding") == encoding) & ((F.col("cuts") > 0) == cut) & F.col("reason").isNull())
        return chunked.join(F.broadcast(own.select("source_file")), "source_file", "left_semi")

    ways = [(r["encoding"], r["cut"]) for r in judged.where("reason IS NULL").select(
        "encoding", (F.col("cuts") > 0).alias("cut")
    ).distinct().collect()]
    if config.check_contents and ways:
        checks = []
        for encoding, cut in ways:
            part = structure.with_states(of(encoding, cut), states) if cut else of(encoding, cut)
            used = None if records.is_plain(encoding) else encoding
            # A landed file may be a document or a part of one, so no root is asked for.
            checks.append(validate.checked_files(
                validate.checked_chunks(part.withColumn("fragments", F.lit(True)), end_tag, used), end_tag
            ))
        errors = reduce(DataFrame.unionByName, checks).select(
            "source_file", F.coalesce("error", F.when(F.col("nested"), F.lit("records inside records"))).alias("error")
        )
        judged = materialize(
            judged.join(errors, "source_file", "left").withColumn("reason", F.coalesce("reason", "error")).drop("error"),
            "stream-checked",
        )
    parts = []
    for encoding, cut in ways:
        part = of(encoding, cut).select("source_file", "split_start", "chunk_no", "file_size", "chunk")
        if cut:
            part = structure.rejoined(part, states, end_tag)
        parts.append(records.from_chunks(part, end_tag, encoding))
    if not parts:
        none = spark.createDataFrame([], "source_file STRING, split_start BIGINT, chunk_no BIGINT, chunk STRING")
        parts.append(records.from_chunks(none, end_tag))
    bad = judged.where("reason IS NOT NULL").select("source_file", "file_size", "reason")
    return reduce(DataFrame.unionByName, parts), bad


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Files of a batch are looked up by a few tasks a core, not by one task for each file.

    A stream reads this setting of its session at each batch, so it has to hold for as long as the stream runs.
    """
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def ingest(
    landed: DataFrame, app_name: str, catalog: DataFrame, config: PackageConfig, *, path: str, dead_letters: str,
    checkpoint: str, broadcast: bool, end_tag: str = records.DEFAULT_END, available_now: bool = True,
) -> StreamingQuery:
    """Normalized rows of landed files at ``path``, refused files at ``dead_letters``, both Parquet by ``batch_id``.

    The checkpoint says which files a batch has; a batch that is repeated replaces its own two directories.
    A file is judged once, as it landed: complete files are moved in, and a corrected one lands under a new name.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        chunked = batch.withColumn("chunk_no", F.monotonically_increasing_id())
        sound, bad = sort_out(chunked, end_tag, config)
        letters = bad.select(F.lit(app_name.upper()).alias("app_name"), "source_file", "file_size", "reason")
        letters.write.mode("overwrite").parquet(f"{dead_letters}/{BATCH}={batch_id}")
        rows = normalize(
            cells(sound.withColumn("app_name", F.lit(app_name.upper())), record_id=config.record_id),
            catalog, config.local_ref_base_positions, broadcast=broadcast,
            fail_on_unmapped=config.fail_on_unmapped_field, output_unknown=config.output_unknown_fields,
        )
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = landed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
