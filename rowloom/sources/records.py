"""Record sources: XML exports as splittable text, and tables of record strings.

A file is read as text cut at the record end tag, so Spark splits it by bytes
whatever its size.  The end tag only decides where a chunk ends: a chunk may
hold several records, and the record pattern takes each of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions import xml

DEFAULT_END = "</row>"

# Files below this size are read with the default end tag; one chunk is at most
# the whole file, so only larger files need their own end tag for parallelism.
PROBE_BYTES = 32 * 1024 * 1024
PROBE_TOKENS = 5000

# Compressed table bytes that are worth a task of their own when cores are idle.
SPREAD_BYTES = 16 * 1024

_PREFIX = r"(?:[^\s/>:<]+:)?"
_ROW = rf"(?is)<{_PREFIX}row(?:\s[^>]*)?(?<!/)>(.*?)</{_PREFIX}row\s*>"
_PLAIN_START = "<row>"
_ROW_START = rf"(?i)<{_PREFIX}row(?=[\s/>])"


def local_path(uri: Column) -> Column:
    """Plain path of a ``file:`` URI; other schemes stay as they are."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^file:/+", "/")


def record_end_tag(spark: SparkSession, path: str) -> str:
    """The record end tag a file uses, read from its head."""
    head = spark.read.option("lineSep", ">").text(path).take(PROBE_TOKENS)
    for token in head:
        found = re.search(r"</(?:[^\s/>:<]+:)?row\s*$", token.value, re.IGNORECASE)
        if found:
            return found.group(0) + ">"
    return DEFAULT_END


def chunks(
    spark: SparkSession, paths: Iterable[str], end_tag: str = DEFAULT_END
) -> DataFrame:
    """Raw chunks: ``source_file, split_start, chunk_no, file_size, chunk``.

    ``(source_file, split_start, chunk_no)`` orders the chunks of a file.
    """
    return (
        spark.read.option("lineSep", end_tag)
        .text(list(paths))
        .select(
            local_path(F.col("_metadata.file_path")).alias("source_file"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("chunk_no"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("value").alias("chunk"),
        )
    )


def is_plain(encoding: str) -> bool:
    """Whether text in this encoding needs no decoding."""
    return encoding.upper() in ("UTF-8", "UTF8", "US-ASCII", "ASCII")


def decoded(chunk: Column, encoding: str) -> Column:
    """Text of a chunk in UTF-8 or in any single-byte encoding that extends ASCII.

    Bytes become characters one by one; those that the encoding places elsewhere are
    translated by a table of at most 128 entries made from its codec.
    """
    if is_plain(encoding):
        return chunk.cast("string")
    try:
        low = bytes(range(128)).decode(encoding)
        high = [bytes([code]).decode(encoding, "replace") for code in range(128, 256)]
    except (LookupError, UnicodeError) as error:
        raise ValueError(f"Records cannot be read in encoding {encoding!r}") from error
    pairs = [bytes([code, 0x41]).decode(encoding, "replace") for code in range(128, 256)]
    if low != bytes(range(128)).decode("ascii") or any(len(pair) != 2 for pair in pairs):
        raise ValueError(f"Records cannot be read in encoding {encoding!r}: not one byte a letter above ASCII")
    text = F.decode(chunk.cast("binary"), "ISO-8859-1")
    moved = [(chr(code), letter) for code, letter in enumerate(high, 128) if chr(code) != letter]
    return F.translate(text, "".join(a for a, _ in moved), "".join(b for _, b in moved)) if moved else text


def whole_chunk(chunk: Column, end_tag: str = DEFAULT_END, encoding: str = "UTF-8") -> Column:
    """Chunk text with its end tag back."""
    return xml.unix_newlines(F.concat(decoded(chunk, encoding), F.lit(end_tag)))


def bodies(chunk: Column) -> Column:
    """Bodies of all records in a clean chunk."""
    return F.regexp_extract_all(chunk, F.lit(_ROW), F.lit(1))


def _explode_bodies(table: DataFrame, keep: list[str]) -> DataFrame:
    """One row per record of the ``text`` column: ``keep``, ``record_no, body``.

    Most texts hold one record and nothing else: blank, ``<row>``, body,
    ``</row>``.  Those are cut with substring functions, which cost a fraction
    of the record pattern; all others go through the pattern.
    """
    text, before, body = F.col("text"), F.col("before"), F.col("body")
    inner = F.substring_index(text, DEFAULT_END, 1)
    cut = table.select(
        *keep, "text",
        F.substring_index(inner, _PLAIN_START, 1).alias("before"),
        F.substring_index(inner, _PLAIN_START, -1).alias("body"),
    )
    marked = cut.select(*keep, "text", "before", "body", F.lower("body").alias("low"))
    low = F.col("low")
    whole = F.octet_length(before) + F.octet_length(body) + len(_PLAIN_START + DEFAULT_END)
    plain = (
        (whole == F.octet_length(text))
        & ~before.contains("<")
        & ~low.contains("<row") & ~low.contains("</row") & ~low.contains(":row")
    )
    sorted_out = marked.select(*keep, "text", "body", plain.alias("plain"))
    cleaned = sorted_out.select(
        *keep, "body", "plain",
        F.when(F.col("plain"), F.lit("")).otherwise(xml.strip_markup(text)).alias("text"),
    )
    markup = F.col("body").contains("<!") | F.col("body").contains("<?")
    checked = cleaned.select(
        *keep, "body", "plain", xml.closed_markup(F.col("text")).alias("text")
    )
    found = (
        F.when(F.col("plain") & ~markup, F.array("body"))
        .when(F.col("plain"), F.array(xml.strip_markup(F.col("body"))))
        .otherwise(bodies(F.col("text")))
    )
    return checked.select(*keep, F.posexplode(found).alias("record_no", "body"))


def row_count(chunk: Column) -> Column:
    """Number of records in a clean chunk, empty and self-closing ones included."""
    return F.regexp_count(chunk, F.lit(_ROW_START))


def from_chunks(
    chunked: DataFrame, end_tag: str = DEFAULT_END, encoding: str = "UTF-8"
) -> DataFrame:
    """Records of a chunk table: its key columns, ``record_no`` and ``body``."""
    keys = [c for c in chunked.columns if c not in ("chunk", "file_size")]
    text = chunked.select(*keys, whole_chunk(F.col("chunk"), end_tag, encoding).alias("text"))
    return _explode_bodies(text, keys)


def stream_records(
    spark: SparkSession,
    paths: Iterable[str],
    end_tag: str = DEFAULT_END,
    encoding: str = "UTF-8",
) -> DataFrame:
    """All records that have a body, one row each."""
    return from_chunks(chunks(spark, paths, end_tag), end_tag, encoding)


def count_records(
    spark: SparkSession,
    paths: Iterable[str],
    end_tag: str = DEFAULT_END,
    encoding: str = "UTF-8",
) -> DataFrame:
    """``source_file, records``: every record element, with or without cells."""
    clean = (
        chunks(spark, paths, end_tag)
        .select("source_file", whole_chunk(F.col("chunk"), "", encoding).alias("chunk"))
        .withColumn("chunk", xml.strip_markup(F.col("chunk")))
        .withColumn("chunk", xml.closed_markup(F.col("chunk")))
    )
    return clean.groupBy("source_file").agg(
        F.sum(row_count(F.col("chunk"))).cast("bigint").alias("records")
    )


def from_table(table: DataFrame, record: str, *keep: str) -> DataFrame:
    """Records held as ``<row>…</row>`` strings in a column of any table."""
    text = table.select(*keep, xml.unix_newlines(F.col(record)).alias("text"))
    return _explode_bodies(text, list(keep))


def spread(table: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the cluster has cores, spread over more.

    Rendering and parsing records is bound by CPU, so a table in one row group
    would keep one core busy.  The number of partitions follows the size of the
    files, and a scan that has enough splits is left alone.
    """
    spark = table.sparkSession
    cores = spark.sparkContext.defaultParallelism
    partitions = table.rdd.getNumPartitions()
    if partitions >= cores:
        return table
    files = spark.read.format("binaryFile").load(table.inputFiles())
    size = files.agg(F.sum("length")).first()[0] or 0
    wanted = min(cores, -(-size // SPREAD_BYTES))
    return table.repartition(wanted) if wanted > partitions else table
