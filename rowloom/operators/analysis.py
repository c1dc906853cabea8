"""Queries on normalized rows: filters, profile, wide pivot, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREVIEW_COLUMNS = (
    "app_name", "record_id", "xml_element", "resolved_position", "field_name",
    "mv_index", "sv_index", "value", "is_mapped",
)
TABLE_COLUMNS = (*PREVIEW_COLUMNS, "warnings")


def one_record(normalized: DataFrame, record_id: str) -> DataFrame:
    return normalized.filter(F.col("record_id") == record_id)


def mapped_only(normalized: DataFrame) -> DataFrame:
    return normalized.filter("is_mapped")


def local_refs_only(normalized: DataFrame) -> DataFrame:
    return normalized.filter("is_local_ref")


def with_warnings(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("warnings").isNotNull())


def profile(normalized: DataFrame) -> DataFrame:
    """One row: cells, distinct records, mapped and unmapped cells."""
    return normalized.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("record_id").alias("unique_records"),
        F.count_if("is_mapped").alias("mapped_fields"),
        F.count_if(~F.col("is_mapped")).alias("unmapped_fields"),
    )


def run_metrics(record_counts: DataFrame, normalized: DataFrame) -> DataFrame:
    """Records and cells per application; ``record_counts`` has ``app_name, records``."""
    counted = record_counts.groupBy("app_name").agg(F.sum("records").alias("records"))
    cells = normalized.groupBy("app_name").agg(F.count(F.lit(1)).alias("cells"))
    return counted.join(cells, "app_name", "left").select(
        "app_name", "records", F.coalesce("cells", F.lit(0)).alias("cells")
    )


def wide(
    normalized: DataFrame, order: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """One row per record and one column per field: the first non-empty value.

    ``order`` names the columns that give document order.  ``names`` are the
    field names to show; without it they are read from the data, which costs a
    distinct over the field names.  The first value is found by a partial
    aggregation, so no record is gathered in one place.
    """
    filled = normalized.filter((F.col("value") != "") & (F.col("record_id") != ""))
    pivot = filled.groupBy("app_name", "record_id").pivot("field_name", list(names) if names else None)
    return pivot.agg(F.min_by("value", F.struct("source_file", *order)))


def preview(normalized: DataFrame, rows: int = 30) -> DataFrame:
    return normalized.select(*PREVIEW_COLUMNS).limit(rows)


def bounded_table(normalized: DataFrame, rows: int = 50) -> tuple[DataFrame, int]:
    """The first rows in display columns, and how many more there are."""
    return normalized.select(*TABLE_COLUMNS).limit(rows), max(normalized.count() - rows, 0)
