"""Output formats for normalized rows. Writers return the number of rows written.

The count is observed during the write itself; nothing is read twice.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rowloom.operators.normalize import OUTPUT_COLUMNS
from rowloom.plans.scratch import materialize

FLAGS = ("is_local_ref", "is_custom_field", "is_mapped")
TABLE_SINK_COLUMNS = ("app_name", "record_id", "field_name", "mv_index", "sv_index", "value")


def rows(normalized: DataFrame) -> DataFrame:
    """Exactly the output columns, in order."""
    return normalized.select(*OUTPUT_COLUMNS)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_csv(normalized: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """CSV with header; null and empty are both empty, flags are ``True``/``False``."""
    spelled = rows(normalized).withColumns(
        {flag: F.initcap(F.col(flag).cast("string")) for flag in FLAGS}
    )
    counted, seen = _counted(spelled)
    counted.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, encoding="UTF-8",
    )
    return seen.get["rows"]


def write_jsonl(normalized: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """One JSON object per line with every key, nulls included."""
    counted, seen = _counted(rows(normalized))
    counted.write.mode(mode).json(path, ignoreNullFields=False, encoding="UTF-8")
    return seen.get["rows"]


def write_parquet(normalized: DataFrame, path: str, mode: str = "errorifexists") -> int:
    counted, seen = _counted(rows(normalized))
    counted.write.mode(mode).parquet(path)
    return seen.get["rows"]


def write_table(
    normalized: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
    mode: str = "append",
) -> int:
    """The six key columns into a database table over JDBC."""
    counted, seen = _counted(normalized.select(*TABLE_SINK_COLUMNS))
    counted.write.jdbc(url, table, mode=mode, properties=properties or {})
    return seen.get["rows"]


def to_list(normalized: DataFrame) -> list[dict]:
    """All rows on the driver, for small results."""
    return [r.asDict() for r in rows(normalized).collect()]


def iterate(normalized: DataFrame) -> Iterator[dict]:
    """Rows one partition at a time."""
    return (r.asDict() for r in rows(normalized).toLocalIterator())


def write_all(normalized: DataFrame, **paths: str) -> dict[str, int]:
    """Several formats from one run: ``csv=``, ``jsonl=``, ``parquet=`` paths.

    The rows are written to the shared folder once, and every format is made
    from that table instead of parsing the records again.
    """
    writers = {"csv": write_csv, "jsonl": write_jsonl, "parquet": write_parquet}
    unknown = set(paths) - set(writers)
    if unknown:
        raise ValueError(f"Unknown formats: {sorted(unknown)}")
    table = materialize(rows(normalized), "normalized")
    return {name: writers[name](table, path) for name, path in paths.items()}
