"""Render table columns as record XML and as metadata documents.

The reverse of the readers: it turns any table into record strings, so tables
can be exported as packages and the operators can run on data held in tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.xml import escape
from rowloom.operators.metadata import SCHEMA_COLUMNS


def cell(position: str, value: Column, m: Column | str | None = None,
         s: Column | str | None = None, plain: bool = False) -> Column:
    """``<cN m= s=>value</cN>``; a null value renders as an empty element.

    ``plain``: the value is a number, a date or the like, in which nothing has to be escaped.
    """
    parts = [F.lit(f"<c{position}")]
    for name, index in (("m", m), ("s", s)):
        if index is not None:
            text = F.lit(index) if isinstance(index, str) else index.cast("string")
            parts += [F.lit(f' {name}="'), text, F.lit('"')]
    text = F.coalesce(value.cast("string"), F.lit(""))
    text = text if plain else escape(text)
    return F.concat(*parts, F.lit(">"), text, F.lit(f"</c{position}>"))


def record(*parts: Column) -> Column:
    return F.concat(F.lit("<row>"), *parts, F.lit("</row>"))


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)").cast("string")


def day(value: Column) -> Column:
    """``yyyyMMdd``; of years from 1 on, the digits of the date as text, which take no formatter."""
    date = value.cast("date")
    return F.when(date >= F.lit("0001-01-01").cast("date"), F.replace(date.cast("string"), F.lit("-"), F.lit(""))).otherwise(
        F.date_format(value, "yyyyMMdd")
    )


def schema_document(columns: dict[str, Sequence[str]]) -> str:
    """A schema document from named lists, e.g. ``field_name`` and ``position``."""
    parts = []
    for tag, name in SCHEMA_COLUMNS.items():
        for value in columns.get(name, ()):
            text = value.replace("&", "&amp;").replace("<", "&lt;")
            parts.append(f"<{tag}>{text}</{tag}>")
    return "<ROW>" + "".join(parts) + "</ROW>"


def write_records(records: DataFrame, record: str, path: str) -> None:
    """Write record strings as the part files of ``data/{APP}.xml/``."""
    records.select(F.col(record).alias("value")).write.mode("overwrite").text(path)


def write_files(contents: DataFrame, path: str) -> None:
    """Write each text of a one-column table as a file of its own, all in one directory.

    Tasks move their files into place themselves; else the driver would move them one by one at the end.
    """
    writer = contents.write.mode("overwrite").option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)


def write_document(spark: SparkSession, text: str, path: str) -> None:
    """Write one small document; the directory ends up holding one text file."""
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
