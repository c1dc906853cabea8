"""Cells: one row per numbered element of a record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions import xml

ID_POSITION = "1"

RecordId = Callable[[Column], Column]


def packed_records(
    records: DataFrame, body: str = "body", record_id: RecordId | None = None
) -> DataFrame:
    """Replace the body by its packed cells, and add ``record_id``.

    The record id is the text of the first cell at position 1, read before the
    cells are exploded, or whatever ``record_id`` makes of the body.
    """
    keep = [c for c in records.columns if c != body]
    plain = records.withColumn("plain", xml.pack_plain(F.col(body)))
    packed = plain.select(
        *keep, *([body] if record_id else []),
        xml.pack(F.col(body), F.col("plain")).alias("packed"),
    )
    if record_id:
        return packed.select(*keep, "packed", record_id(F.col(body)).alias("record_id"))
    first = packed.withColumn("first", xml.first_text(F.col("packed"), ID_POSITION))
    text = first.select(
        *keep, "packed",
        F.when(F.col("first") != "", F.substr("first", F.lit(2))).alias("id_text"),
    )
    plain_id = text.select(*keep, "packed", xml.unescape(F.col("id_text")).alias("id_text"))
    return plain_id.select(*keep, "packed", xml.strip(F.col("id_text")).alias("record_id"))


def cells(
    records: DataFrame, body: str = "body", record_id: RecordId | None = None
) -> DataFrame:
    """Explode records into cells, in document order by ``ord``.

    Adds ``record_id, ord, xml_element, raw_position, mv_index, sv_index, value``
    to the columns of ``records``; elements that are not ``cN`` are dropped.
    The steps are separate projections on purpose: each expression then runs
    once per cell, and the generated code stays small enough to be compiled.
    """
    keep = [*(c for c in records.columns if c != body), "record_id", "ord"]
    split = packed_records(records, body, record_id).select(
        *keep[:-1], xml.packed_fields(F.col("packed")).alias("fields")
    )
    exploded = split.select(*keep[:-1], "fields", F.explode(xml.cell_numbers(F.col("fields"))).alias("ord"))
    names = ("raw_position", "m", "s", "text")
    raw = exploded.select(
        *keep, *(f.alias(name) for name, f in zip(names, xml.cell_fields(F.col("fields"), F.col("ord"))))
    )
    plain = raw.select(
        *keep, "raw_position", "m", "s", xml.unescape(F.col("text")).alias("text")
    )
    return plain.select(
        *keep,
        F.concat(F.lit("c"), F.col("raw_position")).alias("xml_element"),
        "raw_position",
        xml.index_value(F.col("m")).alias("mv_index"),
        xml.index_value(F.col("s")).alias("sv_index"),
        xml.strip(F.col("text")).alias("value"),
    )
