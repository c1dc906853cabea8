"""The field catalog: one row per application and position.

Definitions of the same position are merged with the later source winning as a
whole record.  Fields and relationships are merged in the same aggregation but
separately, so a field replaced by a customization keeps the relationship an
earlier source gave it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.config import RELATIONSHIPS
from rowloom.operators.metadata import (
    FIELD_COLUMNS,
    RELATIONSHIP_COLUMNS,
    as_relationship,
    definitions,
)

_KEY = ("app_name", "position")


def _latest(value: Column) -> Column:
    """The value with the highest source rank and ordinal among rows that have one."""
    order = F.when(value.isNotNull(), F.struct("source_rank", "ordinal"))
    return F.max_by(value, order)


def catalog(docs: DataFrame) -> DataFrame:
    """``app_name, position, field, relationship``; either struct may be null.

    A definition can be a field, a relationship or both, so one aggregation over
    the definitions merges the two.  Map-side partial aggregation leaves at most
    one row per position and task to shuffle.
    """
    field = F.struct(*(c for c in FIELD_COLUMNS if c not in _KEY))
    relationship = F.struct(*(c for c in RELATIONSHIP_COLUMNS if c not in _KEY))
    rows = as_relationship(definitions(docs)).select(
        *_KEY, "source_rank", "ordinal",
        F.when(F.col("kind") != RELATIONSHIPS, field).alias("field"),
        F.when(F.col("target_application").isNotNull(), relationship).alias("relationship"),
    )
    return rows.groupBy(*_KEY).agg(
        _latest(F.col("field")).alias("field"),
        _latest(F.col("relationship")).alias("relationship"),
    )


def fields(merged: DataFrame) -> DataFrame:
    """Winning field definitions."""
    found = merged.filter(F.col("field").isNotNull())
    return found.select(
        *(F.col(c) if c in _KEY else F.col("field")[c].alias(c) for c in FIELD_COLUMNS)
    )


def relationships(merged: DataFrame) -> DataFrame:
    """Winning relationships."""
    found = merged.filter(F.col("relationship").isNotNull())
    return found.select(
        *(F.col(c) if c in _KEY else F.col("relationship")[c].alias(c) for c in RELATIONSHIP_COLUMNS)
    )


def resolve_field(merged: DataFrame, app_name: str, position: str) -> DataFrame:
    return list_fields(merged, app_name).filter(F.col("position") == position)


def resolve_relationship(merged: DataFrame, app_name: str, position: str) -> DataFrame:
    return relationships(merged).filter(
        (F.col("app_name") == app_name.upper()) & (F.col("position") == position)
    )


def has_app_metadata(merged: DataFrame, app_name: str) -> bool:
    return not list_fields(merged, app_name).isEmpty()


def metadata_presence(apps: DataFrame, merged: DataFrame) -> DataFrame:
    """``app_name, has_metadata`` for a table of applications: the same question for many at once."""
    known = fields(merged).select("app_name").distinct().withColumn("has_metadata", F.lit(True))
    return apps.join(known, "app_name", "left").withColumn("has_metadata", F.coalesce("has_metadata", F.lit(False)))


def list_fields(merged: DataFrame, app_name: str) -> DataFrame:
    return fields(merged).filter(F.col("app_name") == app_name.upper())


def list_local_ref_fields(merged: DataFrame, app_name: str) -> DataFrame:
    """Fields whose position has a dot, whatever their flag says."""
    return list_fields(merged, app_name).filter(F.contains("position", F.lit(".")))


def summary(merged: DataFrame) -> DataFrame:
    """Number of fields and of dotted fields per application."""
    return (
        merged.filter(F.col("field").isNotNull())
        .groupBy("app_name")
        .agg(
            F.count(F.lit(1)).alias("n_fields"),
            F.count_if(F.contains("position", F.lit("."))).alias("n_local_ref_fields"),
        )
    )
