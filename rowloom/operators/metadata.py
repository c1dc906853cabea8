"""Metadata loaders: documents of four kinds to field and relationship rows.

A metadata document describes one application and is small, so it is parsed as
one row (``app_name, source, kind, content``); Spark spreads the documents over
the cluster.  A document becomes one row per definition node, and all kinds go
through one projection, so a catalog parses each document once and only the
final merge shuffles.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.config import CUSTOMIZATION, LOCAL_REF, RELATIONSHIPS, STANDARD_SELECTION

# Meaning of the repeated columns of a schema row.
SCHEMA_COLUMNS = {
    "C1": "field_name",
    "C2": "system_type",
    "C3": "position",
    "C4": "data_type",
    "C5": "validation_rule",
    "C6": "format_rule",
    "C7": "cardinality",
    "C8": "relationship_target",
    "C9": "alignment",
    "C10": "input_status",
    "C11": "description",
}
CUSTOM_SYSTEM_TYPES = ("USR", "LOCAL", "CUSTOM")

# Node tags and child tags of the node-style documents.
NODE_TAGS = {
    LOCAL_REF: ("FIELD", "LOCAL.FIELD", "LOCAL_REF_FIELD", "REF.FIELD"),
    CUSTOMIZATION: ("FIELD", "CUSTOM.FIELD", "CUSTOM_FIELD", "LOCAL.FIELD"),
    RELATIONSHIPS: ("RELATIONSHIP", "RELATION", "LINK"),
}
CHILD_TAGS = {
    LOCAL_REF: {
        "field_name": ("NAME", "FIELD.NAME", "C1"),
        "position": ("POSITION", "LOCATION", "POS", "C3"),
        "data_type": ("TYPE", "DATA.TYPE", "C4"),
        "validation_rule": ("VALIDATION", "VALIDATION.RULE", "C5"),
        "format_rule": ("FORMAT", "LENGTH", "C6"),
        "cardinality": ("CARDINALITY", "MULTI.VALUE", "C7"),
        "relationship_target": ("RELATIONSHIP", "FOREIGN.KEY", "C8"),
        "description": ("DESCRIPTION", "DESC", "C11"),
    },
    CUSTOMIZATION: {
        "field_name": ("NAME", "FIELD.NAME", "FIELD_NAME"),
        "position": ("POSITION", "LOCATION", "FIELD.NO", "POS"),
        "data_type": ("TYPE", "DATA.TYPE", "DATA_TYPE"),
        "validation_rule": ("VALIDATION", "VALIDATION.RULE"),
        "format_rule": ("FORMAT", "LENGTH"),
        "cardinality": ("CARDINALITY", "SINGLE.MULTI", "MULTI.VALUE"),
        "relationship_target": ("RELATIONSHIP", "TARGET.APPLICATION", "FOREIGN.KEY"),
        "description": ("DESCRIPTION", "DESC"),
    },
    RELATIONSHIPS: {
        "field_name": ("FIELD", "FIELD.NAME", "SOURCE.FIELD"),
        "position": ("POSITION", "LOCATION", "SOURCE.POSITION"),
        "target_application": (
            "TARGET", "TARGET.APPLICATION", "APPLICATION", "FOREIGN.APPLICATION",
        ),
        "relationship_type": ("TYPE", "RELATIONSHIP.TYPE"),
    },
}

# Later sources win over earlier ones.
SOURCE_RANK = {STANDARD_SELECTION: 1, LOCAL_REF: 2, CUSTOMIZATION: 3, RELATIONSHIPS: 4}
SCHEMA_RELATIONSHIP = "STANDARD_SELECTION_C8"

FIELD_COLUMNS = (
    "app_name", "field_name", "position", "system_type", "data_type", "validation_rule",
    "format_rule", "cardinality", "relationship_target", "alignment", "input_status",
    "description", "is_local_ref", "is_custom_field", "source",
)
RELATIONSHIP_COLUMNS = (
    "app_name", "field_name", "position", "target_application", "relationship_type", "source",
)

_FIELD_ATTRIBUTES = tuple(SCHEMA_COLUMNS.values())
_ATTRIBUTES = (*_FIELD_ATTRIBUTES, "target_application", "relationship_type")

_CHILD = pa.struct([("tag", pa.string()), ("text", pa.string())])
_NODE = pa.schema(
    [
        ("app_name", pa.string()), ("source", pa.string()), ("kind", pa.string()),
        ("column_style", pa.bool_()), ("node", pa.int32()), ("children", pa.list_(_CHILD)),
    ]
)
_NODE_DDL = (
    "app_name STRING, source STRING, kind STRING, column_style BOOLEAN, node INT, "
    "children ARRAY<STRUCT<tag: STRING, text: STRING>>"
)


def _local_tag(element: ET.Element) -> str:
    return element.tag.rpartition("}")[2].upper()


def _children(element: ET.Element) -> list[dict]:
    return [{"tag": _local_tag(c), "text": (c.text or "").strip()} for c in element]


def _nodes(kind: str, content: bytes | str) -> Iterator[dict]:
    """The first ROW of a column-style document, or every definition node.

    A column-style document without a ROW gives one row whose children are null.
    """
    elements = [(_local_tag(e), e) for e in ET.fromstring(content).iter()]
    tags = {tag for tag, _ in elements}
    if kind == STANDARD_SELECTION or (kind == LOCAL_REF and {"C1", "C3"} <= tags):
        row = next((e for tag, e in elements if tag == "ROW"), None)
        yield {"column_style": True, "node": 0, "children": None if row is None else _children(row)}
        return
    found = (e for tag, e in elements if tag in NODE_TAGS[kind])
    for number, element in enumerate(found):
        yield {"column_style": False, "node": number, "children": _children(element)}


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for document in batch.to_pylist():
            content = document.pop("content")
            rows = [{**document, **node} for node in _nodes(document["kind"], content)]
            yield pa.RecordBatch.from_pylist(rows, schema=_NODE)


def documents(files: DataFrame) -> DataFrame:
    """Definition nodes of metadata documents, from ``app_name, source, kind, content``."""
    named = files.select(F.upper("app_name").alias("app_name"), "source", "kind", "content")
    return named.mapInArrow(_parse, _NODE_DDL)


def _quoted(tags: tuple[str, ...]) -> str:
    return "array(" + ", ".join(f"'{t}'" for t in tags) + ")"


def _zipped() -> str:
    """One struct per index of the repeated columns, as many as C1 and C3 both have."""
    names = ", ".join(f"nullif(x.{tag}, '') AS {name}" for tag, name in SCHEMA_COLUMNS.items())
    columns = ", ".join(SCHEMA_COLUMNS)
    return (
        f"transform(slice(arrays_zip({columns}), 1, least(size(C1), size(C3))), "
        f"x -> struct({names}, CAST(NULL AS STRING) AS target_application, "
        "CAST(NULL AS STRING) AS relationship_type))"
    )


def _first_child(attribute: str) -> str:
    """Text of the first child, in document order, whose tag is listed; blank is null.

    A blank first match is final: later synonyms are not tried.
    """
    cases = "".join(
        f" WHEN '{kind}' THEN {_quoted(tags[attribute])}"
        for kind, tags in CHILD_TAGS.items()
        if attribute in tags
    )
    if not cases:
        return "CAST(NULL AS STRING)"
    listed = f"CASE kind{cases} ELSE array() END"
    return f"nullif(get(filter(children, c -> array_contains({listed}, c.tag)), 0).text, '')"


def definitions(docs: DataFrame) -> DataFrame:
    """Every usable definition: its attributes, flags, ``source_rank`` and ``ordinal``.

    Fields need a name and a position, relationships a position and a target.
    """
    columns = [
        f"coalesce(filter(children, c -> c.tag = '{tag}').text, array()) AS {tag}"
        for tag in SCHEMA_COLUMNS
    ]
    single = ", ".join(f"{_first_child(a)} AS {a}" for a in _ATTRIBUTES)
    ranks = "".join(f" WHEN '{kind}' THEN {rank}" for kind, rank in SOURCE_RANK.items())
    custom = ", ".join(f"'{t}'" for t in CUSTOM_SYSTEM_TYPES)
    keys = ("app_name", "source", "kind", "column_style")
    return (
        docs.selectExpr(*keys, "node", "children", *columns)
        .selectExpr(
            *keys, "node",
            f"posexplode(CASE WHEN column_style THEN {_zipped()} ELSE array(struct({single})) END)"
            " AS (index, d)",
        )
        .selectExpr(*keys, f"CASE kind{ranks} END AS source_rank", "node + index AS ordinal", "d.*")
        .withColumns(
            {
                "field_name": F.expr(
                    f"coalesce(field_name, IF(kind = '{RELATIONSHIPS}', "
                    "concat('FIELD_', position), NULL))"
                ),
                "system_type": F.expr(
                    f"CASE WHEN column_style THEN system_type WHEN kind = '{LOCAL_REF}' "
                    "THEN 'USR' ELSE 'CUSTOM' END"
                ),
                "is_local_ref": F.expr(
                    f"(NOT column_style AND kind = '{LOCAL_REF}') OR contains(position, '.')"
                ),
            }
        )
        .withColumn(
            "is_custom_field",
            F.expr(f"NOT column_style OR coalesce(upper(system_type) IN ({custom}), false)"),
        )
        .filter(
            "position IS NOT NULL AND field_name IS NOT NULL AND "
            f"(kind <> '{RELATIONSHIPS}' OR target_application IS NOT NULL)"
        )
    )


def column_style_problems(docs: DataFrame) -> DataFrame:
    """``source, message`` of every column-style document that cannot be loaded."""
    no_row = F.concat(F.lit("No <ROW> element found: "), F.col("source"))
    no_columns = F.concat(
        F.lit("Repeated <C1> names and <C3> positions are required: "), F.col("source")
    )
    return (
        docs.filter("column_style")
        .select(
            "source",
            F.when(F.col("children").isNull(), no_row)
            .when(F.expr("NOT array_contains(children.tag, 'C1')"), no_columns)
            .when(F.expr("NOT array_contains(children.tag, 'C3')"), no_columns)
            .alias("message"),
        )
        .filter(F.col("message").isNotNull())
    )


def load_fields(docs: DataFrame) -> DataFrame:
    """Every field definition of every document, with its precedence."""
    fields = definitions(docs).filter(F.col("kind") != RELATIONSHIPS)
    return fields.select(*FIELD_COLUMNS, "source_rank", "ordinal")


def as_relationship(defined: DataFrame) -> DataFrame:
    """Relationship attributes of definitions; null target where there is none.

    Column-style rows name a target in C8; node-style fields register none.
    """
    from_column = F.when(F.col("column_style"), F.col("relationship_target"))
    return defined.withColumns(
        {
            "target_application": F.coalesce("target_application", from_column),
            "relationship_type": F.when(from_column.isNotNull(), F.lit(SCHEMA_RELATIONSHIP))
            .otherwise(F.col("relationship_type")),
        }
    )


def load_relationships(docs: DataFrame) -> DataFrame:
    """Relationships named in C8 and in relationship documents, with precedence."""
    linked = as_relationship(definitions(docs)).filter(F.col("target_application").isNotNull())
    return linked.select(*RELATIONSHIP_COLUMNS, "source_rank", "ordinal")
