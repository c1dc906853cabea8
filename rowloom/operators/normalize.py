"""Normalization: cells joined to the catalog, one output row per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.plans.scratch import materialize

OUTPUT_COLUMNS = (
    "app_name", "record_id", "source_file", "xml_element", "raw_position",
    "resolved_position", "field_name", "system_type", "data_type", "format_rule",
    "cardinality", "mv_index", "sv_index", "value", "relationship_target",
    "is_local_ref", "is_custom_field", "is_mapped", "warnings",
)

# Warning codes, in the order they are reported.
UNMAPPED = "UNMAPPED_FIELD"
LOCAL_REF_UNMAPPED = "LOCAL_REF_WITHOUT_METADATA"
SUB_WITHOUT_MULTI = "SUB_VALUE_WITHOUT_MULTI_VALUE"

# Positions whose cells are joined without a shuffle where the catalog is too large to send: as many as
# HEAVY, found by a summary of TRACKED counters.  Catalog rows of more than ROW_BYTES are left to the
# shuffle, so what is sent is at most HEAVY * ROW_BYTES.
HEAVY, TRACKED, ROW_BYTES = 4_096, 32_768, 4_096
# Separates application and position in one key; it cannot occur in XML.
SEPARATOR = "\x00"

_SLIM = (
    "field_name", "system_type", "data_type", "format_rule", "cardinality",
    "relationship_target", "is_local_ref", "is_custom_field",
)


def _filled(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def in_local_ref_array(bases: tuple[str, ...]) -> Column:
    """The cell lies in a local-reference array and says which field it is."""
    if not bases:
        return F.lit(False)
    return F.col("raw_position").isin(*bases) & _filled(F.col("mv_index"))


def resolved_position(bases: tuple[str, ...]) -> Column:
    return F.when(
        in_local_ref_array(bases), F.concat("raw_position", F.lit("."), "mv_index")
    ).otherwise(F.col("raw_position"))


def lookup_table(catalog: DataFrame) -> DataFrame:
    """The catalog columns that cells need, unique by application and position."""
    return catalog.select(
        F.col("app_name"),
        F.col("position").alias("resolved_position"),
        F.struct(*(F.col("field")[c].alias(c) for c in _SLIM)).alias("f"),
        F.col("field").isNotNull().alias("has_field"),
        F.col("relationship")["target_application"].alias("target"),
    )


def _row_bytes() -> Column:
    """Text of a row of the lookup table, and a little for each row."""
    texts = ["app_name", "resolved_position", "target", *(f"f.{c}" for c in _SLIM if not c.startswith("is_"))]
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(64))


def lookup_bytes(catalog: DataFrame) -> int:
    """Measured size of what a broadcast of the catalog would send."""
    return lookup_table(catalog).agg(F.sum(_row_bytes())).first()[0] or 0


def heavy_positions(cells: DataFrame) -> DataFrame:
    """``app_name, resolved_position`` of the positions with most cells, mapped or not.

    Every position that has more than about 1 / HEAVY + 4 / TRACKED of all cells is among them.  The summary
    depends on the order in which its parts meet, so it is written once: both
    sides of the join have to agree about what is heavy.
    """
    key = F.concat("app_name", F.lit(SEPARATOR), "resolved_position")
    top = cells.select(key.alias("key")).where("key IS NOT NULL").agg(F.expr(f"approx_top_k(key, {HEAVY}, {TRACKED})").alias("top"))
    item = F.split(F.col("found.item"), SEPARATOR, 2)
    found = top.select(F.explode("top").alias("found")).select(
        item[0].alias("app_name"), item[1].alias("resolved_position")
    )
    return materialize(found, "heavy")


def attach_catalog(cells: DataFrame, catalog: DataFrame, broadcast: bool) -> DataFrame:
    """Left join on (application, resolved position).

    ``broadcast`` is for catalogs of measured, bounded size: cells then never move.
    Otherwise one pass over the cells finds the heavy positions, at once; their cells are joined to their few
    catalog rows in place, and only the cells of all other positions are shuffled.
    """
    keys = ["app_name", "resolved_position"]
    table = lookup_table(catalog)
    if broadcast:
        return cells.join(F.broadcast(table), keys, "left")
    heavy = heavy_positions(cells)
    known = table.join(F.broadcast(heavy), keys, "left_semi").withColumn("large", _row_bytes() > ROW_BYTES)
    # Of a large row only the key is sent, so that its cells can be told apart and moved.
    slim = known.select(*keys, F.when(~F.col("large"), F.col("f")).alias("f"), "has_field",
                        F.when(~F.col("large"), F.col("target")).alias("target"), "large")
    rows = heavy.join(F.broadcast(slim), keys, "left").where(~F.coalesce("large", F.lit(False))).drop("large")
    in_place = cells.join(F.broadcast(rows), keys)
    moved = cells.join(F.broadcast(rows.select(*keys)), keys, "left_anti").join(table, keys, "left")
    return in_place.unionByName(moved)


def warning_text(mapped: Column, bases: tuple[str, ...]) -> Column:
    """The warning codes joined by commas, null when there are none."""
    sub_without_multi = _filled(F.col("sv_index")) & ~_filled(F.col("mv_index"))
    codes = F.concat_ws(
        ",",
        F.when(~mapped, F.lit(UNMAPPED)),
        F.when(~mapped & in_local_ref_array(bases), F.lit(LOCAL_REF_UNMAPPED)),
        F.when(sub_without_multi, F.lit(SUB_WITHOUT_MULTI)),
    )
    return F.when(~mapped | sub_without_multi, codes)


def normalize(
    cells: DataFrame,
    catalog: DataFrame,
    bases: tuple[str, ...] = ("64",),
    *,
    broadcast: bool,
    fail_on_unmapped: bool = False,
    output_unknown: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Normalized rows in the 19 output columns, then the ``keep`` columns of ``cells``.

    ``cells`` needs ``app_name, source_file`` besides the columns of the cell
    operator.  Strict mode is a filter, which column pruning cannot drop: any
    action on the result fails at the first unmapped cell it meets.
    """
    resolved = cells.withColumn("resolved_position", resolved_position(bases))
    joined = attach_catalog(resolved, catalog, broadcast).withColumn(
        "is_mapped", F.coalesce("has_field", F.lit(False))
    )
    mapped = F.col("is_mapped")
    if fail_on_unmapped:
        message = F.concat(
            F.lit("No field of "), F.col("app_name"), F.lit(" is defined at position "), F.col("resolved_position"),
            F.lit(" (element "), F.col("xml_element"), F.lit(")"),
        )
        joined = joined.filter(
            F.when(mapped, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        )
    if not output_unknown:
        joined = joined.filter(mapped)
    computed = {
        "field_name": F.coalesce(
            "f.field_name", F.concat(F.lit("FIELD_"), F.col("resolved_position"))
        ),
        "relationship_target": F.coalesce("target", "f.relationship_target"),
        "is_local_ref": F.coalesce("f.is_local_ref", in_local_ref_array(bases)),
        "is_custom_field": F.coalesce("f.is_custom_field", F.lit(False)),
        "warnings": warning_text(mapped, bases),
    }
    for name in ("system_type", "data_type", "format_rule", "cardinality"):
        computed[name] = F.col("f")[name]
    return joined.select(
        *(computed.get(c, F.col(c)).alias(c) for c in OUTPUT_COLUMNS), *keep
    )


def strict_violations(normalized: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """What strict mode would stop at: the first unmapped cell of each application, and how many there are.

    ``order``: the columns of ``normalized`` that give the order of cells in a file, after its name.
    One partial aggregation; no application is gathered or sorted.
    """
    first = F.min_by(
        F.struct("source_file", "record_id", "xml_element", "resolved_position", "value"), F.struct("source_file", *order)
    )
    return normalized.where(~F.col("is_mapped")).groupBy("app_name").agg(
        first.alias("first"), F.count("*").alias("n_unmapped")
    ).select("app_name", "first.*", "n_unmapped")
