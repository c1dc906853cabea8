"""Queries over tables: rows rendered as record XML and run through the operators.

Every query takes ``(spark, sf_dir)`` and reads its tables whole.  Small schema
documents that describe a table's positions are literals; catalogs that grow
with the data are rendered from tables as many small documents, one per
application, and joined by shuffle instead of broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom import sinks
from rowloom.config import (
    CUSTOMIZATION,
    LOCAL_REF,
    RELATIONSHIPS,
    STANDARD_SELECTION,
    PackageConfig,
)
from rowloom.functions.xml import escape
from rowloom.operators import analysis, catalog, metadata, validate
from rowloom.operators.cells import cells
from rowloom.operators.normalize import normalize, strict_violations
from rowloom.plans.run import Normalization
from rowloom.plans.scratch import scratch_path
from rowloom.sources import package, records
from rowloom.sources.render import (
    cell,
    day,
    money,
    record,
    schema_document,
    write_document,
    write_files,
    write_records,
)
from rowloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
col, lit = F.col, F.lit

FIELDS_PER_DOCUMENT = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return records.spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def text(value: Column) -> Column:
    return value.cast("string")


# --- schema documents of the rendered tables -------------------------------- #


def schema(*fields: tuple[str, str, str, str, str, str, str]) -> str:
    """A schema document; a field is (position, name, system, type, format, cardinality, target)."""
    names = (
        "position", "field_name", "system_type", "data_type", "format_rule",
        "cardinality", "relationship_target",
    )
    return schema_document({n: [f[i] for f in fields] for i, n in enumerate(names)})


CUSTOMER_SCHEMA = schema(
    ("1", "CUSTOMER.KEY", "SYS", "N", "12.1", "SINGLE", ""),
    ("2", "CUSTOMER.NAME", "SYS", "A", "35.1", "SINGLE", ""),
    ("3", "NATION", "SYS", "R", "4.1", "SINGLE", "NATION"),
    ("4", "BALANCE", "SYS", "N", "18.2", "SINGLE", ""),
    ("5", "SEGMENT", "USR", "A", "10.1", "SINGLE", ""),
)
SUPPLIER_SCHEMA = schema(
    ("1", "SUPPLIER.KEY", "SYS", "N", "12.1", "SINGLE", ""),
    ("3", "NATION", "SYS", "R", "4.1", "SINGLE", "NATION"),
)
NATION_SCHEMA = schema(
    ("1", "NATION.KEY", "SYS", "N", "4.1", "SINGLE", ""),
    ("2", "NATION.NAME", "SYS", "A", "25.1", "SINGLE", ""),
    ("3", "REGION", "SYS", "R", "4.1", "SINGLE", "REGION"),
)
REGION_SCHEMA = schema(
    ("1", "REGION.KEY", "SYS", "N", "4.1", "SINGLE", ""),
    ("2", "REGION.NAME", "SYS", "A", "25.1", "MULTI", ""),
)
ORDER_SCHEMA = schema(
    ("1", "ORDER.KEY", "SYS", "N", "12.1", "SINGLE", ""),
    ("2", "STATUS", "SYS", "A", "1.1", "SINGLE", ""),
    ("3", "CUSTOMER", "SYS", "R", "12.1", "SINGLE", "CUSTOMER"),
    ("4", "ORDER.DATE", "SYS", "D", "8.1", "SINGLE", ""),
    ("5", "PART", "SYS", "R", "12.1", "MULTI", "PART"),
    ("6", "AMOUNT", "SYS", "N", "18.2", "MULTI", ""),
)
LINE_SCHEMA = schema(
    ("1", "ORDER.KEY", "SYS", "N", "12.1", "SINGLE", "ORDERS"),
    ("64.1", "RETURN.FLAG", "USR", "A", "1.1", "SINGLE", ""),
    ("64.2", "SHIP.DATE", "USR", "D", "8.1", "SINGLE", ""),
    ("64.3", "LINE.PRICE", "USR", "N", "18.2", "MULTI", ""),
)
PART_SCHEMA = schema(
    ("1", "PART.KEY", "SYS", "N", "12.1", "SINGLE", ""),
    ("2", "PART.NAME", "SYS", "A", "35.1", "SINGLE", ""),
    ("64.1", "BRAND", "USR", "A", "10.1", "SINGLE", ""),
    ("64.2", "TYPE", "USR", "A", "25.1", "SINGLE", ""),
    ("64.3", "SIZE", "USR", "N", "4.1", "SINGLE", ""),
    ("64.4", "RETAIL.PRICE", "USR", "N", "18.2", "SINGLE", ""),
)
DOCUMENT_SCHEMA = schema(
    ("1", "DOCUMENT.KEY", "SYS", "N", "12.1", "SINGLE", ""),
    ("2", "LANGUAGE", "SYS", "A", "2.1", "SINGLE", ""),
    ("3", "TEXT", "SYS", "A", "0.1", "SINGLE", ""),
)
EVENT_SCHEMA = schema(
    ("1", "EVENT.KEY", "SYS", "N", "12.1", "SINGLE", ""),
    ("2", "USER", "SYS", "R", "12.1", "SINGLE", "CUSTOMER"),
    ("3", "EVENT.TYPE", "SYS", "A", "10.1", "SINGLE", ""),
    ("4", "PROPERTIES", "USR", "A", "0.1", "SINGLE", ""),
)


# --- tables as records ------------------------------------------------------- #


def as_app(rows: DataFrame, app: str, *parts: Column) -> DataFrame:
    """``app_name, source_file, rec`` with one record per row."""
    return rows.select(
        lit(app).alias("app_name"), lit(app.lower()).alias("source_file"),
        record(*parts).alias("rec"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return as_app(
        table(spark, sf, "customer"), "CUSTOMER",
        cell("1", text(col("c_custkey"))), cell("2", col("c_name")),
        cell("3", text(col("c_nationkey"))), cell("4", money(col("c_acctbal"))),
        cell("5", col("c_mktsegment")),
    )


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Positions 2 and 4 are not in the schema; position 4 has a sub-value index only."""
    return as_app(
        table(spark, sf, "supplier"), "SUPPLIER",
        cell("1", text(col("s_suppkey"))), cell("2", col("s_name"), "1"),
        cell("3", text(col("s_nationkey"))), cell("4", money(col("s_acctbal")), s="1"),
    )


def nations(spark: SparkSession, sf: str) -> DataFrame:
    return as_app(
        table(spark, sf, "nation"), "NATION",
        cell("1", text(col("n_nationkey"))), cell("2", col("n_name")),
        cell("3", text(col("n_regionkey"))),
    )


def parts(spark: SparkSession, sf: str, base: str = "64") -> DataFrame:
    return as_app(
        table(spark, sf, "part"), "PART",
        cell("1", text(col("p_partkey"))), cell("2", col("p_name")),
        cell(base, col("p_brand"), "1"), cell(base, col("p_type"), "2"),
        cell(base, text(col("p_size")), "3"), cell(base, money(col("p_retailprice")), "4"),
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One record per order line, so that no order is gathered into one row."""
    # The join deals the rows by order anyway, so neither table is spread before it.
    orders, lineitem = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("orders", "lineitem"))
    joined = orders.join(lineitem, col("o_orderkey") == col("l_orderkey"))
    line = col("l_linenumber")
    return as_app(
        joined, "ORDERS",
        cell("1", text(col("o_orderkey")), plain=True), cell("2", col("o_orderstatus")),
        cell("4", day(col("o_orderdate")), plain=True),
        cell("5", text(col("l_partkey")), line, plain=True),
        cell("6", money(col("l_quantity")), line, "1", plain=True),
        cell("6", money(col("l_extendedprice")), line, "2", plain=True),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return as_app(
        table(spark, sf, "lineitem"), "LINEITEM",
        cell("1", text(col("l_orderkey")), plain=True),
        cell("64", col("l_returnflag"), "1"), cell("64", day(col("l_shipdate")), "2", plain=True),
        cell("64", money(col("l_extendedprice")), "3", col("l_linenumber"), plain=True),
    )


def event_records(spark: SparkSession, sf: str) -> DataFrame:
    return as_app(
        table(spark, sf, "events"), "EVENTS",
        cell("1", text(col("event_id"))), cell("2", text(col("user_id"))),
        cell("3", col("event_type")), cell("4", col("props")),
    )


# --- running records through the operators ----------------------------------- #


def literal_catalog(spark: SparkSession, schemas: dict[str, str]) -> DataFrame:
    """Catalog of a few literal schema documents: its size does not depend on the data."""
    rows = F.array(*(
        F.struct(
            lit(app).alias("app_name"), lit(f"{app}.xml").alias("source"),
            lit(STANDARD_SELECTION).alias("kind"), lit(document).alias("content"),
        )
        for app, document in schemas.items()
    ))
    return catalog.catalog(metadata.documents(spark.range(1).select(F.inline(rows))))


def cells_of(rendered: DataFrame) -> DataFrame:
    return cells(records.from_table(rendered, "rec", "app_name", "source_file"))


def normalized(
    spark: SparkSession, rendered: DataFrame, schemas: dict[str, str], **options
) -> DataFrame:
    return normalize(
        cells_of(rendered), literal_catalog(spark, schemas), broadcast=True, **options
    )


def normalize_customer(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, customers(spark, sf), {"CUSTOMER": CUSTOMER_SCHEMA})


def normalize_orders_multivalue(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, order_lines(spark, sf), {"ORDERS": ORDER_SCHEMA})


def normalize_lineitem_subvalue(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, lines(spark, sf), {"LINEITEM": LINE_SCHEMA})


def normalize_part_localref(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, parts(spark, sf), {"PART": PART_SCHEMA})


def unmapped_warnings(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalized(spark, suppliers(spark, sf), {"SUPPLIER": SUPPLIER_SCHEMA})
    return analysis.with_warnings(rows)


def localref_without_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalized(
        spark, parts(spark, sf, "90"), {"PART": PART_SCHEMA}, bases=("64", "90")
    )
    return rows.filter(~col("is_mapped"))


def strict_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell is mapped, so strict mode lets all of them pass."""
    rows = normalized(
        spark, nations(spark, sf).unionByName(customers(spark, sf)),
        {"NATION": NATION_SCHEMA, "CUSTOMER": CUSTOMER_SCHEMA}, fail_on_unmapped=True,
    )
    return rows.groupBy("app_name", "field_name").agg(F.count(lit(1)).alias("cells"))


def strict_violations_by_app(spark: SparkSession, sf: str) -> DataFrame:
    """The first unmapped cell of each application, where strict mode would stop; customers have none.

    A supplier's positions 2 and 4 are not defined, nor is a part's array at position 90; files are ordered by key here.
    """
    rendered = suppliers(spark, sf).withColumn("key", F.regexp_extract("rec", "<c1>([0-9]+)<", 1).cast("bigint")).unionByName(
        parts(spark, sf, "90").withColumn("key", F.regexp_extract("rec", "<c1>([0-9]+)<", 1).cast("bigint"))
    ).unionByName(customers(spark, sf).withColumn("key", lit(0).cast("bigint")))
    rows = normalize(
        cells(records.from_table(rendered, "rec", "app_name", "source_file", "key")),
        literal_catalog(spark, {"SUPPLIER": SUPPLIER_SCHEMA, "PART": PART_SCHEMA, "CUSTOMER": CUSTOMER_SCHEMA}),
        ("64", "90"), broadcast=True, keep=("key", "ord"),
    )
    return strict_violations(rows, ("key", "ord")).drop("value")


def known_fields_only(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(
        spark, suppliers(spark, sf), {"SUPPLIER": SUPPLIER_SCHEMA}, output_unknown=False
    )


def multi_app(spark: SparkSession, sf: str) -> DataFrame:
    rendered = (
        customers(spark, sf)
        .unionByName(suppliers(spark, sf))
        .unionByName(nations(spark, sf))
    )
    return normalized(
        spark, rendered,
        {"CUSTOMER": CUSTOMER_SCHEMA, "SUPPLIER": SUPPLIER_SCHEMA, "NATION": NATION_SCHEMA},
    )


def custom_record_id(spark: SparkSession, sf: str) -> DataFrame:
    """Records keyed by another position than the first."""
    rendered = records.from_table(customers(spark, sf), "rec", "app_name", "source_file")
    key = "<c2>([^<]*)"
    found = cells(rendered, record_id=lambda body: F.upper(F.regexp_extract(body, key, 1)))
    return found.select("record_id", "xml_element", "value")


def text_escaping(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts through escaping, parsing and trimming; every third is padded."""
    pad = F.when(col("doc_id") % 3 == 0, lit(" \n\t ")).otherwise(lit(""))
    rendered = as_app(
        table(spark, sf, "documents"), "DOCUMENT",
        cell("1", text(col("doc_id"))), cell("2", col("lang")),
        cell("3", F.concat(pad, col("text"), pad)),
    )
    rows = normalized(spark, rendered, {"DOCUMENT": DOCUMENT_SCHEMA})
    return rows.select("app_name", "record_id", "field_name", "value")


def markup_in_records(spark: SparkSession, sf: str) -> DataFrame:
    """Comments, CDATA, nested elements and foreign tags around the cells."""
    body = record(
        lit("<!-- <c9>gone</c9> -->"), cell("1", text(col("c_custkey"))),
        lit("<note><c8>inner</c8></note>"),
        lit("<c2>"), lit("<![CDATA["), col("c_name"), lit(" <&>]]>"), lit("</c2>"),
        lit("<x:C3 m='a>b'>"), col("c_mktsegment"), lit("<b>bold</b>tail</x:C3>"),
        lit("<c4/>"),
    )
    rendered = table(spark, sf, "customer").select(
        lit("CUSTOMER").alias("app_name"), lit("customer").alias("source_file"), body.alias("rec")
    )
    return cells_of(rendered).select("record_id", "xml_element", "mv_index", "value")


def events_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, event_records(spark, sf), {"EVENTS": EVENT_SCHEMA})


def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same records landed as files and read by a stream until it has caught up."""
    landing = scratch_path(spark, "landing")
    write_records(event_records(spark, sf), "rec", landing)
    rows, _ = _ingested(spark, landing, "EVENTS", EVENT_SCHEMA)
    return rows.drop("source_file", ingest.BATCH)


def _ingested(spark: SparkSession, landing: str, app: str, document: str) -> tuple[DataFrame, DataFrame]:
    """Rows and dead letters of a landing directory; only completeness is checked."""
    out, letters, state = (scratch_path(spark, name) for name in ("stream", "dead-letters", "state"))
    with ingest.few_listing_tasks(spark):
        ingest.ingest(
            ingest.landed_chunks(spark, landing), app, literal_catalog(spark, {app: document}),
            PackageConfig(landing, check_contents=False), path=out, dead_letters=letters, checkpoint=state, broadcast=True,
        ).awaitTermination()
    return spark.read.parquet(out), spark.read.parquet(letters)


def truncated_records(spark: SparkSession, sf: str) -> DataFrame:
    """Files of 25 customers each: of three, one breaks off inside a record and one inside a comment."""
    number = F.floor(col("c_custkey") / FIELDS_PER_DOCUMENT).cast("bigint")
    rec = record(cell("1", text(col("c_custkey"))), cell("2", col("c_name")))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(col("c_custkey"), rec.alias("rec")))), lambda x: x["rec"])
    whole = F.array_join(ordered, "")
    cut = (
        F.when(col("number") % 3 == 1, F.substr(col("content"), lit(1), F.length("content") - 12))
        .when(col("number") % 3 == 2, F.concat("content", lit("<!-- <row></row> ")))
        .otherwise(F.concat("content", lit("<!-- end of file -->")))
    )
    landing = scratch_path(spark, "landing")
    customers = spark.read.parquet(f"{sf}/customer.parquet").withColumn("number", number)
    dealt = customers.repartition(4 * spark.sparkContext.defaultParallelism, "number")
    files = dealt.groupBy("number").agg(whole.alias("content"))
    write_files(files.select(cut.alias("value")), landing)
    rows, letters = _ingested(spark, landing, "CUSTOMER", CUSTOMER_SCHEMA)
    first = F.regexp_extract("value", "<c1>([0-9]+)<", 1).cast("bigint")
    landed = spark.read.text(landing).groupBy(records.local_path(col("_metadata.file_path")).alias("source_file")).agg(
        F.min(F.floor(first / FIELDS_PER_DOCUMENT)).cast("bigint").alias("file")
    )
    found = rows.select("source_file", "record_id", "resolved_position", "value").unionByName(letters.select(
        "source_file", lit(None).cast("string").alias("record_id"), lit("refused").alias("resolved_position"), col("reason").alias("value")
    ))
    return found.join(landed, "source_file", "left").select("file", "record_id", "resolved_position", "value")


# --- metadata rendered from tables -------------------------------------------- #


def _documents(rows: DataFrame, kind: str, opening: str, closing: str) -> DataFrame:
    """One document per ``app_name`` from ``key, part`` rows.

    Applications are cut from unique keys, so a document has at most
    ``FIELDS_PER_DOCUMENT`` parts.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("key", "part"))), lambda x: x["part"])
    grouped = rows.groupBy("app_name").agg(F.array_join(ordered, "").alias("body"))
    return grouped.select(
        "app_name", F.concat(lit(f"{kind}_"), "app_name", lit(".xml")).alias("source"),
        lit(kind).alias("kind"), F.concat(lit(opening), "body", lit(closing)).alias("content"),
    )


def _app_of(key: Column) -> Column:
    number = F.floor(key / FIELDS_PER_DOCUMENT).cast("bigint")
    return F.concat(lit("APP"), text(number))


def _tag(name: str, value: Column) -> Column:
    return F.concat(lit(f"<{name}>"), F.coalesce(escape(text(value)), lit("")), lit(f"</{name}>"))


def part_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as fields of schema documents: positions 60.n, every fifth without target."""
    key = col("p_partkey")
    target = F.when(key % 5 != 0, col("p_type"))
    part = F.concat(
        _tag("C1", col("p_name")), _tag("C2", lit("SYS")),
        _tag("C3", F.concat(lit("60."), text(key % FIELDS_PER_DOCUMENT))), _tag("C4", lit("A")),
        _tag("C8", target),
    )
    rows = table(spark, sf, "part").select(_app_of(key).alias("app_name"), key.alias("key"), part.alias("part"))
    return _documents(rows, STANDARD_SELECTION, "<ROW>", "</ROW>")


def supplier_local_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as local-reference nodes; even keys overlap the parts' positions."""
    key = col("s_suppkey")
    group = F.when(key % 2 == 0, lit("60.")).otherwise(lit("70."))
    part = F.concat(
        lit("<FIELD>"), _tag("NAME", col("s_name")),
        _tag("POSITION", F.concat(group, text(key % FIELDS_PER_DOCUMENT))),
        _tag("TYPE", lit("R")), lit("</FIELD>"),
    )
    rows = table(spark, sf, "supplier").select(_app_of(key).alias("app_name"), key.alias("key"), part.alias("part"))
    return _documents(rows, LOCAL_REF, "<LOCAL.REF>", "</LOCAL.REF>")


def nation_customizations(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as custom fields with a target of their own; odd keys have no dot."""
    key = col("n_nationkey")
    group = F.when(key % 2 == 0, lit("60.")).otherwise(lit("7"))
    part = F.concat(
        lit("<CUSTOM.FIELD>"), _tag("FIELD_NAME", col("n_name")),
        _tag("FIELD.NO", F.concat(group, text(key))),
        _tag("TARGET.APPLICATION", lit("CUSTOM.TARGET")), lit("</CUSTOM.FIELD>"),
    )
    rows = table(spark, sf, "nation").select(_app_of(key).alias("app_name"), key.alias("key"), part.alias("part"))
    return _documents(rows, CUSTOMIZATION, "<CUSTOMIZATION>", "</CUSTOMIZATION>")


def nation_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit relationships: those without a position are dropped by the loader."""
    key = col("n_nationkey")
    field = F.when(key % 2 == 0, _tag("FIELD", col("n_name"))).otherwise(lit(""))
    position = F.when(key % 3 == 0, F.concat(lit("60."), text(key)))
    part = F.concat(
        lit("<LINK>"), field, _tag("LOCATION", position),
        _tag("APPLICATION", F.concat(lit("REGION."), text(col("n_regionkey")))),
        _tag("TYPE", lit("FOREIGN_KEY")), lit("</LINK>"),
    )
    rows = table(spark, sf, "nation").select(_app_of(key).alias("app_name"), key.alias("key"), part.alias("part"))
    return _documents(rows, RELATIONSHIPS, "<RELATIONSHIPS>", "</RELATIONSHIPS>")


def table_catalog(spark: SparkSession, sf: str) -> DataFrame:
    files = (
        part_schemas(spark, sf)
        .unionByName(supplier_local_refs(spark, sf))
        .unionByName(nation_customizations(spark, sf))
        .unionByName(nation_relationships(spark, sf))
    )
    return catalog.catalog(metadata.documents(files))


def catalog_precedence(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.fields(table_catalog(spark, sf)).select(
        "app_name", "position", "field_name", "system_type", "data_type",
        "relationship_target", "is_local_ref", "is_custom_field", "source",
    )


def relationship_precedence(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.relationships(table_catalog(spark, sf))


def target_precedence(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as cells resolved against the table catalog, joined by shuffle."""
    key = col("p_partkey")
    rendered = table(spark, sf, "part").select(
        _app_of(key).alias("app_name"), lit("part").alias("source_file"),
        record(
            cell("1", text(key)),
            F.concat(lit('<c60 m="'), text(key % FIELDS_PER_DOCUMENT), lit('">'), text(col("p_size")), lit("</c60>")),
        ).alias("rec"),
    )
    rows = normalize(
        cells_of(rendered), table_catalog(spark, sf), ("60",), broadcast=False
    )
    return rows.select(
        "app_name", "record_id", "resolved_position", "field_name", "system_type", "value",
        "relationship_target", "is_custom_field", "is_mapped",
    )


def list_localref_fields(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.list_local_ref_fields(table_catalog(spark, sf), "app0").select(
        "app_name", "position", "field_name"
    )


def field_lookup(spark: SparkSession, sf: str) -> DataFrame:
    merged = table_catalog(spark, sf)
    found = catalog.resolve_field(merged, "app0", "60.4").select("position", "field_name")
    linked = catalog.resolve_relationship(merged, "app0", "60.3").select(
        "position", col("target_application").alias("field_name")
    )
    return found.unionByName(linked)


def catalog_summary(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.summary(table_catalog(spark, sf))


def metadata_synonyms(spark: SparkSession, sf: str) -> DataFrame:
    """One node document per supplier: the first listed child decides, blank or not."""
    key = col("s_suppkey")
    target = F.when(key % 2 == 0, lit("<FOREIGN.KEY> </FOREIGN.KEY>")).otherwise(lit(""))
    content = F.concat(
        lit("<LOCAL.REF><REF.FIELD>"),
        _tag("field.name", col("s_name")), _tag("NAME", lit("IGNORED")),
        _tag("LOCATION", F.concat(lit("64."), text(key))),
        _tag("DATA.TYPE", lit("  D ")), target, _tag("RELATIONSHIP", lit("NATION")),
        lit("</REF.FIELD><REF.FIELD><NAME/>"), _tag("FIELD.NAME", lit("DROPPED")),
        _tag("POS", lit("64.0")), lit("</REF.FIELD></LOCAL.REF>"),
    )
    files = table(spark, sf, "supplier").select(
        F.concat(lit("S"), text(key)).alias("app_name"), lit("s.xml").alias("source"),
        lit(LOCAL_REF).alias("kind"), content.alias("content"),
    )
    return metadata.load_fields(metadata.documents(files)).select(
        "app_name", "position", "field_name", "system_type", "data_type",
        "relationship_target", "is_local_ref", "is_custom_field",
    )


def localref_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Local-reference documents of both shapes: repeated columns for even suppliers, nodes for odd ones."""
    key = col("s_suppkey")
    columns = F.concat(
        lit("<LOCAL.REF><ROW>"), _tag("C1", col("s_name")), _tag("C2", lit("usr")), _tag("C3", text(key)), _tag("C4", lit("D")),
        _tag("C5", lit("IN2D")), _tag("C6", lit("11.1")), _tag("C7", lit("SINGLE")), _tag("C8", lit("NATION")),
        _tag("C9", lit("R")), _tag("C10", lit("MANDATORY")), _tag("C11", text(col("s_nationkey"))), lit("</ROW></LOCAL.REF>"),
    )
    nodes = F.concat(
        lit("<LOCAL.REF><LOCAL.FIELD>"), _tag("C1", col("s_name")), _tag("POS", text(key)), _tag("C4", lit("D")),
        _tag("VALIDATION", lit("IN2D")), _tag("LENGTH", lit("11.1")), _tag("MULTI.VALUE", lit("SINGLE")),
        _tag("FOREIGN.KEY", lit("NATION")), _tag("DESC", text(col("s_nationkey"))), lit("</LOCAL.FIELD></LOCAL.REF>"),
    )
    files = table(spark, sf, "supplier").select(
        F.concat(lit("S"), text(key)).alias("app_name"), lit("s.xml").alias("source"), lit(LOCAL_REF).alias("kind"),
        F.when(key % 2 == 0, columns).otherwise(nodes).alias("content"),
    )
    docs = metadata.documents(files)
    linked = metadata.load_relationships(docs).select("app_name", "target_application", "relationship_type")
    return metadata.load_fields(docs).drop("source_rank", "ordinal", "source").join(linked, "app_name", "left")


def has_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Which applications of the orders have fields in the table catalog."""
    apps = table(spark, sf, "orders").select(_app_of(col("o_custkey")).alias("app_name")).distinct()
    return catalog.metadata_presence(apps, table_catalog(spark, sf))


def positional_zip_ragged(spark: SparkSession, sf: str) -> DataFrame:
    """One schema document per part with columns of different lengths."""
    key = col("p_partkey")
    content = F.concat(
        lit("<DATA><ROW>"),
        _tag("C1", F.when(key % 4 != 0, col("p_name"))), _tag("C1", col("p_brand")), _tag("c1", col("p_type")),
        _tag("C3", lit("1")), _tag("C3", text(col("p_size"))),
        _tag("C8", lit("FIRST.ONLY")), _tag("C2", lit("local")), _tag("C2", lit(" ")),
        lit("</ROW><ROW><C1>LATER</C1><C3>9</C3></ROW></DATA>"),
    )
    files = table(spark, sf, "part").select(
        F.concat(lit("P"), text(key)).alias("app_name"), lit("p.xml").alias("source"),
        lit(STANDARD_SELECTION).alias("kind"), content.alias("content"),
    )
    return metadata.load_fields(metadata.documents(files)).select(
        "app_name", "position", "field_name", "system_type", "relationship_target",
        "is_custom_field", "ordinal",
    )


# --- packages ------------------------------------------------------------------ #


def listing_of_parts(spark: SparkSession, sf: str) -> DataFrame:
    """A listing with one data file per part and metadata files of several names."""
    key = text(col("p_partkey"))
    number = col("p_partkey")

    def entry(kind: str, name: Column, when: Column) -> Column:
        return F.when(when, F.struct(lit(kind).alias("kind"), name.alias("name")))

    app = F.concat(lit("P"), key)
    entries = F.array_compact(F.array(
        entry(package.DATA, F.concat(F.when(number % 10 == 0, F.lower(app)).otherwise(app), lit(".xml")), lit(True)),
        entry(STANDARD_SELECTION, F.concat(lit("STANDARD_SELECTION_"), app, lit(".xml")), number % 3 == 0),
        entry(STANDARD_SELECTION, F.concat(app, lit("_STANDARD_SELECTION.xml")), number % 2 == 0),
        entry(STANDARD_SELECTION, F.concat(app, lit(".xml")), number % 5 == 0),
        entry(RELATIONSHIPS, F.concat(app, lit(".xml")), number % 7 == 0),
        entry(LOCAL_REF, F.concat(lit("LOCAL_REF_"), app, lit(".xml")), number % 4 == 0),
        entry(LOCAL_REF, F.concat(app, lit(".xml")), number % 6 == 0),
        entry(CUSTOMIZATION, F.concat(app, lit("_CUSTOMIZATION.xml")), number % 11 == 0),
        entry(CUSTOMIZATION, F.concat(app, lit(".xml")), number % 9 == 0),
    ))
    rows = table(spark, sf, "part").select(F.explode(entries).alias("e"))
    return rows.select(
        "e.kind", F.concat(lit("/pkg/"), "e.kind", lit("/"), "e.name").alias("source"),
        "e.name", lit(1).cast("bigint").alias("length"),
    )


def app_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return package.data_files(listing_of_parts(spark, sf)).select("app_name", "source")


def skipped_apps(spark: SparkSession, sf: str) -> DataFrame:
    return package.skipped_applications(listing_of_parts(spark, sf))


def metadata_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return package.metadata_files(listing_of_parts(spark, sf)).select("app_name", "kind", "source")


def missing_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return package.missing_metadata(listing_of_parts(spark, sf), STANDARD_SELECTION)


def _customer_documents(spark: SparkSession, sf: str, split_start: Column) -> DataFrame:
    """Each customer as a small file, checked; some with a bare ampersand or a missing end."""
    key = col("c_custkey")
    body = F.concat(
        lit("<DATA><row><c1>"), text(key), lit("</c1><c2>"), col("c_name"),
        F.when(key % 10 == 0, lit(" & ")).otherwise(lit(" &amp; ")),
        lit("</c2></row><row/>"), F.when(key % 10 == 3, lit("")).otherwise(lit("</DATA>")),
    )
    files = table(spark, sf, "customer").select(
        F.concat(lit("C"), text(key), lit(".xml")).alias("source_file"),
        F.octet_length(body).cast("bigint").alias("file_size"), F.split(body, "</row>").alias("chunks"),
    )
    chunked = files.select("source_file", "file_size", F.posexplode("chunks").alias("chunk_no", "chunk")).select(
        "source_file", split_start.cast("bigint").alias("split_start"), "file_size",
        col("chunk_no").cast("bigint").alias("chunk_no"), "chunk",
    )
    checked = validate.check_table(chunked, records.DEFAULT_END)
    return checked.select("source_file", "records", col("error").isNull().alias("well_formed"))


def well_formedness(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_documents(spark, sf, lit(0))


def well_formed_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The same files in two splits each; records of those that do not parse are not compared."""
    checked = _customer_documents(spark, sf, F.when(col("chunk_no") == 0, 0).otherwise(100))
    return checked.withColumn("records", F.when(col("well_formed"), col("records")))


def _write_files(rows: DataFrame, value: Column, path: str) -> None:
    """One file for each row, below one entry of a package."""
    rows.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def package_findings(spark: SparkSession, sf: str) -> DataFrame:
    """What validation finds in packages that lack something or hold documents that do not parse.

    Findings are counted by check and entry, beside the verdict.  In the last package each nation is a data
    file, of which every fourth has a bare ampersand, and a schema document, of which every third has no end.
    """
    base = scratch_path(spark, "findings")
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    key = col("n_nationkey")
    ampersand = F.when(key % 4 == 1, lit(" & ")).otherwise(lit(" "))
    plain = record(cell("1", text(col("c_custkey"))), cell("2", col("c_name")))
    doubtful = record(cell("1", text(key)), lit("<c2>"), col("n_name"), ampersand, lit("</c2>"))
    end = F.when(key % 3 == 0, lit("")).otherwise(lit("</ROW>"))
    schemas = F.concat(lit("<ROW><C1>"), col("n_name"), lit("</C1><C3>1</C3>"), end)
    write_records(customer.select(plain.alias("rec")), "rec", f"{base}/unnamed/data/CUSTOMER.txt")
    write_records(nation.select(schemas.alias("rec")), "rec", f"{base}/dataless/relationships/RELATIONSHIPS_NATION.xml")
    write_records(customer.select(plain.alias("rec")), "rec", f"{base}/sound/data/CUSTOMER.xml")
    write_document(spark, CUSTOMER_SCHEMA, f"{base}/sound/metadata/STANDARD_SELECTION_CUSTOMER.xml")
    _write_files(nation, doubtful, f"{base}/broken/data/NATION.xml")
    _write_files(nation, schemas, f"{base}/broken/metadata/STANDARD_SELECTION_NATION.xml")
    found = []
    for name in ("absent", "unnamed", "dataless", "sound", "broken"):
        root = f"{base}/{name}"
        findings = Normalization(spark, PackageConfig(root, require_xsd=name == "unnamed")).validate()
        result = validate.verdict(findings)
        entry = F.regexp_replace(F.substring_index("path", f"/{name}", -1), r"^/([^/]+(?:/[^/]+)?).*$", "$1")
        found.append(findings.groupBy("severity", "check", entry.alias("entry")).agg(F.count("*").alias("n")).select(
            lit(name).alias("package"), "severity", "check", "entry", "n",
            lit(result.is_valid).alias("is_valid"), lit(result.n_errors).cast("bigint").alias("n_errors"),
        ))
    return reduce(DataFrame.unionByName, found)


def write_package(spark: SparkSession, sf: str) -> str:
    """Customers, suppliers and nations as a package in the shared folder."""
    root = scratch_path(spark, "package")
    for app, rendered, document in (
        ("CUSTOMER", customers(spark, sf), CUSTOMER_SCHEMA),
        ("SUPPLIER", suppliers(spark, sf), SUPPLIER_SCHEMA),
        ("NATION", nations(spark, sf), NATION_SCHEMA),
    ):
        write_records(rendered, "rec", f"{root}/data/{app}.xml")
        write_document(spark, document, f"{root}/metadata/STANDARD_SELECTION_{app}.xml")
    return root


def package_run(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run over files: validate, discover, load metadata, read, normalize."""
    run = Normalization(spark, PackageConfig(write_package(spark, sf)))
    return run.run().drop("source_file")


#: Bytes of a split where a query shows that splits do not matter: most files here are smaller than a default one.
SMALL_SPLIT = 4096
#: Tasks for all these splits: one task a split would cost more than its work.
TASKS_PER_CORE = 4


def small_splits(spark: SparkSession) -> SparkSession:
    """A session of its own that cuts files into many splits, of which a task reads as many as its share."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", SMALL_SPLIT)
    session.conf.set("spark.sql.files.maxPartitionNum", TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return session


def _declared(rec: Column, encoding: str) -> Column:
    """Records as bytes in an encoding; the first of each part file has the declaration before it."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    head = F.when(place == 0, lit(f'<?xml version="1.0" encoding="{encoding}"?>')).otherwise(lit(""))
    # The euro sign is byte 0x80 in windows-1252, where Latin-1 has a control character.
    moved = F.translate(F.concat(head, rec), "\u20ac", "\x80")
    return (F.concat(head, rec) if encoding == "UTF-8" else F.encode(moved, "ISO-8859-1")).cast("string")


def package_encodings(spark: SparkSession, sf: str) -> DataFrame:
    """Three encodings, letters beyond ASCII and end tags inside markup, in part files of many splits."""
    root = scratch_path(spark, "encodings")
    comment = lit("<!-- <row></row> --><?skip </row>?>")
    customer = as_app(
        table(spark, sf, "customer"), "CUSTOMER", cell("1", text(col("c_custkey"))), comment,
        cell("2", F.concat("c_name", lit(" \u00e9\u00ff"))),
    )
    supplier = as_app(
        table(spark, sf, "supplier"), "SUPPLIER", cell("1", text(col("s_suppkey"))), comment,
        cell("3", F.concat("s_name", lit(" \u20ac\u00e9"))),
    )
    part = as_app(
        table(spark, sf, "part"), "PART", cell("1", text(col("p_partkey"))),
        lit("<c2><![CDATA[</row>"), col("p_name"), lit(" \u0416</row>]]></c2>"),
    )
    for app, rendered, encoding, document in (
        ("CUSTOMER", customer, "ISO-8859-1", CUSTOMER_SCHEMA), ("SUPPLIER", supplier, "windows-1252", SUPPLIER_SCHEMA),
        ("PART", part, "UTF-8", PART_SCHEMA),
    ):
        write_records(rendered.select(_declared(col("rec"), encoding).alias("rec")), "rec", f"{root}/data/{app}.xml")
        write_document(spark, document, f"{root}/metadata/STANDARD_SELECTION_{app}.xml")
    run = Normalization(small_splits(spark), PackageConfig(root))
    return run.run().select("app_name", "record_id", "resolved_position", "field_name", "value", "is_mapped")


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    run = Normalization(spark, PackageConfig(write_package(spark, sf)))
    rows = run.run()
    name = package.entry_name(col("source_file"), run.config.data_path)
    counts = run.checked.select(F.regexp_replace(name, r"\.xml$", "").alias("app_name"), "records")
    return analysis.run_metrics(counts, rows)


def record_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records per file kind, with an empty and a self-closing record after every order."""
    root = scratch_path(spark, "counts")
    orders = as_app(
        table(spark, sf, "orders"), "ORDERS",
        cell("1", text(col("o_orderkey"))), cell("2", col("o_orderstatus")),
    ).withColumn("rec", F.concat("rec", lit("<row></row><ROW/>")))
    write_records(orders, "rec", f"{root}/ORDERS.xml")
    write_records(customers(spark, sf), "rec", f"{root}/CUSTOMER.xml")
    counted = records.count_records(spark, [f"{root}/ORDERS.xml", f"{root}/CUSTOMER.xml"])
    app = F.regexp_extract("source_file", r"([A-Z]+)\.xml/", 1)
    return counted.groupBy(app.alias("app_name")).agg(F.sum("records").alias("records"))


def local_ref_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Applications of the table catalog without dotted fields or without a document."""
    apps = table(spark, sf, "orders").select(_app_of(col("o_custkey")).alias("app_name")).distinct()
    with_file = supplier_local_refs(spark, sf).select("app_name")
    found = validate.local_ref_coverage(
        apps, catalog_summary(spark, sf), apps.join(with_file, "app_name", "left_anti")
    )
    return found.select("severity", "check", "path")


def undeclared_localrefs(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalized(spark, parts(spark, sf, "90"), {"PART": PART_SCHEMA}, bases=("64", "90"))
    return validate.undeclared_local_refs(rows).select("severity", "check", "path", "message")


# --- consumer queries ---------------------------------------------------------- #


def customers_and_parts(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(
        spark, customers(spark, sf).unionByName(parts(spark, sf)),
        {"CUSTOMER": CUSTOMER_SCHEMA, "PART": PART_SCHEMA},
    )


def filter_record(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.one_record(customers_and_parts(spark, sf), "7")


def mapped_only(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.mapped_only(multi_app(spark, sf))


def localref_only(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.local_refs_only(customers_and_parts(spark, sf))


def profile(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.profile(multi_app(spark, sf))


def pivot_wide(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalized(
        spark, customers(spark, sf), {"CUSTOMER": CUSTOMER_SCHEMA}, keep=("record_no", "ord")
    )
    names = ["CUSTOMER.KEY", "CUSTOMER.NAME", "NATION", "BALANCE", "SEGMENT"]
    pivoted = analysis.wide(rows, ("record_no", "ord"), names)
    return pivoted.toDF("app_name", "record_id", *(n.lower().replace(".", "_") for n in names))


def preview(spark: SparkSession, sf: str) -> DataFrame:
    """A preview of one record, which is shorter than the preview."""
    return analysis.preview(filter_record(spark, sf))


def bounded_table(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows a bounded table shows and how many it leaves out."""
    shown, more = analysis.bounded_table(normalize_customer(spark, sf))
    return shown.agg(F.count(lit(1)).alias("shown")).withColumn("more", lit(more).cast("bigint"))


def flat_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Regions with an empty value and an empty index; nulls and empties stay apart."""
    rendered = as_app(
        table(spark, sf, "region"), "REGION",
        cell("1", text(col("r_regionkey"))), cell("2", col("r_name"), ""), lit("<c9/>"),
    )
    return sinks.rows(normalized(spark, rendered, {"REGION": REGION_SCHEMA}))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    sinks.write_csv(multi_app(spark, sf), path)
    fields = ", ".join(f"{c} STRING" for c in sinks.OUTPUT_COLUMNS)
    return spark.read.csv(path, schema=fields, header=True, escape='"')


def jsonl_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    rows = multi_app(spark, sf)
    sinks.write_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalize_customer, normalize_orders_multivalue, normalize_lineitem_subvalue,
        normalize_part_localref, unmapped_warnings, localref_without_metadata, strict_mode, strict_violations_by_app, localref_shapes, has_metadata,
        known_fields_only, custom_record_id, text_escaping, markup_in_records,
        events_incremental, events_stream, truncated_records, catalog_precedence, relationship_precedence,
        target_precedence, list_localref_fields, field_lookup, catalog_summary,
        metadata_synonyms, positional_zip_ragged, app_discovery, skipped_apps,
        metadata_resolution, missing_metadata, well_formedness, well_formed_splits, package_findings, package_run, package_encodings, run_metrics,
        record_counts, local_ref_coverage, undeclared_localrefs, filter_record, mapped_only,
        localref_only, profile, pivot_wide, preview, bounded_table, flat_roundtrip,
        csv_roundtrip, jsonl_roundtrip,
    )
}
QUERIES["multi_app_union"] = multi_app
