"""Plain SQL over the same tables that gives the expected result of each query.

The SQL never touches XML: it states which output row every column value of a
table must become.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Out:
    """One expected output row per table row; SQL expressions unless noted.

    ``meta`` is (name, system, type, format, cardinality), None when unmapped.
    """

    position: str
    value: str
    meta: tuple[str, str, str, str, str] | None
    m: str | None = None
    s: str | None = None
    resolved: str | None = None
    target: str | None = None
    local: bool = False
    custom: bool = False
    warnings: str | None = None


def _quoted(text: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if text is None else f"'{text}'"


def _index(expression: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if expression is None else f"CAST({expression} AS VARCHAR)"


def expected(app: str, source: str, record_id: str, rows: list[Out]) -> str:
    """The 19 output columns of an application whose records are the rows of ``source``."""
    selects = []
    for row in rows:
        name, system, kind, form, cardinality = row.meta or (None,) * 5
        resolved = f"'{row.resolved or row.position}'"
        shown = f"'{name}'" if name else f"'FIELD_' || {resolved}"
        warnings = row.warnings or (None if row.meta else "UNMAPPED_FIELD")
        selects.append(
            f"SELECT '{app}' AS app_name, {record_id} AS record_id, "
            f"'{app.lower()}' AS source_file, 'c{row.position}' AS xml_element, "
            f"'{row.position}' AS raw_position, {resolved} AS resolved_position, "
            f"{shown} AS field_name, {_quoted(system)} AS system_type, "
            f"{_quoted(kind)} AS data_type, {_quoted(form)} AS format_rule, "
            f"{_quoted(cardinality)} AS cardinality, {_index(row.m)} AS mv_index, "
            f"{_index(row.s)} AS sv_index, {row.value} AS value, "
            f"{_quoted(row.target)} AS relationship_target, {row.local} AS is_local_ref, "
            f"{row.custom} AS is_custom_field, {row.meta is not None} AS is_mapped, "
            f"{_quoted(warnings)} AS warnings FROM {source}"
        )
    return " UNION ALL ".join(selects)


def text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"


def day(column: str) -> str:
    return f"strftime({column}, '%Y%m%d')"


CUSTOMER_ROWS = [
    Out("1", text("c_custkey"), ("CUSTOMER.KEY", "SYS", "N", "12.1", "SINGLE")),
    Out("2", "c_name", ("CUSTOMER.NAME", "SYS", "A", "35.1", "SINGLE")),
    Out("3", text("c_nationkey"), ("NATION", "SYS", "R", "4.1", "SINGLE"), target="NATION"),
    Out("4", money("c_acctbal"), ("BALANCE", "SYS", "N", "18.2", "SINGLE")),
    Out("5", "c_mktsegment", ("SEGMENT", "USR", "A", "10.1", "SINGLE"), custom=True),
]
CUSTOMER = expected("CUSTOMER", "customer", text("c_custkey"), CUSTOMER_ROWS)

SUPPLIER_ROWS = [
    Out("1", text("s_suppkey"), ("SUPPLIER.KEY", "SYS", "N", "12.1", "SINGLE")),
    Out("2", "s_name", None, m="1"),
    Out("3", text("s_nationkey"), ("NATION", "SYS", "R", "4.1", "SINGLE"), target="NATION"),
    Out("4", money("s_acctbal"), None, s="1",
        warnings="UNMAPPED_FIELD,SUB_VALUE_WITHOUT_MULTI_VALUE"),
]
SUPPLIER = expected("SUPPLIER", "supplier", text("s_suppkey"), SUPPLIER_ROWS)

NATION = expected(
    "NATION", "nation", text("n_nationkey"),
    [
        Out("1", text("n_nationkey"), ("NATION.KEY", "SYS", "N", "4.1", "SINGLE")),
        Out("2", "n_name", ("NATION.NAME", "SYS", "A", "25.1", "SINGLE")),
        Out("3", text("n_regionkey"), ("REGION", "SYS", "R", "4.1", "SINGLE"), target="REGION"),
    ],
)

_PART_CELLS = [
    ("p_brand", ("BRAND", "USR", "A", "10.1", "SINGLE")),
    ("p_type", ("TYPE", "USR", "A", "25.1", "SINGLE")),
    (text("p_size"), ("SIZE", "USR", "N", "4.1", "SINGLE")),
    (money("p_retailprice"), ("RETAIL.PRICE", "USR", "N", "18.2", "SINGLE")),
]
PART = expected(
    "PART", "part", text("p_partkey"),
    [
        Out("1", text("p_partkey"), ("PART.KEY", "SYS", "N", "12.1", "SINGLE")),
        Out("2", "p_name", ("PART.NAME", "SYS", "A", "35.1", "SINGLE")),
        *(
            Out("64", value, meta, m=f"'{i}'", resolved=f"64.{i}", local=True, custom=True)
            for i, (value, meta) in enumerate(_PART_CELLS, 1)
        ),
    ],
)
PART_BASE_90 = expected(
    "PART", "part", text("p_partkey"),
    [
        Out("90", value, None, m=f"'{i}'", resolved=f"90.{i}", local=True,
            warnings="UNMAPPED_FIELD,LOCAL_REF_WITHOUT_METADATA")
        for i, (value, _) in enumerate(_PART_CELLS, 1)
    ],
)

ORDERS = expected(
    "ORDERS", "orders JOIN lineitem ON o_orderkey = l_orderkey", text("o_orderkey"),
    [
        Out("1", text("o_orderkey"), ("ORDER.KEY", "SYS", "N", "12.1", "SINGLE")),
        Out("2", "o_orderstatus", ("STATUS", "SYS", "A", "1.1", "SINGLE")),
        Out("4", day("o_orderdate"), ("ORDER.DATE", "SYS", "D", "8.1", "SINGLE")),
        Out("5", text("l_partkey"), ("PART", "SYS", "R", "12.1", "MULTI"),
            m="l_linenumber", target="PART"),
        Out("6", money("l_quantity"), ("AMOUNT", "SYS", "N", "18.2", "MULTI"),
            m="l_linenumber", s="1"),
        Out("6", money("l_extendedprice"), ("AMOUNT", "SYS", "N", "18.2", "MULTI"),
            m="l_linenumber", s="2"),
    ],
)
LINEITEM = expected(
    "LINEITEM", "lineitem", text("l_orderkey"),
    [
        Out("1", text("l_orderkey"), ("ORDER.KEY", "SYS", "N", "12.1", "SINGLE"), target="ORDERS"),
        Out("64", "l_returnflag", ("RETURN.FLAG", "USR", "A", "1.1", "SINGLE"), m="1",
            resolved="64.1", local=True, custom=True),
        Out("64", day("l_shipdate"), ("SHIP.DATE", "USR", "D", "8.1", "SINGLE"), m="2",
            resolved="64.2", local=True, custom=True),
        Out("64", money("l_extendedprice"), ("LINE.PRICE", "USR", "N", "18.2", "MULTI"), m="3",
            s="l_linenumber", resolved="64.3", local=True, custom=True),
    ],
)
EVENTS = expected(
    "EVENTS", "events", text("event_id"),
    [
        Out("1", text("event_id"), ("EVENT.KEY", "SYS", "N", "12.1", "SINGLE")),
        Out("2", text("user_id"), ("USER", "SYS", "R", "12.1", "SINGLE"), target="CUSTOMER"),
        Out("3", "event_type", ("EVENT.TYPE", "SYS", "A", "10.1", "SINGLE")),
        Out("4", "props", ("PROPERTIES", "USR", "A", "0.1", "SINGLE"), custom=True),
    ],
)
REGION = expected(
    "REGION", "region", text("r_regionkey"),
    [
        Out("1", text("r_regionkey"), ("REGION.KEY", "SYS", "N", "4.1", "SINGLE")),
        Out("2", "r_name", ("REGION.NAME", "SYS", "A", "25.1", "MULTI"), m="''"),
        Out("9", "''", None),
    ],
)

MULTI_APP = f"{CUSTOMER} UNION ALL {SUPPLIER} UNION ALL {NATION}"
CUSTOMER_AND_PART = f"{CUSTOMER} UNION ALL {PART}"
PREVIEW = (
    "app_name, record_id, xml_element, resolved_position, field_name, mv_index, sv_index, "
    "value, is_mapped"
)

# Field definitions of the documents that are rendered from tables.
_APP = "'APP' || CAST({key} // 25 AS VARCHAR)"
FIELD_DEFINITIONS = f"""
SELECT {_APP.format(key='p_partkey')} AS app_name, '60.' || (p_partkey % 25) AS position,
       p_name AS field_name, 'SYS' AS system_type, 'A' AS data_type,
       CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS relationship_target,
       true AS is_local_ref, false AS is_custom_field, 1 AS source_rank,
       'STANDARD_SELECTION' AS kind FROM part
UNION ALL
SELECT {_APP.format(key='s_suppkey')},
       CASE WHEN s_suppkey % 2 = 0 THEN '60.' ELSE '70.' END || (s_suppkey % 25),
       s_name, 'USR', 'R', NULL, true, true, 2, 'LOCAL_REF' FROM supplier
UNION ALL
SELECT {_APP.format(key='n_nationkey')},
       CASE WHEN n_nationkey % 2 = 0 THEN '60.' ELSE '7' END || n_nationkey,
       n_name, 'CUSTOM', NULL, 'CUSTOM.TARGET', n_nationkey % 2 = 0, true, 3, 'CUSTOMIZATION'
FROM nation
"""
FIELDS = f"""
SELECT app_name, position, field_name, system_type, data_type, relationship_target,
       is_local_ref, is_custom_field, kind || '_' || app_name || '.xml' AS source
FROM (SELECT *, row_number() OVER (PARTITION BY app_name, position ORDER BY source_rank DESC) AS n
      FROM ({FIELD_DEFINITIONS})) WHERE n = 1
"""
RELATIONSHIP_DEFINITIONS = f"""
SELECT app_name, field_name, position, relationship_target AS target_application,
       'STANDARD_SELECTION_C8' AS relationship_type,
       'STANDARD_SELECTION_' || app_name || '.xml' AS source, 1 AS source_rank
FROM ({FIELD_DEFINITIONS}) WHERE kind = 'STANDARD_SELECTION' AND relationship_target IS NOT NULL
UNION ALL
SELECT {_APP.format(key='n_nationkey')},
       CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'FIELD_60.' || n_nationkey END,
       '60.' || n_nationkey, 'REGION.' || n_regionkey, 'FOREIGN_KEY',
       'RELATIONSHIPS_' || {_APP.format(key='n_nationkey')} || '.xml', 4
FROM nation WHERE n_nationkey % 3 = 0
"""
LINKS = f"""
SELECT app_name, field_name, position, target_application, relationship_type, source
FROM (SELECT *, row_number() OVER (PARTITION BY app_name, position ORDER BY source_rank DESC) AS n
      FROM ({RELATIONSHIP_DEFINITIONS})) WHERE n = 1
"""
_PART_CELLS_IN_CATALOG = f"""
SELECT {_APP.format(key='p_partkey')} AS app_name, CAST(p_partkey AS VARCHAR) AS record_id,
       '1' AS resolved_position, CAST(p_partkey AS VARCHAR) AS value FROM part
UNION ALL
SELECT {_APP.format(key='p_partkey')}, CAST(p_partkey AS VARCHAR), '60.' || (p_partkey % 25),
       CAST(p_size AS VARCHAR) FROM part
"""

_PART_APP = "'P' || p_partkey"
_RESOLUTION = " UNION ALL ".join(
    f"SELECT {_PART_APP} AS app_name, '{kind}' AS kind, {rank} AS rank, "
    f"'/pkg/{kind}/' || {name} AS source FROM part WHERE p_partkey % {divisor} = 0"
    for kind, rank, name, divisor in (
        ("STANDARD_SELECTION", 1, f"'STANDARD_SELECTION_' || {_PART_APP} || '.xml'", 3),
        ("STANDARD_SELECTION", 2, f"{_PART_APP} || '_STANDARD_SELECTION.xml'", 2),
        ("STANDARD_SELECTION", 3, f"{_PART_APP} || '.xml'", 5),
        ("RELATIONSHIPS", 3, f"{_PART_APP} || '.xml'", 7),
        ("LOCAL_REF", 1, f"'LOCAL_REF_' || {_PART_APP} || '.xml'", 4),
        ("LOCAL_REF", 3, f"{_PART_APP} || '.xml'", 6),
        ("CUSTOMIZATION", 2, f"{_PART_APP} || '_CUSTOMIZATION.xml'", 11),
        ("CUSTOMIZATION", 3, f"{_PART_APP} || '.xml'", 9),
    )
)


def _without_source(sql: str) -> str:
    return f"SELECT * EXCLUDE (source_file) FROM ({sql})"


ORACLES: dict[str, str] = {
    "normalize_customer": CUSTOMER,
    "normalize_orders_multivalue": ORDERS,
    "normalize_lineitem_subvalue": LINEITEM,
    "normalize_part_localref": PART,
    "unmapped_warnings": f"SELECT * FROM ({SUPPLIER}) WHERE warnings IS NOT NULL",
    "localref_without_metadata": PART_BASE_90,
    "strict_mode": (
        f"SELECT app_name, field_name, count(*) AS cells FROM ({NATION} UNION ALL {CUSTOMER}) "
        "GROUP BY app_name, field_name"
    ),
    "known_fields_only": f"SELECT * FROM ({SUPPLIER}) WHERE is_mapped",
    "multi_app_union": MULTI_APP,
    "custom_record_id": (
        f"SELECT upper(c_name) AS record_id, xml_element, value FROM ({CUSTOMER}) "
        "JOIN customer ON record_id = CAST(c_custkey AS VARCHAR)"
    ),
    "text_escaping": " UNION ALL ".join(
        "SELECT 'DOCUMENT' AS app_name, CAST(doc_id AS VARCHAR) AS record_id, "
        f"'{name}' AS field_name, {value} AS value FROM documents"
        for name, value in (
            ("DOCUMENT.KEY", "CAST(doc_id AS VARCHAR)"), ("LANGUAGE", "lang"), ("TEXT", "text"),
        )
    ),
    "markup_in_records": " UNION ALL ".join(
        f"SELECT CAST(c_custkey AS VARCHAR) AS record_id, '{element}' AS xml_element, "
        f"{m} AS mv_index, {value} AS value FROM customer"
        for element, m, value in (
            ("c1", "CAST(NULL AS VARCHAR)", "CAST(c_custkey AS VARCHAR)"),
            ("c2", "CAST(NULL AS VARCHAR)", "c_name || ' <&>'"),
            ("c3", "'a>b'", "c_mktsegment"),
            ("c4", "CAST(NULL AS VARCHAR)", "''"),
        )
    ),
    "events_incremental": EVENTS,
    "events_stream": _without_source(EVENTS),
    "truncated_records": """
        WITH files AS (SELECT CAST(floor(c_custkey / 25) AS BIGINT) AS file, * FROM customer)
        SELECT file, CAST(c_custkey AS VARCHAR) AS record_id, p AS resolved_position,
               CASE p WHEN '1' THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS value
        FROM files, (VALUES ('1'), ('2')) AS positions(p) WHERE file % 3 = 0
        UNION ALL
        SELECT DISTINCT file, CAST(NULL AS VARCHAR), 'refused', CASE file % 3 WHEN 1 THEN 'the last record has no end'
               ELSE 'a comment, CDATA section or instruction has no end' END
        FROM files WHERE file % 3 <> 0
    """,
    "catalog_precedence": FIELDS,
    "relationship_precedence": LINKS,
    "target_precedence": f"""
        SELECT c.app_name, c.record_id, c.resolved_position,
               coalesce(f.field_name, 'FIELD_' || c.resolved_position) AS field_name,
               f.system_type, c.value,
               coalesce(r.target_application, f.relationship_target) AS relationship_target,
               coalesce(f.is_custom_field, false) AS is_custom_field,
               f.field_name IS NOT NULL AS is_mapped
        FROM ({_PART_CELLS_IN_CATALOG}) c
        LEFT JOIN ({FIELDS}) f ON f.app_name = c.app_name AND f.position = c.resolved_position
        LEFT JOIN ({LINKS}) r ON r.app_name = c.app_name AND r.position = c.resolved_position
    """,
    "list_localref_fields": (
        f"SELECT app_name, position, field_name FROM ({FIELDS}) "
        "WHERE app_name = 'APP0' AND position LIKE '%.%'"
    ),
    "field_lookup": (
        f"SELECT position, field_name FROM ({FIELDS}) "
        "WHERE app_name = 'APP0' AND position = '60.4' UNION ALL "
        f"SELECT position, target_application FROM ({LINKS}) "
        "WHERE app_name = 'APP0' AND position = '60.3'"
    ),
    "catalog_summary": (
        "SELECT app_name, count(*) AS n_fields, "
        "count(*) FILTER (WHERE position LIKE '%.%') AS n_local_ref_fields "
        f"FROM ({FIELDS}) GROUP BY app_name"
    ),
    "metadata_synonyms": """
        SELECT 'S' || s_suppkey AS app_name, '64.' || s_suppkey AS position,
               s_name AS field_name, 'USR' AS system_type, 'D' AS data_type,
               CASE WHEN s_suppkey % 2 = 1 THEN 'NATION' END AS relationship_target,
               true AS is_local_ref, true AS is_custom_field
        FROM supplier
    """,
    "positional_zip_ragged": """
        SELECT 'P' || p_partkey AS app_name, '1' AS position, p_name AS field_name,
               'local' AS system_type, 'FIRST.ONLY' AS relationship_target,
               true AS is_custom_field, 0 AS ordinal
        FROM part WHERE p_partkey % 4 <> 0
        UNION ALL
        SELECT 'P' || p_partkey, CAST(p_size AS VARCHAR), p_brand, NULL, NULL, false, 1 FROM part
    """,
    "app_discovery": (
        f"SELECT {_PART_APP} AS app_name, CASE WHEN p_partkey % 10 <> 0 "
        f"THEN '/pkg/DATA/' || {_PART_APP} || '.xml' END AS source FROM part"
    ),
    "skipped_apps": f"SELECT {_PART_APP} AS app_name FROM part WHERE p_partkey % 10 = 0",
    "metadata_resolution": (
        f"SELECT app_name, kind, arg_min(source, rank) AS source FROM ({_RESOLUTION}) "
        "GROUP BY app_name, kind"
    ),
    "missing_metadata": (
        f"SELECT {_PART_APP} AS app_name FROM part "
        "WHERE p_partkey % 2 <> 0 AND p_partkey % 3 <> 0 AND p_partkey % 5 <> 0"
    ),
    "well_formedness": """
        SELECT 'C' || c_custkey || '.xml' AS source_file,
               CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 2 END AS records,
               c_custkey % 10 NOT IN (0, 3) AS well_formed
        FROM customer
    """,
    "well_formed_splits": """
        SELECT 'C' || c_custkey || '.xml' AS source_file, CASE WHEN c_custkey % 10 NOT IN (0, 3) THEN 2 END AS records,
               c_custkey % 10 NOT IN (0, 3) AS well_formed
        FROM customer
    """,
    "package_run": _without_source(MULTI_APP),
    "package_encodings": """
        SELECT 'CUSTOMER' AS app_name, CAST(c_custkey AS VARCHAR) AS record_id, p AS resolved_position,
               CASE p WHEN '1' THEN 'CUSTOMER.KEY' ELSE 'CUSTOMER.NAME' END AS field_name,
               CASE p WHEN '1' THEN CAST(c_custkey AS VARCHAR) ELSE c_name || ' \u00e9\u00ff' END AS value, TRUE AS is_mapped
        FROM customer, (VALUES ('1'), ('2')) AS positions(p)
        UNION ALL
        SELECT 'SUPPLIER', CAST(s_suppkey AS VARCHAR), p, CASE p WHEN '1' THEN 'SUPPLIER.KEY' ELSE 'NATION' END,
               CASE p WHEN '1' THEN CAST(s_suppkey AS VARCHAR) ELSE s_name || ' \u20ac\u00e9' END, TRUE
        FROM supplier, (VALUES ('1'), ('3')) AS positions(p)
        UNION ALL
        SELECT 'PART', CAST(p_partkey AS VARCHAR), p, CASE p WHEN '1' THEN 'PART.KEY' ELSE 'PART.NAME' END,
               CASE p WHEN '1' THEN CAST(p_partkey AS VARCHAR) ELSE '</row>' || p_name || ' \u0416</row>' END, TRUE
        FROM part, (VALUES ('1'), ('2')) AS positions(p)
    """,
    "strict_violations_by_app": f"""
        SELECT app_name, source_file, record_id, xml_element, resolved_position, n_unmapped FROM (
            SELECT app_name, source_file, record_id, xml_element, resolved_position,
                   count(*) OVER (PARTITION BY app_name) AS n_unmapped,
                   row_number() OVER (PARTITION BY app_name ORDER BY CAST(record_id AS BIGINT), CAST(raw_position AS INT), mv_index) AS n
            FROM (SELECT * FROM ({SUPPLIER}) UNION ALL SELECT * FROM ({PART_BASE_90})) WHERE NOT is_mapped)
        WHERE n = 1
    """,
    "localref_shapes": """
        SELECT 'S' || s_suppkey AS app_name, s_name AS field_name, CAST(s_suppkey AS VARCHAR) AS position,
               CASE WHEN s_suppkey % 2 = 0 THEN 'usr' ELSE 'USR' END AS system_type, 'D' AS data_type,
               'IN2D' AS validation_rule, '11.1' AS format_rule, 'SINGLE' AS cardinality, 'NATION' AS relationship_target,
               CASE WHEN s_suppkey % 2 = 0 THEN 'R' END AS alignment, CASE WHEN s_suppkey % 2 = 0 THEN 'MANDATORY' END AS input_status,
               CAST(s_nationkey AS VARCHAR) AS description, s_suppkey % 2 = 1 AS is_local_ref, TRUE AS is_custom_field,
               CASE WHEN s_suppkey % 2 = 0 THEN 'NATION' END AS target_application,
               CASE WHEN s_suppkey % 2 = 0 THEN 'STANDARD_SELECTION_C8' END AS relationship_type
        FROM supplier
    """,
    "has_metadata": f"""
        SELECT app AS app_name, app IN (SELECT app_name FROM ({FIELDS})) AS has_metadata
        FROM (SELECT DISTINCT {_APP.format(key='o_custkey')} AS app FROM orders)
    """,
    "run_metrics": """
        SELECT 'CUSTOMER' AS app_name, count(*) AS records, 5 * count(*) AS cells FROM customer
        UNION ALL SELECT 'SUPPLIER', count(*), 4 * count(*) FROM supplier
        UNION ALL SELECT 'NATION', count(*), 3 * count(*) FROM nation
    """,
    "package_findings": """
        WITH optional AS (SELECT unnest(['local_ref', 'customization', 'relationships']) AS entry),
        files AS (SELECT n_nationkey AS k FROM nation WHERE n_nationkey % 4 = 1),
        documents AS (SELECT n_nationkey AS k FROM nation WHERE n_nationkey % 3 = 0),
        found AS (
            SELECT 'absent' AS package, 'CRITICAL' AS severity, 'root' AS "check", '' AS entry, 1 AS n
            UNION ALL SELECT 'unnamed', 'CRITICAL', 'metadata_directory', 'metadata', 1
            UNION ALL SELECT 'unnamed', 'CRITICAL', 'xsd_directory', 'xsd', 1
            UNION ALL SELECT 'unnamed', 'CRITICAL', 'data_files', 'data', 1
            UNION ALL SELECT 'dataless', 'CRITICAL', 'data_directory', 'data', 1
            UNION ALL SELECT 'dataless', 'CRITICAL', 'metadata_directory', 'metadata', 1
            UNION ALL SELECT p, 'INFO', 'optional_directory', entry, 1
            FROM optional, (SELECT unnest(['unnamed', 'dataless', 'sound', 'broken']) AS p)
            WHERE p <> 'dataless' OR entry <> 'relationships'
            UNION ALL SELECT 'broken', 'CRITICAL', 'data_well_formed', 'data/NATION.xml', count(*) FROM files HAVING count(*) > 0
            UNION ALL SELECT 'broken', 'CRITICAL', 'metadata_well_formed', 'metadata/STANDARD_SELECTION_NATION.xml', count(*)
            FROM documents HAVING count(*) > 0
        ), errors AS (
            SELECT package, coalesce(sum(n) FILTER (WHERE severity = 'CRITICAL'), 0) AS n_errors FROM found GROUP BY package
        )
        SELECT package, severity, "check", entry, CAST(n AS BIGINT) AS n, n_errors = 0 AS is_valid,
               CAST(n_errors AS BIGINT) AS n_errors
        FROM found JOIN errors USING (package)
    """,
    "record_counts": """
        SELECT 'ORDERS' AS app_name, 3 * count(*) AS records FROM orders
        UNION ALL SELECT 'CUSTOMER', count(*) FROM customer
    """,
    "local_ref_coverage": f"""
        WITH apps AS (SELECT DISTINCT {_APP.format(key='o_custkey')} AS app FROM orders)
        SELECT 'WARN' AS severity, 'local_ref_fields' AS "check", app AS path FROM apps
        WHERE app NOT IN (SELECT app_name FROM ({FIELDS}) WHERE position LIKE '%.%')
        UNION ALL
        SELECT 'WARN', 'local_ref_file', app FROM apps
        WHERE app NOT IN (SELECT {_APP.format(key='s_suppkey')} FROM supplier)
    """,
    "undeclared_localrefs": """
        SELECT 'WARN' AS severity, 'undeclared_local_ref' AS "check", 'PART' AS path,
               '[WARN] ' || 4 * count(*) || ' local reference cells without metadata: PART'
               AS message
        FROM part
    """,
    "filter_record": f"SELECT * FROM ({CUSTOMER_AND_PART}) WHERE record_id = '7'",
    "mapped_only": f"SELECT * FROM ({MULTI_APP}) WHERE is_mapped",
    "localref_only": f"SELECT * FROM ({CUSTOMER_AND_PART}) WHERE is_local_ref",
    "profile": (
        "SELECT count(*) AS total_rows, count(DISTINCT record_id) AS unique_records, "
        "count(*) FILTER (WHERE is_mapped) AS mapped_fields, "
        f"count(*) FILTER (WHERE NOT is_mapped) AS unmapped_fields FROM ({MULTI_APP})"
    ),
    "pivot_wide": f"""
        SELECT 'CUSTOMER' AS app_name, CAST(c_custkey AS VARCHAR) AS record_id,
               CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS customer_name,
               CAST(c_nationkey AS VARCHAR) AS nation, {money('c_acctbal')} AS balance,
               c_mktsegment AS segment
        FROM customer
    """,
    "preview": f"SELECT {PREVIEW} FROM ({CUSTOMER_AND_PART}) WHERE record_id = '7'",
    "bounded_table": (
        f"SELECT least(50, count(*)) AS shown, greatest(count(*) - 50, 0) AS more FROM ({CUSTOMER})"
    ),
    "flat_roundtrip": REGION,
    "csv_roundtrip": (
        "SELECT * REPLACE ("
        + ", ".join(
            f"CASE WHEN {flag} THEN 'True' ELSE 'False' END AS {flag}"
            for flag in ("is_local_ref", "is_custom_field", "is_mapped")
        )
        + f") FROM ({MULTI_APP})"
    ),
    "jsonl_roundtrip": MULTI_APP,
}
