"""Metadata loaders, precedence and catalog lookups."""

import pytest
from packages import schema_row

from rowloom.config import CUSTOMIZATION, LOCAL_REF, RELATIONSHIPS, STANDARD_SELECTION
from rowloom.operators import catalog, metadata


def docs(spark, *documents):
    rows = [("app", f"{i}.xml", kind, content) for i, (kind, content) in enumerate(documents)]
    return metadata.documents(
        spark.createDataFrame(rows, "app_name STRING, source STRING, kind STRING, content STRING")
    )


def fields(spark, *documents):
    rows = metadata.load_fields(docs(spark, *documents)).orderBy("source_rank", "ordinal").collect()
    return [r.asDict() for r in rows]


def pick(row, *names):
    return tuple(row[n] for n in names)


def test_schema_row(spark):
    text = (
        "<x:DATA xmlns:x='u'><x:row><c1> A </c1><C1/><C1>C</C1><C1>D</C1>"
        "<C2>usr</C2><C2>SYS</C2><C2>SYS</C2><C2>Local</C2>"
        "<C3>1</C3><C3>2</C3><C3/><C3>4.5</C3><C3>6</C3>"
        "<C8>T</C8><C9>L</C9><C10>INPUT</C10><C11>text</C11><C12>2</C12><Z>z</Z>"
        "</x:row><ROW><C1>LATER</C1><C3>9</C3></ROW></x:DATA>"
    )
    rows = fields(spark, (STANDARD_SELECTION, text))
    names = ("app_name", "field_name", "position", "system_type", "relationship_target",
             "alignment", "input_status", "description", "is_local_ref", "is_custom_field", "ordinal")
    assert [pick(r, *names) for r in rows] == [
        ("APP", "A", "1", "usr", "T", "L", "INPUT", "text", False, True, 0),
        ("APP", "D", "4.5", "Local", None, None, None, None, True, True, 3),
    ]


def test_root_row_and_nested_text(spark):
    rows = fields(spark, (STANDARD_SELECTION, "<ROW><C1>A<b>x</b></C1><C3><!-- 9 -->1</C3></ROW>"))
    assert [pick(r, "field_name", "position") for r in rows] == [("A", "1")]


@pytest.mark.parametrize("text", ["<D/>", "<ROW/>", "<ROW><C1>A</C1></ROW>", "<ROW><C3>1</C3></ROW>"])
def test_unloadable_schema(spark, text):
    assert metadata.column_style_problems(docs(spark, (STANDARD_SELECTION, text))).count() == 1
    assert fields(spark, (STANDARD_SELECTION, text)) == []


def test_malformed_document_fails(spark):
    with pytest.raises(Exception, match="mismatched tag"):
        fields(spark, (STANDARD_SELECTION, "<ROW><C1>A</C3></ROW>"))


def test_local_ref_shapes(spark):
    columns = "<ROW><C1>A</C1><C2>SYS</C2><C3>7</C3></ROW>"
    nodes = (
        "<LOCAL.REF><wrap><FIELD><NAME>N</NAME><POSITION>64.1</POSITION><TYPE>A</TYPE>"
        "<FORMAT>15.1</FORMAT><CARDINALITY>MULTI</CARDINALITY><RELATIONSHIP>T</RELATIONSHIP>"
        "<VALIDATION>V</VALIDATION><DESC>d</DESC></FIELD></wrap>"
        "<local_ref_field><C1>X</C1><POS>5</POS></local_ref_field>"
        "<FIELD><NAME>no position</NAME></FIELD></LOCAL.REF>"
    )
    rows = fields(spark, (LOCAL_REF, columns))
    assert [pick(r, "field_name", "system_type", "is_local_ref", "is_custom_field") for r in rows] == [
        ("A", "SYS", False, False)
    ]
    rows = fields(spark, (LOCAL_REF, nodes))
    names = ("field_name", "position", "system_type", "data_type", "format_rule", "cardinality",
             "relationship_target", "validation_rule", "description", "is_local_ref", "is_custom_field")
    assert [pick(r, *names) for r in rows] == [
        ("N", "64.1", "USR", "A", "15.1", "MULTI", "T", "V", "d", True, True),
        ("X", "5", "USR", None, None, None, None, None, None, True, True),
    ]
    assert metadata.load_relationships(docs(spark, (LOCAL_REF, nodes))).count() == 0


def test_local_ref_with_both_columns_and_no_row_is_an_error(spark):
    text = "<LOCAL.REF><FIELD><C1>A</C1><C3>64.1</C3></FIELD></LOCAL.REF>"
    assert metadata.column_style_problems(docs(spark, (LOCAL_REF, text))).count() == 1


def test_first_listed_child_decides(spark):
    text = (
        "<C><FIELD><FIELD.NAME>A</FIELD.NAME><NAME>B</NAME><POS/><POSITION>2</POSITION></FIELD>"
        "<CUSTOM_FIELD><NAME>C</NAME><FIELD.NO>3</FIELD.NO><DATA_TYPE/><TYPE>A</TYPE>"
        "<SINGLE.MULTI>SINGLE</SINGLE.MULTI></CUSTOM_FIELD></C>"
    )
    rows = fields(spark, (CUSTOMIZATION, text))
    assert [pick(r, "field_name", "position", "data_type", "cardinality", "is_local_ref") for r in rows] == [
        ("C", "3", None, "SINGLE", False)
    ]


def test_relationship_documents(spark):
    text = (
        "<R><RELATION><SOURCE.FIELD>F</SOURCE.FIELD><POSITION>1</POSITION><TARGET>T</TARGET>"
        "<RELATIONSHIP.TYPE>FK</RELATIONSHIP.TYPE></RELATION>"
        "<link><LOCATION>2</LOCATION><FOREIGN.APPLICATION>U</FOREIGN.APPLICATION></link>"
        "<LINK><POSITION>3</POSITION></LINK></R>"
    )
    rows = metadata.load_relationships(docs(spark, (RELATIONSHIPS, text))).orderBy("ordinal").collect()
    names = ("field_name", "position", "target_application", "relationship_type")
    assert [tuple(r[n] for n in names) for r in rows] == [
        ("F", "1", "T", "FK"), ("FIELD_2", "2", "U", None),
    ]


DOCUMENTS = (
    (STANDARD_SELECTION, schema_row(
        ("A", "SYS", "1", "A", "10.1", "SINGLE", "TA"),
        ("B", "SYS", "2", "A", "10.1", "SINGLE", "TB"),
        ("B2", "SYS", "2", "R", "", "", ""),
        ("C", "SYS", "64.1", "A", "10.1", "SINGLE", ""),
    )),
    (LOCAL_REF, "<L><FIELD><NAME>L</NAME><POSITION>64.1</POSITION></FIELD>"
                "<FIELD><NAME>L1</NAME><POSITION>1</POSITION></FIELD></L>"),
    (CUSTOMIZATION, "<C><FIELD><NAME>K</NAME><POSITION>1</POSITION><RELATIONSHIP>TK</RELATIONSHIP></FIELD></C>"),
    (RELATIONSHIPS, "<R><LINK><POSITION>2</POSITION><TARGET>TR</TARGET></LINK>"
                    "<LINK><POSITION>8</POSITION><TARGET>T8</TARGET></LINK></R>"),
)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1)])
def test_precedence(spark, order):
    merged = catalog.catalog(docs(spark, *(DOCUMENTS[i] for i in order)))
    rows = {r.position: r for r in catalog.fields(merged).collect()}
    assert {p: r.field_name for p, r in rows.items()} == {"1": "K", "2": "B2", "64.1": "L"}
    # The whole record is replaced: nothing of an earlier definition is left.
    assert (rows["1"].system_type, rows["1"].data_type, rows["1"].relationship_target) == ("CUSTOM", None, "TK")
    links = {r.position: r.target_application for r in catalog.relationships(merged).collect()}
    assert links == {"1": "TA", "2": "TR", "8": "T8"}
    assert merged.count() == merged.select("app_name", "position").distinct().count() == 4


def test_lookups(spark):
    merged = catalog.catalog(docs(spark, *DOCUMENTS))
    assert [r.field_name for r in catalog.resolve_field(merged, "App", "2").collect()] == ["B2"]
    assert catalog.resolve_field(merged, "app", "99").isEmpty()
    assert catalog.resolve_relationship(merged, "APP", "8").count() == 1
    assert catalog.has_app_metadata(merged, "app") and not catalog.has_app_metadata(merged, "x")
    assert catalog.list_fields(merged, "app").count() == 3
    assert [r.position for r in catalog.list_local_ref_fields(merged, "app").collect()] == ["64.1"]
    assert [tuple(r) for r in catalog.summary(merged).collect()] == [("APP", 3, 1)]


def test_broadcast_and_salted_joins_agree(spark):
    from rowloom.operators.normalize import normalize

    merged = catalog.catalog(docs(spark, *DOCUMENTS))
    cells = spark.createDataFrame(
        [("APP", "f", "r", i, f"c{p}", p, m, None, str(i))
         for i, (p, m) in enumerate([("1", None), ("2", "1"), ("64", "1"), ("64", ""), ("8", None), ("7", None)] * 20)],
        "app_name STRING, source_file STRING, record_id STRING, ord INT, xml_element STRING, "
        "raw_position STRING, mv_index STRING, sv_index STRING, value STRING",
    )
    results = [
        sorted(normalize(cells, merged, broadcast=b).collect(), key=str) for b in (True, False)
    ]
    assert results[0] == results[1] and len(results[0]) == 120
    one = {r.resolved_position: r for r in results[0]}
    # A replaced field keeps the relationship that an earlier source gave it.
    assert (one["1"].field_name, one["1"].relationship_target) == ("K", "TA")
    assert (one["8"].is_mapped, one["8"].relationship_target, one["8"].field_name) == (False, "T8", "FIELD_8")


@pytest.mark.parametrize("heavy, row_bytes", [(1, 4096), (2, 4096), (4096, 10), (4096, 4096)])
def test_heavy_positions_agree_with_the_broadcast(spark, monkeypatch, heavy, row_bytes):
    """Whatever part of the positions is joined in place, mapped or not, no cell is lost or met twice."""
    from rowloom.operators import normalize as n

    merged = catalog.catalog(docs(spark, *DOCUMENTS))
    cells = spark.createDataFrame(
        [("APP", "f", "r", i, f"c{p}", p, m, None, str(i))
         for i, (p, m) in enumerate([("1", None)] * 50 + [("9", None)] * 30 + [("2", "1"), ("8", None), ("64", "1"), (None, None)])],
        "app_name STRING, source_file STRING, record_id STRING, ord INT, xml_element STRING, "
        "raw_position STRING, mv_index STRING, sv_index STRING, value STRING",
    )
    monkeypatch.setattr(n, "HEAVY", heavy)
    monkeypatch.setattr(n, "ROW_BYTES", row_bytes)
    resolved = cells.withColumn("resolved_position", n.resolved_position(("64",)))
    found = {r.resolved_position for r in n.heavy_positions(resolved).collect()}
    assert found == ({"1"} if heavy == 1 else {"1", "9"} if heavy == 2 else {"1", "9", "2", "8", "64.1"})
    rows = [sorted(n.normalize(cells, merged, broadcast=b).collect(), key=str) for b in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) == 84
    plan = n.normalize(cells, merged, broadcast=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Union" in plan
    assert n.lookup_bytes(merged) > 64 * merged.count() and n.lookup_bytes(merged.limit(0)) == 0
