"""Records and cells: text, attributes, markup, splits."""

import xml.etree.ElementTree as ET
from xml.sax.saxutils import escape

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom.functions import xml
from rowloom.operators.cells import cells
from rowloom.sources import records


def parse(spark, *texts):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, rec STRING")
    rows = cells(records.from_table(table, "rec", "id")).orderBy("id", "record_no", "ord").collect()
    return [(r.xml_element, r.raw_position, r.mv_index, r.sv_index, r.value) for r in rows]


def expected(*texts):
    """The same by a plain XML parser, for texts that are one element each."""
    out = []
    for text in texts:
        for child in ET.fromstring(text):
            tag = child.tag.rpartition("}")[2].lower()
            if tag[0] == "c" and tag[1:].isdigit():
                out.append((tag, tag[1:], child.get("m"), child.get("s"), (child.text or "").strip()))
    return out


EDGES = {
    "empty elements": "<row><c30/><c31></c31><c32 m='1' /></row>",
    "white space": "<row><c1>  a b\n </c1><c2> x </c2><c3> \t\n</c3></row>",
    "empty index": '<row><c1 m="">a</c1><c2 m="" s="1">b</c2></row>',
    "sub-value alone": '<row><c1 s="2">a</c1></row>',
    "upper case": '<ROW><C1>a</C1><C64 m="1">b</C64></ROW>',
    "foreign attribute": '<row><c1 x="m" M="9" n="1" m="2">a</c1></row>',
    "attribute order": "<row><c1 s='2' m='1'>a</c1><c2\n\tm = \"3\">b</c2></row>",
    "quotes": "<row><c1 m='\"'>a</c1><c2 m=\"it's\">b</c2></row>",
    "angle in attribute": '<row><c1 m="a>b">x > y</c1></row>',
    "entities": "<row><c1>&amp;&lt;&gt;&quot;&apos;&#233;&#x41;</c1><c2 m='&amp;1'>x</c2></row>",
    "cdata": "<row><c1><![CDATA[<c2>&amp;]]> tail</c1><c3>a<![CDATA[]]>b</c3></row>",
    "comments": "<row><!-- <c9>no</c9> --><c1>a<!-- x -->b</c1></row>",
    "instructions": "<row><?pi <c9>?><c1>a<?pi?>b</c1></row>",
    "nested": "<row><c1>a<b>c</b>d</c1><g><c9>no</c9></g><c2><c3>no</c3>x</c2><c4>y</c4></row>",
    "other tags": "<row><name>x</name><c>y</c><cx1>z</cx1><c1x>q</c1x><c1>a</c1></row>",
    "loose text": "<row>junk<c1>a</c1>junk<c2>b</c2>junk</row>",
    "leading zeros": "<row><c01>x</c01><c1>00705</c1></row>",
    "line ends": "<row><c1>a\r\nb\rc</c1><c2>&#13;</c2></row>",
    "row words": "<row><c1>grow rows the row</c1><c2>a:row b</c2></row>",
    "row attributes": '<row id="1" x="y"><c1>a</c1></row>',
    "non-ascii": "<row><c1>日本 Ünï</c1><c2>　全　</c2></row>",
    "no cells": "<row></row>",
    "prefix": '<n:row xmlns:n="u"><n:c1>a</n:c1><n:C2 m="1">b</n:C2></n:row>',
}


@pytest.mark.parametrize("name", EDGES)
def test_edge(spark, name):
    assert parse(spark, EDGES[name]) == expected(EDGES[name])


def test_record_ids(spark):
    texts = [
        "<row><c2>x</c2></row>", "<row><c1/><c1>b</c1></row>", "<row><c01>a</c01><c2/></row>",
        "<row><c2>x</c2><C1> k&amp;1 </C1></row>", "<row><c1>a</c1><c1>b</c1></row>",
    ]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, rec STRING")
    rows = cells(records.from_table(table, "rec", "id")).select("id", "record_id").distinct().collect()
    assert dict(rows) == {0: None, 1: "", 2: None, 3: "k&1", 4: "a"}


def test_several_records_in_one_text(spark):
    text = "<D><row><c1>a</c1></row><row/><ROW><c1>b</c1></ROW><row></row><rows><c1>no</c1></rows></D>"
    assert [v for *_, v in parse(spark, text)] == ["a", "b"]


def test_undefined_entity_fails(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse(spark, "<row><c1>a &nope; b</c1></row>")


def test_bare_ampersand_fails(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse(spark, "<row><c1>a & b</c1></row>")


def test_end_tag_of_another_name_fails(spark):
    for text in ("<row><c1>a</c9></row>", "<row><c1>a</C1></row>", "<row><c1>a</c1></c2></row>"):
        with pytest.raises(Exception):
            parse(spark, text)
    assert parse(spark, "<row><c1>a</c1 ><c2>b</c2\n></row>") == expected("<row><c1>a</c1><c2>b</c2></row>")


def test_strip_matches_python(spark):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [b + "é x" + b for b in blanks] + ["", " ", "é", "日", "​x"]
    table = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for row in table.select("t", xml.strip(F.col("t")).alias("s")).collect():
        assert row.s == row.t.strip()


def test_packed_marks_do_not_survive(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parse(spark, "<row><c1>a\x01b</c1></row>")


VALUES = st.text(
    st.characters(exclude_categories=("Cs", "Cc"), exclude_characters="￾￿"), max_size=12
)
INDEX = st.none() | st.text("0123456789 <&\"'>", max_size=4)
CELLS = st.lists(st.tuples(st.integers(0, 200), INDEX, INDEX, VALUES), max_size=6)


def render(rows):
    def attribute(name, value):
        return "" if value is None else f' {name}="{escape(value, {chr(34): "&quot;"})}"'

    return "<row>" + "".join(
        f"<c{p}{attribute('m', m)}{attribute('s', s)}>{escape(v)}</c{p}>" for p, m, s, v in rows
    ) + "</row>"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(CELLS, min_size=20, max_size=40))
def test_parse_of_render(spark, batch):
    assert parse(spark, *map(render, batch)) == [
        (f"c{p}", str(p), m, s, v.strip()) for rows in batch for p, m, s, v in rows
    ]


@pytest.mark.parametrize("end", ["</row>", "</ROW>", "</n:row>"])
@pytest.mark.parametrize("split_bytes", [64, 1000, 1 << 20])
def test_splits_of_any_size(spark, tmp_path, end, split_bytes):
    tag = end[2:-1]
    body = "".join(f"<{tag}><c1>{i}</c1><c2 m='1'>v{i}</c2></{tag}>\n" for i in range(300))
    path = tmp_path / "APP.xml"
    path.write_text(f'<?xml version="1.0"?>\n<DATA xmlns:n="u">\n{body}<{tag}/></DATA>')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        assert records.record_end_tag(spark, str(path)) == end
        for end_tag in (end, "</row>"):
            found = cells(records.stream_records(spark, [str(path)], end_tag))
            rows = found.select("record_id", "raw_position", "value").collect()
            assert sorted(rows) == sorted(
                [(str(i), "1", str(i)) for i in range(300)]
                + [(str(i), "2", f"v{i}") for i in range(300)]
            )
            counted = records.count_records(spark, [str(path)], end_tag).collect()
            assert [r.records for r in counted] == [301]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_same_cells_as_the_native_reader(spark, tmp_path):
    body = "".join(
        f"<row><c1>k{i}</c1><c2 m='1'>a&amp;{i}</c2><c2 m='2'>b</c2><c3/></row>" for i in range(50)
    )
    path = tmp_path / "APP.xml"
    path.write_text(f"<DATA>{body}</DATA>")
    shape = "ARRAY<STRUCT<_VALUE: STRING, _m: STRING>>"
    native = (
        spark.read.option("rowTag", "row")
        .schema(f"c1 {shape}, c2 {shape}, c3 {shape}")
        .xml(str(path))
    )
    wanted = []
    for name in ("c1", "c2", "c3"):
        rows = native.select(F.explode(name).alias("c")).select("c._m", "c._VALUE").collect()
        wanted += [(name, r._m, r._VALUE or "") for r in rows]
    ours = cells(records.stream_records(spark, [str(path)]))
    assert sorted(wanted, key=str) == sorted(
        ours.select("xml_element", "mv_index", "value").collect(), key=str
    )


def test_a_record_is_cut_into_fields_once(spark):
    texts = ['<row> a <c2>x</c2> b <c1 m="1" s="2">k</c1> tail</row>', "<row>none</row>", "<row><c1/><c3>y</c3></row>"]
    assert parse(spark, *texts) == expected(*texts)
    table = spark.createDataFrame([(0, texts[0])], "id INT, rec STRING")
    found = cells(records.from_table(table, "rec", "id"))
    assert found.orderBy("ord").first().record_id == "k"
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(packed") == 1
    assert "split(cell" not in found._jdf.queryExecution().optimizedPlan().toString()
