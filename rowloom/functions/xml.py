"""Column expressions that read numbered XML records without leaving the JVM.

A record body is the text between ``<row>`` and ``</row>``.  One regular
expression turns a plain body, a list of ``<cN>`` elements that hold only text,
into a *packed* string of cells that is cut with ``split``.  That is several
times cheaper than an XML parse per record.  Whatever the expression does not
match (child elements, other tags, an end tag of another name, unusual attributes) leaves a ``<`` behind;
such bodies go through ``from_xml`` instead and are packed from its result.

A packed cell is ``CELL position FIELD m FIELD s FIELD text FIELD``.  The two
marks are control characters, which XML does not allow in any document.  An
index is an opening quote and its value, or nothing when the attribute is
absent; the text is still escaped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes.
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_NAME = r"[^\s/<>:=\"'!?]+"
_PREFIX = rf"(?:{_NAME}:)?"
_ATTRS = r"((?:[^>\"'/]++|\"[^\"]*\"|'[^']*')*+)"

# One comment, CDATA section or processing instruction, or a run of anything else.
_TOKENS = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<[^<]*|[^<]+"

CELL = "\x02"
FIELD = "\x01"

# Possessive: what follows a run is never part of it, so nothing is gained by going back.
_INDEX = r"=(\"[^\"<>&\n\t]*+)\""
_PLAIN_CELL = (
    rf"<((?:{_NAME}+:)?+[cC]([0-9]++))(?:\s++m{_INDEX})?(?:\s++s{_INDEX})?\s*+"
    r"(?:/>|>([^<]*+)</\1\s*+>)"
)
_PACKED_CELL = f"{CELL}$2{FIELD}$3{FIELD}$4{FIELD}$5{FIELD}"

_CHILDREN = "e ARRAY<STRUCT<`_rl-tag` STRING, _m STRING, _s STRING, v STRING>>"

# Code points of white space: up to the blank, two in Latin-1, the rest from here.
_BLANK = 32
_LATIN_BLANKS = (0x85, 0xA0)
_OTHER_BLANKS = 0x1680


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace, looking at the ends first."""

    def blank(code: Column) -> Column:
        return (code <= _BLANK) | code.isin(*_LATIN_BLANKS) | (code >= _OTHER_BLANKS)

    ends = blank(F.ascii(text)) | blank(F.ascii(F.right(text, F.lit(1))))
    return F.when(ends, F.btrim(text, F.lit(STRIPPED))).otherwise(text)


def escape(text: Column) -> Column:
    """Escape text for use as element content or attribute value."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for char, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def unescape(text: Column) -> Column:
    """Resolve entities and character references; text holds no ``<``."""
    parsed = F.from_xml(
        F.concat(F.lit("<r><v>"), text, F.lit("</v></r>")),
        "v STRING",
        {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"},
    )
    return F.when(text.contains("&"), F.coalesce(parsed["v"], F.lit(""))).otherwise(text)


def strip_markup(text: Column) -> Column:
    """Drop comments and processing instructions, turn CDATA into escaped text."""

    def plain(token: Column) -> Column:
        def closed(start: str, end: str) -> Column:
            return token.startswith(start) & token.endswith(end)

        cdata = escape(F.substr(token, F.lit(10), F.length(token) - 12))
        return (
            F.when(closed("<!--", "-->") | closed("<?", "?>"), F.lit(""))
            .when(closed("<![CDATA[", "]]>"), cdata)
            .otherwise(token)
        )

    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    return F.when(
        text.contains("<!") | text.contains("<?"),
        F.array_join(F.transform(tokens, plain), ""),
    ).otherwise(text)


def closed_markup(stripped: Column) -> Column:
    """The text, or an error if a comment or CDATA section is left open in it.

    A text cut at record end tags is cut wrongly where the tag stands inside a
    comment or CDATA section; this makes such a cut fail instead of going on.
    """
    left_open = stripped.contains("<!--") | stripped.contains("<![CDATA[")
    message = "A comment or CDATA section holds a record end tag or is not closed"
    return F.when(left_open, F.raise_error(F.lit(message))).otherwise(stripped)


def unix_newlines(text: Column) -> Column:
    """XML parsers report every line end as a line feed."""
    return F.when(text.contains("\r"), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(text)


def _pack_parsed(body: Column) -> Column:
    """Pack any body: every element becomes ``<e rl-tag="name">`` with its leading
    text in ``<v>``, and one ``from_xml`` returns the direct children in order.
    Another one reads the elements by their own names, so that end tags must match."""
    own = F.regexp_replace(body, rf"<(/?){_PREFIX}({_NAME})", "<$1$2")
    matching = F.from_xml(
        F.concat(F.lit("<r>"), own, F.lit("</r>")), "`_rl-none` STRING", {"mode": "FAILFAST"}
    )
    marked = F.regexp_replace(body, r"(<[^>]*?\s)([MS])(\s*=\s*[\"'])", "$1rl-$2$3")
    marked = F.regexp_replace(marked, r"</[^>]*>", "</e>")
    marked = F.regexp_replace(
        marked, rf"<{_PREFIX}({_NAME}){_ATTRS}/>", '<e rl-tag="$1"$2/>'
    )
    marked = F.regexp_replace(
        marked, rf"<{_PREFIX}({_NAME}){_ATTRS}>([^<]*)", '<e rl-tag="$1"$2><v>$3</v>'
    )
    parsed = F.from_xml(
        F.concat(F.lit("<r>"), marked, F.lit("</r>")),
        _CHILDREN,
        {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"},
    )

    def index(value: Column) -> Column:
        return F.coalesce(F.concat(F.lit('"'), value), F.lit(""))

    def packed(child: Column) -> Column:
        position = F.regexp_extract(child["_rl-tag"], r"^[cC]([0-9]+)$", 1)
        mark = F.lit(FIELD)
        text = escape(F.coalesce(child["v"], F.lit("")))
        cell = F.concat(
            F.lit(CELL), position, mark, index(child["_m"]), mark, index(child["_s"]),
            mark, text, mark,
        )
        return F.when(position != "", cell).otherwise(F.lit(""))

    out = F.coalesce(F.array_join(F.transform(parsed["e"], packed), ""), F.lit(""))
    return F.when(matching.isNotNull(), out)


def pack_plain(body: Column) -> Column:
    """Pack the plain cells of a body that has no comments or CDATA left."""
    return F.regexp_replace(body, _PLAIN_CELL, _PACKED_CELL)


def pack(body: Column, plain: Column) -> Column:
    """``plain`` if it is complete, else the body packed by the XML parser."""
    incomplete = plain.contains("<") | body.contains(CELL) | body.contains(FIELD)
    return F.when(incomplete, _pack_parsed(body)).otherwise(plain)


def packed_fields(packed: Column) -> Column:
    """The fields of all packed cells in one array, four each, and the loose text after the last cell."""
    return F.split(packed, FIELD)


def cell_numbers(fields: Column) -> Column:
    """1 to the number of cells in an array of fields; null if there is none."""
    n = F.floor((F.size(fields) - 1) / 4).cast("int")
    return F.when(n > 0, F.sequence(F.lit(1), n))


def cell_fields(fields: Column, number: Column) -> list[Column]:
    """Position, m, s and text of a cell; loose text before it stands in front of its position."""
    own = [F.get(fields, 4 * number - back) for back in (4, 3, 2, 1)]
    return [F.substring_index(own[0], CELL, -1), *own[1:]]


def index_value(raw: Column) -> Column:
    """Null when the attribute is absent, ``''`` when it is empty."""
    return F.when(raw != "", F.substr(raw, F.lit(2)))


def first_text(packed: Column, position: str) -> Column:
    """``FIELD`` and text of the first cell with exactly this position, or ``''``.

    Mostly that is the first cell, which is cut out without a pattern.
    """
    found = F.regexp_extract(
        packed,
        f"{CELL}{position}{FIELD}[^{FIELD}]*{FIELD}[^{FIELD}]*({FIELD}[^{FIELD}]*)",
        1,
    )
    first = F.substring_index(F.substring_index(packed, FIELD, 4), FIELD, -1)
    return F.when(packed.startswith(f"{CELL}{position}{FIELD}"), F.concat(F.lit(FIELD), first)).otherwise(found)
