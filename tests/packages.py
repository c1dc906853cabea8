"""Small packages written by hand for the tests."""

from pathlib import Path


def schema_row(*fields, columns=("C1", "C2", "C3", "C4", "C6", "C7", "C8")):
    """Fields are (name, system, position, type, format, cardinality, target)."""
    parts = []
    for i, tag in enumerate(columns):
        parts += [f"<{tag}>{f[i]}</{tag}>" for f in fields]
    return "<ROW>" + "".join(parts) + "</ROW>"


CLIENT_SCHEMA = schema_row(
    ("ID", "SYS", "1", "A", "10.1", "SINGLE", ""),
    ("SHORT.NAME", "SYS", "2", "A", "35.1", "MULTI", ""),
    ("COUNTRY", "SYS", "9", "R", "2.1", "MULTI", "COUNTRY"),
    ("SEGMENT", "USR", "64.1", "A", "15.1", "SINGLE", ""),
    ("TAX.NO", "USR", "64.3", "A", "20.1", "MULTI", "TAX.OFFICE"),
)

CLIENT_DATA = """<?xml version="1.0" encoding="UTF-8"?>
<DATA>
    <!-- exported nightly -->
    <row>
        <c1>A1</c1>
        <c2 m="1">John</c2>
        <c2 m="2">Johnny</c2>
        <c9 m="1">US</c9>
        <c64 m="1">GOLD</c64>
        <c64 m="3" s="1">T-1</c64>
        <c64 m="3" s="2">T-2</c64>
        <c64 m="4">unknown</c64>
        <c176>1</c176>
    </row>
    <row>
        <c1>B2</c1>
        <c2 m="1">Jane</c2>
        <c5 s="1">x</c5>
    </row>
</DATA>
"""


def write(root: Path, files: dict[str, str | bytes]) -> str:
    for name, content in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(root)


def client_package(root: Path, **extra: str) -> str:
    return write(root, {
        "data/CLIENT.xml": CLIENT_DATA,
        "metadata/STANDARD_SELECTION_CLIENT.xml": CLIENT_SCHEMA,
        **extra,
    })
