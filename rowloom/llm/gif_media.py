"""GIF: store byte payloads as palette images, decode LZW streams and render timed frames."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowloom.llm.common import pieces
from rowloom.plans.scratch import materialize

WIDTH = 64
FRAME_ROWS = 1024
DELAY_CS = 10
#: Bins of the colour histograms.
BINS = 8

# Fixed values of the format: an 8-bit image's code to forget the table, its last code, the largest table.
CLEAR, END, FULL = 256, 257, 4096
GREY = bytes(v for v in range(256) for _ in range(3))


def code_widths(n: int, bits: int = 8) -> np.ndarray:
    """Bits of each code after a clear code: the table grows by one with every code but the first."""
    known = (1 << bits) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.floor(np.log2(known)).astype(np.int64) + 1, bits + 1, 12)


def lzw_encode(data: bytes) -> bytes:
    """LZW code stream of 8-bit samples; the table is forgotten when it is full."""
    segments, codes, table, prefix = [], [], {}, data[0]
    size = END + 1
    for byte in memoryview(data)[1:]:
        key = prefix << 8 | byte
        known = table.get(key)
        if known is not None:
            prefix = known
            continue
        codes.append(prefix)
        if size < FULL:
            table[key] = size
            size += 1
        else:
            segments.append([*codes, CLEAR])
            codes, table, size = [], {}, END + 1
        prefix = byte
    segments.append([*codes, prefix, END])
    values = np.concatenate([[CLEAR], *map(np.array, segments)]).astype(np.int64)
    widths = np.concatenate([[9], *[code_widths(len(s)) for s in segments]])
    lanes = np.arange(12)
    bits = ((values[:, None] >> lanes) & 1)[lanes < widths[:, None]]
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def lzw_decode(stream: bytes, n: int, bits: int = 8) -> bytes:
    """``n`` samples of a code stream.

    Between clear codes the widths follow from the number of codes, so codes
    are cut out many at a time; strings are then built in order.
    """
    clear, end = 1 << bits, (1 << bits) + 1
    data = np.frombuffer(stream + bytes(4), np.uint8).astype(np.int64)
    total = 8 * len(stream)
    roots = [bytes([v]) for v in range(1 << bits)] + [b"", b""]
    widths = code_widths(FULL, bits)
    at, read, made = 0, 0, 0
    table, last, out = roots[:], b"", []
    while made < n:
        step = widths[read:read + FULL] if read < FULL else np.full(FULL, 12)
        offsets = at + np.concatenate(([0], np.cumsum(step)))
        step, places = step[offsets[1:] <= total], offsets[:-1][offsets[1:] <= total]
        if not len(step):
            break
        low = places >> 3
        codes = (data[low] | data[low + 1] << 8 | data[low + 2] << 16) >> (places & 7) & ((1 << step) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else len(codes)
        for code in codes[:stop].tolist():
            entry = table[code] if code < len(table) else last + last[:1]
            if last and len(table) < FULL:
                table.append(last + entry[:1])
            out.append(entry)
            last = entry
        made = sum(map(len, out)) if len(out) else 0
        if stop == len(codes):
            at, read = int(places[-1] + step[-1]), read + len(codes)
            continue
        if codes[stop] == end:
            break
        at, read, table, last = int(places[stop] + step[stop]), 0, roots[:], b""
    return b"".join(out)[:n]


def _blocks(data: bytes) -> bytes:
    cut = [data[i:i + 255] for i in range(0, len(data), 255)]
    return b"".join(bytes([len(c)]) + c for c in cut) + b"\0"


def _word(*values: int) -> bytes:
    return b"".join(v.to_bytes(2, "little") for v in values)


def encode(payload: bytes) -> bytes:
    """A payload of whole rows as grey frames of at most ``FRAME_ROWS`` rows, one after the other."""
    step = WIDTH * FRAME_ROWS
    frames = [payload[i:i + step] for i in range(0, len(payload), step)]
    head = b"GIF89a" + _word(WIDTH, len(frames[0]) // WIDTH) + b"\xf7\0\0" + GREY
    body = b"".join(
        b"\x21\xf9\x04" + bytes([2 << 2]) + _word(DELAY_CS) + b"\0\0"
        + b"\x2c" + _word(0, 0, WIDTH, len(frame) // WIDTH) + b"\0" + b"\x08" + _blocks(lzw_encode(frame))
        for frame in frames
    )
    return head + body + b"\x3b"


@dataclass
class Frame:
    """One image as shown: the area it covers on the canvas, in RGB, and for how long; the canvas if it was asked for."""

    left: int
    top: int
    area: np.ndarray
    canvas: np.ndarray | None
    delay_cs: int


def _rows_in_order(rows: int) -> np.ndarray:
    """Where the rows of an interlaced image belong."""
    return np.concatenate([np.arange(s, rows, d) for s, d in ((0, 8), (4, 8), (2, 4), (1, 2))])


def decode(gif: bytes, canvases: bool = True) -> list[Frame]:
    """All frames with palettes, transparency and disposal applied; the whole canvas after each only with ``canvases``."""
    number = lambda at: int.from_bytes(gif[at:at + 2], "little")
    palette = lambda at, flags: np.frombuffer(gif, np.uint8, 3 << (flags & 7) + 1, at).reshape(-1, 3)
    if gif[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    canvas = np.zeros((number(8), number(6), 3), np.uint8)
    at, shared = 13, None
    if gif[10] & 0x80:
        shared = palette(at, gif[10])
        at += shared.size
    frames: list[Frame] = []
    disposal, delay, hidden = 0, 0, None
    while at < len(gif) and gif[at] != 0x3B:
        if gif[at] == 0x21:
            if gif[at + 1] == 0xF9:
                disposal, delay = gif[at + 3] >> 2 & 7, number(at + 4)
                hidden = gif[at + 6] if gif[at + 3] & 1 else None
            at += 2
            while gif[at]:
                at += gif[at] + 1
            at += 1
            continue
        if gif[at] != 0x2C:
            raise ValueError(f"unknown block {gif[at]}")
        left, top, wide, high = (number(at + k) for k in (1, 3, 5, 7))
        flags, colours = gif[at + 9], shared
        at += 10
        if flags & 0x80:
            colours = palette(at, flags)
            at += colours.size
        bits, stream = gif[at], []
        at += 1
        while gif[at]:
            stream.append(gif[at + 1:at + 1 + gif[at]])
            at += gif[at] + 1
        at += 1
        samples = lzw_decode(b"".join(stream), wide * high, bits)
        image = np.frombuffer(samples.ljust(wide * high, b"\0"), np.uint8).reshape(high, wide)
        if flags & 0x40:
            image = image[np.argsort(_rows_in_order(high))]
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top:top + high, left:left + wide]
        image = image[:area.shape[0], :area.shape[1]]
        shown = colours[image]
        area[:] = shown if hidden is None else np.where((image == hidden)[..., None], area, shown)
        frames.append(Frame(left, top, area.copy(), canvas.copy() if canvases else None, delay))
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            canvas[:] = before
        disposal, delay, hidden = 0, 0, None
    return frames


def histogram(area: np.ndarray) -> list[int]:
    """Pixels of a frame by red, then green, then blue, each in ``BINS`` equal bins."""
    counts = [np.bincount(area[..., channel].ravel(), minlength=256) for channel in range(3)]
    return np.concatenate(counts).reshape(3 * BINS, -1).sum(axis=1).tolist()


def payload(text: str | None) -> tuple[bytes, int]:
    """A text as UTF-8, filled with zero bytes to a positive multiple of 64, and its bytes before."""
    data = (text or "").encode("utf-8", "surrogatepass")
    size = max(64, -(-len(data) // 64) * 64)
    return data.ljust(size, b"\0"), len(data)


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 128):
        filled = [payload(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([n for _, n in filled], pa.int64()),
            pa.array([encode(p) for p, _ in filled], pa.binary()),
        ], names=["doc_id", "n_bytes", "media"])


def store(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media``: every text as a GIF, written to the shared folder; null texts count as empty."""
    ids = docs.select("doc_id", "text")
    kind = ids.schema["doc_id"].dataType.simpleString()
    return materialize(ids.mapInArrow(_store, f"doc_id {kind}, n_bytes long, media binary"), "media")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 128):
        rows = []
        for media in batch.column("media").to_pylist():
            frames = decode(media, canvases=False)
            data = b"".join(f.area[..., 0].tobytes() for f in frames)
            by_frame = [histogram(f.area) for f in frames]
            counts = map(sum, zip(*by_frame))
            rows.append((
                len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(media),
                hashlib.sha256(media).hexdigest(), [f.delay_cs * 10 for f in frames],
                by_frame,
                f"frames={len(frames)};ms={sum(f.delay_cs for f in frames) * 10};hist={','.join(map(str, counts))}",
            ))
        size, sha, tail, stored, media_sha, delays, hists, feature = zip(*rows) if rows else ([],) * 8
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("n_bytes"), pa.array(size, pa.int64()), pa.array(sha, pa.string()),
            pa.array(tail, pa.int64()), pa.array(stored, pa.int64()), pa.array(media_sha, pa.string()),
            pa.array(delays, pa.list_(pa.int32())), pa.array(hists, pa.list_(pa.list_(pa.int64()))),
            pa.array(feature, pa.string()),
        ], names=[c for c, _ in _FEATURES])


_FEATURES = (
    ("doc_id", ""), ("n_bytes", "long"), ("payload_bytes", "long"), ("payload_sha256", "string"),
    ("tail_crc32", "long"), ("media_bytes", "long"), ("media_sha256", "string"),
    ("frame_ms", "array<int>"), ("frame_histograms", "array<array<long>>"), ("feature", "string"),
)


def features(media: DataFrame) -> DataFrame:
    """What the stored images decode to: payload digests, frame times, colour histograms, one feature string.

    Rows are independent: null or repeated ids are kept as they are, equal texts
    give equal values, and an empty table gives no rows.
    """
    kind = media.schema["doc_id"].dataType.simpleString()
    ddl = ", ".join(f"{name} {ddl or kind}" for name, ddl in _FEATURES)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, ddl)
