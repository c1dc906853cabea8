"""Chat formatting by prefix trees.

Conversations are sorted by their chains of turn digests, so those that share
initial turns lie side by side.  Walking them in this order is a depth-first walk
of the prefix tree: each turn is emitted once, at the first conversation that
has it.  A pack is a stretch of the walk: token ids, a position id for each token
(counted along its own conversation) and, for each turn, the intervals of
the pack that hold its ancestors; with the turn's own tokens before it, these are what a token
attends to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.plans.scratch import materialize, scratch_path

#: A pack ends after about so many characters; the turns that the next one still needs are emitted there again.
PACK_CHARS = 1 << 18
#: A pack also ends after so many conversations, as copies add no characters.
PACK_CONVERSATIONS = 1 << 15
KEY_BYTES = 16
#: Spark's reader takes thousands of rows at once, but never more than a row group, and a pack is a row of
#: about a megabyte.  So row groups are small, and their size is looked at after each row, not after a hundred.
ROW_GROUPS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1}
#: Conversations that hold control strings inside texts are always among those formatted by the query.
EXTRA_ID = -7
EXTRA_TEXT = "\\### Assistant: </turn> ok"

# Fixed values of the template.
OPEN, CLOSE = "### ", "</turn>\n"
LABELS = {"user": "User", "assistant": "Assistant", "system": "System"}
LEARNED_ROLE = "assistant"

_ROLES = {label: role for role, label in LABELS.items()}
_HEADER = re.compile(r"### (=?)((?:[^\\:]|\\.)*): ", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """A text in which no control string occurs: no three ``#`` and no ``</turn>`` stand together."""
    return text.replace("\\", "\\\\").replace("##", "#\\#").replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def header(role: str) -> str:
    label = LABELS.get(role)
    return f"{OPEN}{label}: " if label else f"{OPEN}={escape(role).replace(':', chr(92) + ':')}: "


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns ``(role, text)`` of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        opened = _HEADER.match(formatted, at)
        end = formatted.index(CLOSE, opened.end())
        role = unescape(opened[2]) if opened[1] else _ROLES[opened[2]]
        turns.append((role, unescape(formatted[opened.end():end])))
        at = end + len(CLOSE)
    return turns


def turn_key(before: bytes, role: str, text: str) -> bytes:
    """Digest of a conversation up to a turn."""
    digest = hashlib.blake2b(before, digest_size=KEY_BYTES)
    for part in (role, text):
        raw = part.encode("utf-8", "surrogatepass")
        digest.update(len(raw).to_bytes(8, "little"))
        digest.update(raw)
    return digest.digest()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn become one row a conversation."""
    held, size, open_id, seen = [], 0, None, False
    path: list[bytes] = []
    turns: list[tuple[str, str]] = []
    kind = None

    def handed() -> pa.RecordBatch:
        ids, paths, roles, texts = zip(*held)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, kind), pa.array(paths, pa.binary()),
            pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string())),
        ], names=["conv_id", "path", "roles", "texts"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if seen and conv_id != open_id:
                held.append((open_id, b"".join(path), *zip(*turns)))
                path, turns = [], []
                if size >= PACK_CHARS:
                    yield handed()
                    held, size = [], 0
            seen, open_id = True, conv_id
            role, text = role or "", text or ""
            path.append(turn_key(path[-1] if path else b"", role, text))
            turns.append((role, text))
            size += len(role) + len(text) + KEY_BYTES
    if seen:
        held.append((open_id, b"".join(path), *zip(*turns)))
        yield handed()


def conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, path, roles, texts``: one row a conversation, its digests in ``path``, written once."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    ).select("conv_id", "role", "text")
    return materialize(
        ordered.mapInArrow(_chained, f"conv_id {kind}, path binary, roles array<string>, texts array<string>"),
        "chat-conversations",
    )


@lru_cache(2)
def tokenizer(path: str):
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True  # their strings in a text are ordinary text
    return loaded


SPAN = "struct<start: int, end: int>"
PACK = (
    "ids array<int>, position_ids array<int>, "
    f"turns array<struct<start: int, end: int, parent: int, loss: {SPAN}, attends: array<{SPAN}>>>, "
    "conversations array<struct<conv_id: {kind}, turn: int>>"
)


class Pack:
    """A stretch of the depth-first walk; turns know their parent by its place in the pack."""

    def __init__(self):
        self.turns: list[tuple[int, str, str]] = []
        self.ends: list[tuple[object, int]] = []
        self.chars = 0
        self.path: list[bytes] = []
        self.places: list[int] = []

    def add(self, conv_id: object, path: list[bytes], roles: list[str], texts: list[str]) -> None:
        shared = 0
        while shared < min(len(path), len(self.path)) and path[shared] == self.path[shared]:
            shared += 1
        del self.places[shared:]
        for role, text in zip(roles[shared:], texts[shared:]):
            self.turns.append((self.places[-1] if self.places else -1, role, text))
            self.places.append(len(self.turns) - 1)
            self.chars += len(role) + len(text)
        self.path = path
        self.ends.append((conv_id, self.places[-1]))

    def row(self, model) -> dict:
        parts = [part for _, role, text in self.turns for part in (header(role), escape(text), CLOSE)]
        encoded = [e.ids for e in model.encode_batch_fast(parts, add_special_tokens=False)]
        ids: list[int] = []
        positions: list[int] = []
        turns: list[dict] = []
        reach: list[int] = []
        for place, (parent, role, _) in enumerate(self.turns):
            start = len(ids)
            before = 0 if parent < 0 else reach[parent]
            for part in encoded[3 * place:3 * place + 3]:
                ids += part
            end, opened = len(ids), len(encoded[3 * place])
            positions += range(before, before + end - start)
            reach.append(before + end - start)
            attends: list[dict] = []
            if parent >= 0:
                # What the parent attends to, then the parent; intervals that touch are one.
                attends = [dict(span) for span in turns[parent]["attends"]]
                own = {"start": turns[parent]["start"], "end": turns[parent]["end"]}
                if attends and attends[-1]["end"] == own["start"]:
                    attends[-1]["end"] = own["end"]
                else:
                    attends.append(own)
            loss = {"start": start + opened, "end": end - len(encoded[3 * place + 2])} if role == LEARNED_ROLE else None
            turns.append({"start": start, "end": end, "parent": parent, "loss": loss, "attends": attends})
        ends = [{"conv_id": conv_id, "turn": turn} for conv_id, turn in self.ends]
        return {"ids": ids, "position_ids": positions, "turns": turns, "conversations": ends}


def _packed(tokenizer_path: str, pack_chars: int, kind: pa.DataType):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(tokenizer_path)
        pack = Pack()
        for batch in batches:
            schema = pa.schema([
                ("ids", pa.list_(pa.int32())), ("position_ids", pa.list_(pa.int32())),
                ("turns", pa.list_(pa.struct([
                    ("start", pa.int32()), ("end", pa.int32()), ("parent", pa.int32()), ("loss", span), ("attends", pa.list_(span)),
                ]))),
                ("conversations", pa.list_(pa.struct([("conv_id", batch.schema.field(0).type), ("turn", pa.int32())]))),
            ])
            for at in range(batch.num_rows):
                conv_id, path, roles, texts = (batch.column(k)[at].as_py() for k in range(4))
                keys = [path[k:k + KEY_BYTES] for k in range(0, len(path), KEY_BYTES)]
                pack.add(conv_id, keys, roles, texts)
                if pack.chars >= pack_chars or len(pack.ends) >= PACK_CONVERSATIONS:
                    yield pa.RecordBatch.from_pylist([pack.row(model)], schema)
                    pack = Pack()
        if pack.ends:
            yield pa.RecordBatch.from_pylist([pack.row(model)], schema)

    return packed


def write(rows: DataFrame, path: str, tokenizer_path: str, pack_chars: int = PACK_CHARS) -> None:
    """Packs of all conversations in ``rows`` (``conv_id, turn, role, text`` are read), as Parquet at ``path``.

    One shuffle brings the turns of a conversation together, one sorts conversations by
    ranges of (digests, id): however many share their first turns, or all of them, they
    spread over as many tasks as the sizes ask for.  A tree is cut where a pack or a task's
    range ends, and the next pack starts with the turns it shares, so each pack
    can be used and read alone.  Memory: one pack and one conversation; in Spark's writer and reader one row group.

    Null text or role: empty; a null turn comes first; turns with equal numbers are all kept, by role and text;
    rows with a null id are one conversation.  Empty table: no packs.
    """
    held = conversations(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    parts = max(1, held.rdd.getNumPartitions())
    held.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(
        _packed(tokenizer_path, pack_chars, kind), PACK.format(kind=kind)
    ).write.options(**ROW_GROUPS).parquet(path)


def _spans(turns: list[dict], place: int) -> list[tuple[int, int]]:
    """The intervals of a pack that make up a conversation which ends at a turn."""
    last = turns[place]
    return [(s["start"], s["end"]) for s in last["attends"]] + [(last["start"], last["end"])]


def read_back(pack: dict, model) -> Iterator[tuple[object, str, str]]:
    """``conv_id``, the formatted conversation, and the text under its loss mask, of each conversation of a pack.

    Equal conversations end at the same turn and are read once.
    """
    ids, positions, turns = np.asarray(pack["ids"]), np.asarray(pack["position_ids"]), pack["turns"]
    learned: dict[int, str] = {}
    for place, ends in groupby(pack["conversations"], itemgetter("turn")):
        spans = [slice(*span) for span in _spans(turns, place)]
        own = np.concatenate([ids[span] for span in spans])
        if not np.array_equal(np.concatenate([positions[span] for span in spans]), np.arange(len(own))):
            raise ValueError("positions do not follow the conversation")
        parts = []
        while place >= 0:
            loss = turns[place]["loss"]
            if loss:
                if place not in learned:
                    loss_ids = ids[loss["start"]:loss["end"]].tolist()
                    learned[place] = unescape(model.decode(loss_ids, skip_special_tokens=False))
                parts.append(learned[place])
            place = turns[place]["parent"]
        formatted, text = model.decode(own.tolist(), skip_special_tokens=False), "".join(reversed(parts))
        for end in ends:
            yield end["conv_id"], formatted, text


def _digest(tokenizer_path: str):
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(tokenizer_path)
        for batch in batches:
            kind = batch.schema.field("conversations").type.value_type.field("conv_id").type
            for at in range(batch.num_rows):
                pack = {name: batch.column(name)[at].as_py() for name in ("turns", "conversations")}
                pack |= {name: batch.column(name)[at].values.to_numpy() for name in ("ids", "position_ids")}
                ids, rows = [], []
                for (formatted, learned), same in groupby(read_back(pack, model), itemgetter(1, 2)):
                    turns = parse(formatted)
                    row = (
                        len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)),
                        len(learned), sha(learned), len(formatted),
                    )
                    for conv_id, _, _ in same:
                        ids.append(conv_id)
                        rows.append(row)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, kind), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string()), pa.array(columns[4], pa.int64()),
                ], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return digest


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def digest(packs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation in the packs.

    A conversation is read back from its attention intervals, its positions are held against
    its order, and the template is undone; no shuffle.
    """
    kind = packs.schema["conversations"].dataType.elementType["conv_id"].dataType.simpleString()
    return packs.mapInArrow(
        _digest(tokenizer_path),
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def with_extra(rows: DataFrame) -> DataFrame:
    """The rows plus a conversation whose texts hold the template's own control strings."""
    extra = rows.sparkSession.createDataFrame(
        [(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    return rows.select("conv_id", "turn", "role", "text").union(extra)


def formatted(spark: SparkSession, rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """Packs of ``rows`` and the extra conversation, written to the shared folder and read back."""
    path = scratch_path(spark, "chat-packs")
    write(with_extra(rows), path, tokenizer_path)
    return digest(read(spark, path), tokenizer_path)


def _escape_sql(text: str) -> str:
    return rf"replace(replace(replace({text}, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>')"


CHAT_SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(role, '') AS r, coalesce(text, '') AS t FROM (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT {EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT {EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}')
),
sized AS (
    SELECT *, CASE WHEN r IN ('user', 'assistant', 'system') THEN length(r) + 6
        ELSE length(replace({_escape_sql("r")}, ':', '\:')) + 7 END + length({_escape_sql("t")}) + 8 AS chars
    FROM turns
),
joined AS (
    SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, t) AS whole,
        coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, t) FILTER (WHERE r = '{LEARNED_ROLE}'), '') AS learned,
        sum(chars)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars
FROM joined
"""
