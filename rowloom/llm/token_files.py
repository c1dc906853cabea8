"""Token ids in Simple-8b blocks: encode texts, write them in document order, read them back."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm.common import pieces

END_ID = 0
#: A block is closed at so many ids; a longer document is a block of its own.
BLOCK_IDS = 32_768
#: Chunks of text whose ids a Python worker remembers, in each of two generations.
CACHE_CHUNKS = 500_000

# Ids per word and bits per id of each selector.  Selector 0 marks
# an id of more than 60 bits; its word holds the id's place among the escapes.
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
PAYLOAD = np.uint64((1 << 60) - 1)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of unsigned ids, and the ids that escaped.

    For every place and selector it is first found out whether the next ids
    fit, with running counts; then the words are a chain of jumps.  Past
    the end ids count as 0: the reader knows how many there are.
    """
    values = ids.astype(np.uint64)
    n = len(values)
    large = values > PAYLOAD
    escapes = values[large]
    # Ids of 32 bits, the usual case, are compared as such.
    compared = values.astype(np.uint32) if n and values.max() < 1 << 32 else values
    chosen = np.zeros(n, np.uint8)
    misfits = np.zeros(n + max(COUNTS) + 1, np.int32)
    for selector in range(len(COUNTS) - 1, 0, -1):
        count, width = COUNTS[selector], WIDTHS[selector]
        if compared.dtype == np.uint32 and width >= 32:
            wide = np.zeros(n, bool)
        else:
            wide = compared >= compared.dtype.type(1 << width)
        if n - np.count_nonzero(wide) < min(count, n):
            continue
        np.cumsum(wide, out=misfits[1:n + 1])
        misfits[n + 1:] = misfits[n]
        np.copyto(chosen, selector, where=misfits[count:count + n] == misfits[:n])
    places, at, jumps = [], 0, np.array(COUNTS, np.uint8)[chosen].tolist()
    while at < n:
        places.append(at)
        at += jumps[at]
    starts = np.array(places, np.int64)
    selectors = chosen[starts]
    words = selectors.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate((np.where(large, 0, values), np.zeros(max(COUNTS), np.uint64)))
    for selector in range(1, len(COUNTS)):
        own = np.flatnonzero(selectors == selector)
        if len(own):
            lanes = np.arange(COUNTS[selector])
            taken = padded[starts[own][:, None] + lanes] << (lanes * WIDTHS[selector]).astype(np.uint64)
            words[own] |= np.bitwise_or.reduce(taken, axis=1)
    words[selectors == 0] |= np.arange(len(escapes), dtype=np.uint64)
    return words, escapes


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block, one vector step per selector."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(np.array(COUNTS)[selectors])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for selector in np.unique(selectors):
        own = np.flatnonzero(selectors == selector)
        count, width = COUNTS[selector], WIDTHS[selector]
        data = words[own] & PAYLOAD
        if selector == 0:
            out[ends[own] - 1] = escapes[data.astype(np.int64)]
            continue
        lanes = np.arange(count)
        values = (data[:, None] >> (lanes * width).astype(np.uint64)) & np.uint64((1 << width) - 1)
        out[(ends[own] - count)[:, None] + lanes] = values
    return out[:n]


#: The word pattern of this byte-level vocabulary, a fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Remembered(dict):
    """Ids of chunks, made by ``make`` when they are first asked for."""

    def __init__(self, make: Callable[[str], bytes | bool]):
        super().__init__()
        self.make = make

    def __missing__(self, chunk: str) -> bytes | bool:
        ids = self[chunk] = self.make(chunk)
        return ids


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, remembering those of space-separated chunks.

    A byte-level vocabulary never joins across a single space, so a
    text's ids are those of its chunks.  Texts where that may not hold (white
    space after a space, special tokens) are encoded whole.  ``remembered`` chunks make a generation.
    """

    def __init__(self, path: str, remembered: int = CACHE_CHUNKS):
        import regex
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words = regex.compile(WORD_PATTERN).findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        self.letters = {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}
        self.cache = Remembered(self.chunk)
        self.older: dict[str, bytes | bool] = {}
        self.parts: dict[str, bytes] = {}
        self.marks = {mark: self.word(mark) for mark in ".,;:"}

    def word(self, word: str) -> bytes:
        """Ids of one word of the pattern."""
        plain = word[1:] if word[0] == " " else word
        if plain.isalpha() and plain.isascii():  # letters that stand for themselves
            letters = self.letters[32] + plain if word[0] == " " else plain
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def part(self, word: str) -> bytes:
        """Ids of a word that is part of a chunk; such words come again in other chunks."""
        ids = self.cache.get(word[1:]) if word[0] == " " and word[1:].isalpha() else self.parts.get(word)
        if ids is None:
            ids = self.parts[word] = self.parts.get(word) or self.word(word)
        return ids

    def chunk(self, chunk: str) -> bytes | bool:
        """Ids of a chunk with a space before it; False where unsafe.

        Chunks of letters, alone or with a mark after them, need no pattern.
        """
        ids = self.older.get(chunk)
        if ids is not None:
            return ids
        if chunk.isalpha():
            if chunk.isascii():
                return array("I", [token.id for token in self.model.tokenize(self.letters[32] + chunk)]).tobytes()
            return self.word(" " + chunk)
        if not chunk or chunk[0].isspace():
            return False
        if chunk[-1] in self.marks and chunk[:-1].isalpha():
            return self.cache[chunk[:-1]] + self.marks[chunk[-1]]
        return b"".join(map(self.part, self.words(" " + chunk)))

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.remembered:
            # What was used since the last change stays, what was not goes.
            self.cache, self.older = Remembered(self.chunk), self.cache
        if len(self.parts) > self.remembered:
            self.parts = {}
        known, out = self.cache.__getitem__, []
        for text in texts:
            if any(mark in text for mark in self.special):
                out.append(self.encode_whole(text))
                continue
            first, *rest = text.split(" ")
            try:
                out.append(self.encode_whole(first) + b"".join(map(known, rest)))
            except TypeError:  # a chunk is unsafe
                out.append(self.encode_whole(text))
        return out


@lru_cache(1)
def encoder(path: str, remembered: int = CACHE_CHUNKS) -> Encoder:
    """The encoder of this Python worker; what it remembers serves its later tasks too."""
    return Encoder(path, remembered)


BLOCK = (
    "part int, first long, n_ids int, doc_ids array<long>, counts array<int>, words binary, escapes binary"
)


def _blocks(
    path: str, end_id: int, remembered: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path, remembered), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        first, n, doc_ids, counts, held = 0, 0, [], [], []

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            words, escapes = pack(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int32()),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int32())),
                pa.array([words.astype("<u8").tobytes()], pa.binary()),
                pa.array([escapes.astype("<u8").tobytes()], pa.binary()),
            ], names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in pieces(batches, 128):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                doc_ids.append(doc_id)
                counts.append(len(ids) // 4 + 1)
                held += (ids, end)
                n += counts[-1]
                if n >= BLOCK_IDS:
                    yield block()
                    first, n = first + n, 0
                    doc_ids, counts, held = [], [], []
        if doc_ids:
            yield block()

    return run


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, remembered: int = CACHE_CHUNKS
) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending document order.

    A file holds a range of documents as blocks; files follow each other in
    order of ``part``, blocks in order of ``first``, the ids before them in
    their file.  Null ids come first; rows with equal ids follow by text, and are
    spread over files by it.  Null texts count as empty: the end id only.
    An empty table gives no blocks.  Of the chunks of text that a Python worker remembers, ``remembered`` make a
    generation: fewer take less memory and more time, the ids are the same.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_tie"))
    ranged = keyed.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    ranged.select("doc_id", "text").mapInArrow(_blocks(tokenizer, end_id, remembered), BLOCK).write.parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 8):
        out: list[tuple] = []
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], "<u8"), row["n_ids"])
            data, at = ids.astype("<u4").tobytes(), 0
            for doc_id, count in zip(row["doc_ids"], row["counts"]):
                own = data[4 * at:4 * (at + count)]
                out.append((row["part"], row["first"] + at, doc_id, count, own))
                at += count
        part, start, doc_id, count, own = zip(*out) if out else ([],) * 5
        yield pa.RecordBatch.from_arrays([
            pa.array(part, pa.int32()), pa.array(start, pa.int64()), pa.array(doc_id, pa.int64()),
            pa.array(count, pa.int64()), pa.array(own, pa.binary()),
        ], names=["part", "start", "doc_id", "n_tokens", "ids"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files; ``ids`` are 32-bit little-endian.

    The ids before each file are summed from one number per file, which
    bounds the window and the broadcast by the number of files.
    """
    blocks = spark.read.schema(BLOCK).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    decoded = blocks.mapInArrow(_decode, "part int, start long, doc_id long, n_tokens long, ids binary")
    return decoded.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids"
    )


def digest(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
