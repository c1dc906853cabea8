"""Benchmark decontamination by a distributed positional inverted index.

The index is cut by document: each shard holds the postings of all words of its
documents, so no word, however frequent, is gathered from the corpus.  Searching
visits every shard with the test phrases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import content, pieces
from rowloom.plans.scratch import materialize

WINDOW = 13
#: Words of a shard, about; a longer document is a shard of its own.
SHARD_WORDS = 150_000
#: Test items are searched for in blocks of so many words; only one block is broadcast at a time.
QUERY_WORDS = 2_000_000
#: How far a word may be from its place in a proximity match.
SLOP = 2
#: A document is contaminated if a twentieth of its words is hit.
HIT_SHARE = 20

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b in _SEPARATORS else b for b in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


SHARD = (
    "doc_ids array<long>, contents array<long>, lengths array<int>, terms binary, counts binary, postings binary"
)


def _shard(doc_ids: list, contents: list, held: list[list[bytes]]) -> pa.RecordBatch:
    """Postings of the words of some documents: places counted through the shard, one place free after each document."""
    ids: dict[bytes, int] = {b"": 0}
    flat: list[int] = []
    for words in held:
        flat += [ids.setdefault(w, len(ids)) for w in words]
        flat.append(0)
    places = np.array(flat, np.int32)
    order = np.argsort(places, kind="stable").astype("<i4")
    counts = np.bincount(places, minlength=len(ids)).astype("<i4")
    return pa.RecordBatch.from_arrays([
        pa.array([doc_ids], pa.list_(pa.int64())), pa.array([contents], pa.list_(pa.int64())),
        pa.array([[len(w) for w in held]], pa.list_(pa.int32())),
        pa.array([b" ".join(ids)], pa.binary()), pa.array([counts.tobytes()], pa.binary()),
        pa.array([np.diff(order, prepend=np.int32(0)).astype("<i4").tobytes()], pa.binary()),
    ], names=[c.split()[0] for c in SHARD.split(", ")])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    doc_ids, contents, held, n = [], [], [], 0
    for batch in pieces(batches, 256):
        for doc_id, text, of_text in zip(*(c.to_pylist() for c in batch.columns)):
            words = item_words(text)
            doc_ids.append(doc_id)
            contents.append(of_text)
            held.append(words)
            n += len(words) + 1
            if n >= SHARD_WORDS:
                yield _shard(doc_ids, contents, held)
                doc_ids, contents, held, n = [], [], [], 0
    if doc_ids:
        yield _shard(doc_ids, contents, held)


def build(docs: DataFrame) -> DataFrame:
    """The positional index of all words of ``docs``, one row per shard, written to the shared folder."""
    return materialize(docs.select("doc_id", "text", content(docs).alias("content")).mapInArrow(_index, SHARD), "phrase-index")


class Phrases:
    """Test windows of one block of items: words numbered, windows as rows of numbers."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.ids: dict[bytes, int] = {}
        rows, self.items = {}, [item for item, _ in items]
        for index, (_, words) in enumerate(items):
            own = [self.ids.setdefault(w, len(self.ids)) for w in words]
            for start in range(max(1, len(own) - WINDOW + 1)):
                window = tuple(own[start:start + WINDOW])
                if window:
                    rows.setdefault(window, []).append(index)
        self.lengths = np.array([len(w) for w in rows], np.int64)
        self.owners = list(rows.values())
        # Places past the end of a short window point to a word that is always there.
        always = len(self.ids)
        self.windows = np.full((len(rows), WINDOW), always, np.int64)
        for index, window in enumerate(rows):
            self.windows[index, :len(window)] = window


def _near(sorted_places: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Which wanted places have a posting within ``slop``."""
    low = np.searchsorted(sorted_places, wanted - slop)
    return (low < len(sorted_places)) & (
        sorted_places[np.minimum(low, len(sorted_places) - 1)] <= wanted + slop
    )


def _search_shard(row: dict, phrases: Phrases, slop: int) -> Iterator[tuple]:
    lengths = np.array(row["lengths"], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    counts = np.frombuffer(row["counts"], "<i4").astype(np.int64)
    ends = np.cumsum(counts)
    postings = np.cumsum(np.frombuffer(row["postings"], "<i4"), dtype=np.int64)
    # Term 0 is the free place after a document; its name is empty.
    number = np.full(len(phrases.ids) + 1, -1, np.int64)
    for index, term in enumerate(row["terms"].split(b" ")):
        test = phrases.ids.get(term)
        if test is not None and index:
            number[test] = index
    found = np.where(number >= 0, counts[number], 0)
    found[-1] = 1 << 60
    tallies = found[phrases.windows]
    alive = np.flatnonzero(tallies.min(axis=1) > 0) if len(tallies) else []
    marks: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[int]] = {}
    close: dict[int, set[int]] = {}
    for w in alive:
        size = int(phrases.lengths[w])
        # Rarest word first: its postings, moved to the window's start, are narrowed by the others.
        order = np.argsort(tallies[w, :size], kind="stable")
        lists = {int(o): postings[ends[t] - counts[t]:ends[t]] for o in order if (t := number[phrases.windows[w, o]]) >= 0}
        rarest = int(order[0])
        near = lists[rarest] - rarest
        near = near[near >= 0]
        exact = near
        for offset in order[1:]:
            places = lists[int(offset)]
            near = near[_near(places, near + offset, slop)]
            exact = exact[_near(places, exact + offset, 0)]
            if not len(near):
                break
        for kind, hits in ((True, exact), (False, near)):
            docs = np.searchsorted(starts, hits, side="right") - 1
            inside = hits + size <= starts[docs] + lengths[docs]
            for doc, hit in zip(docs[inside].tolist(), hits[inside].tolist()):
                (items if kind else close).setdefault(doc, set()).update(phrases.owners[w])
                if kind:
                    begin = hit - int(starts[doc])
                    marks.setdefault(doc, []).append((begin, begin + size))
    for doc, doc_id in enumerate(row["doc_ids"]):
        met = {phrases.items[i] for i in items.get(doc, ())}
        nearly = {phrases.items[i] for i in close.get(doc, ())} - met
        yield doc_id, int(lengths[doc]), sorted(set(marks.get(doc, ()))), sorted(met), sorted(nearly)


HITS = (
    "shard string, doc int, doc_id long, content long, n_words long, "
    "marks array<struct<start: int, end: int>>, items array<string>, near array<string>"
)


def _search(block, slop: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(block.value)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for batch in pieces(batches, 1):
            for row in batch.to_pylist():
                found = list(_search_shard(row, phrases, slop))
                doc_id, n_words, marks, items, near = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * len(found), pa.string()),
                    pa.array(range(len(found)), pa.int32()),
                    pa.array(doc_id, pa.int64()), pa.array(row["contents"], pa.int64()), pa.array(n_words, pa.int64()),
                    pa.array([[{"start": a, "end": z} for a, z in m] for m in marks], pa.list_(span)),
                    pa.array(items, pa.list_(pa.string())), pa.array(near, pa.list_(pa.string())),
                ], names=["shard", "doc", "doc_id", "content", "n_words", "marks", "items", "near"])

    return run


def _query_blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Test items with their words, in blocks; an item longer than a block is one."""
    block, n = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    for row in rows.toLocalIterator():
        words = item_words(row["text"])
        if words:
            block.append((row["item"], words))
            n += len(words)
        if n >= QUERY_WORDS:
            yield block
            block, n = [], 0
    yield block


def search(index: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """``doc_id, content, n_words, marks, items, near`` for every document of the index.

    ``marks`` are the word ranges of exact window occurrences, ``items`` the ids
    of their test items, ``near`` those that only have a proximity match: every
    word of a window within ``slop`` of its place.  Test sets of any size are
    searched for block by block; the parts of a document's result meet by its
    place in the index, so equal or null document ids stay apart.  Items that
    share an id count once; null item ids count as an empty id; items without
    words match nothing.
    """
    spark = index.sparkSession
    named = index.select(
        F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("shard"), "*"
    )
    parts = [
        named.mapInArrow(_search(spark.sparkContext.broadcast(block), slop), HITS)
        for block in _query_blocks(benchmark)
    ]
    if len(parts) == 1:
        return parts[0].drop("shard", "doc")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return every.groupBy("shard", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.first("content").alias("content"), F.first("n_words").alias("n_words"),
        union("marks").alias("marks"), union("items").alias("items"), union("near").alias("near"),
    ).withColumn("near", F.array_except("near", "items")).drop("shard", "doc")


def covered(marks: Column) -> Column:
    """Words inside any of the ranges, which come sorted by start."""
    first = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))
    step = lambda s, m: F.struct(
        F.greatest(s["to"], m["end"]).alias("to"),
        (s["n"] + F.greatest(m["end"] - F.greatest(m["start"], s["to"]), F.lit(0))).alias("n"),
    )
    return F.aggregate(marks, first, step)["n"].cast("long")


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = search(build(docs), benchmark).withColumn("n_hit", covered(F.col("marks")))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts, items and verdict for every row of ``docs``; a null or empty text has no words and is clean."""
    return _judged(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        F.size("near").cast("long").alias("n_near"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, each judged by its own text, whatever ids they share."""
    bad = _judged(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("content").alias("_bad")
    ).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (content(docs) == F.col("_bad")), "left_anti")
