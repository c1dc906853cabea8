"""Importance resampling towards a target distribution.

An untrained ``Split`` pre-tokenizer cuts lower-cased text into words with
offsets; windows of offset pairs are the features, counted in buckets by crc32.
A document weighs the mean gain of its buckets, and seeded Gumbel noise on
top of the weights draws without replacement.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import pieces
from rowloom.llm.spelling_groups import CRC_TABLE_SQL, crc_sql
from rowloom.plans.scratch import materialize

GAP_PATTERN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LONGEST_RUN = 1
MIN_WORDS = 20
DRAWN_PERCENT = 10
SEED = 2024
#: A long text is handed to the pre-tokenizer in pieces of about so many characters, cut between words.
PIECE_CHARS = 2_048

_GAP = re.compile(GAP_PATTERN)


@lru_cache(1)
def splitter():
    """The pre-tokenizer of this Python worker: what lies between words is removed."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(GAP_PATTERN), behavior="removed")


def pieces_of(text: str) -> Iterator[tuple[int, str]]:
    """A text in pieces that end between words, with their starts."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > PIECE_CHARS:
            gap = _GAP.search(text, start + PIECE_CHARS)
            end = gap.end() if gap else end
        yield start, text[start:end]
        start = end


def word_offsets(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words of a lower-cased text and their places in it."""
    words: list[str] = []
    places: list[tuple[int, int]] = []
    split = splitter().pre_tokenize_str
    for start, piece in pieces_of(text):
        found = split(piece)
        words += [word for word, _ in found]
        places += [(start + a, start + b) for _, (a, b) in found] if start else [place for _, place in found]
    return words, places


class Buckets(dict):
    """Buckets of features seen before, emptied when it holds too many."""

    LIMIT = 400_000

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) % self.buckets
        return found


@lru_cache(4)
def bucket_of(buckets: int) -> Buckets:
    return Buckets(buckets)


def feature_buckets(text: str | None, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of 1 to ``longest`` words joined by one space."""
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    bucket, split = bucket_of(buckets), splitter().pre_tokenize_str
    if longest == 1:
        # Each window is one word, so a piece is counted while it is at hand.
        found = [np.array([bucket[word] for word, _ in split(piece)], "<u4") for _, piece in pieces_of(lowered)]
        joined = np.concatenate(found) if found else np.zeros(0, "<u4")
        return len(joined), joined
    words, places = word_offsets(lowered)
    found = [bucket[word] for word in words]
    for run in range(2, longest + 1):
        for i in range(len(words) - run + 1):
            start, end = places[i][0], places[i + run - 1][1]
            feature = lowered[start:end]
            # The window is the feature itself where single spaces lie between its words.
            if _GAP.findall(feature) != [" "] * (run - 1):
                feature = " ".join(words[i:i + run])
            found.append(bucket[feature])
    return len(words), np.array(found, "<u4")


def _features(longest: int, buckets: int, id_type: pa.DataType):
    narrow = "<u2" if buckets <= 1 << 16 else "<u4"

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            made = [feature_buckets(text, longest, buckets) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n for n, _ in made], pa.int64()),
                pa.array([len(b) for _, b in made], pa.int64()),
                pa.array([b.astype(narrow).tobytes() for _, b in made], pa.binary()),
            ], names=["doc_id", "n_words", "n_features", "buckets"])

    return features


def featured(texts: DataFrame, key: str, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, buckets``: each text's features as numbers, 2 or 4 bytes each, written once."""
    kind = texts.schema[key].dataType.simpleString()
    return materialize(
        texts.select(F.col(key).alias("doc_id"), "text").mapInArrow(
            _features(longest, buckets, kind), f"doc_id {kind}, n_words long, n_features long, buckets binary"
        ),
        "resampling-features",
    )


def histogram(table: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of a table in each bucket; one dense histogram in each task, at most ``buckets`` rows to the driver."""
    narrow = "<u2" if buckets <= 1 << 16 else "<u4"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), narrow), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    rows = table.select("buckets").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in rows.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored."""
    size = len(source)
    s_all, t_all = int(source.sum()) + size, int(target.sum()) + size
    return np.array([
        math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def _weights(gain: np.ndarray):
    narrow = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.frombuffer(b.as_buffer(), narrow) for b in batch.column(3)]
            weights = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return weigh


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Seeded Gumbel noise in thousandths, floored: the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _threshold(scores: DataFrame, drawn: int) -> int | None:
    """The score of the ``drawn``-th highest row, from counts of 256 scores each and then of single scores."""

    def highest(rows: DataFrame, key: Column, skipped: int) -> tuple[int, int]:
        for row in sorted(rows.groupBy(key.alias("key")).count().collect(), key=lambda r: -r["key"]):
            if skipped + row["count"] >= drawn:
                return row["key"], skipped
            skipped += row["count"]
        raise ValueError("fewer rows than are to be drawn")

    if not drawn:
        return None
    block = F.floor(F.col("score") / 256)
    chosen, skipped = highest(scores, block, 0)
    return highest(scores.where(block == chosen), F.col("score"), skipped)[0]


def resample(
    docs: DataFrame, target: DataFrame, target_key: str = "item_id", longest: int = LONGEST_RUN,
    buckets: int = BUCKETS, percent: int = DRAWN_PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for each row of ``docs`` (``doc_id, text`` are read).

    Texts are tokenized once; their buckets (2 bytes a word) are written and read twice: for the
    histogram and for the weights.  Scores are whole numbers within some tens of thousands,
    so the score of the last drawn row comes from two small counts; only rows from
    there on are put in order, by ranges of (score, id), and ranked by the
    sizes of the ranges before theirs.  No window spans the table.

    Null or empty text: no features, weight 0, never drawn.  Null id: hashed as empty text, last among
    ties.  Repeated rows count again and have ranks of their own.  Empty ``docs``: no rows; empty ``target``:
    gains from the source alone.  Runs its jobs before it returns.
    """
    table = featured(docs, "doc_id", longest, buckets)
    gain = gains(histogram(table, buckets), histogram(featured(target, target_key, longest, buckets), buckets))
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = table.mapInArrow(_weights(gain), f"doc_id {kind}, n_words long, n_features long, weight long")
    scored = materialize(
        weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resampling-scores"
    )
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = percent * eligible.count() // 100
    least = _threshold(eligible, drawn)
    high = F.lit(False) if least is None else (F.col("n_words") >= min_words) & (F.col("score") >= least)
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight"]
    parts = scored.rdd.getNumPartitions()
    placed = materialize(
        scored.where(high).repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
            *columns, F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        ),
        "resampling-order",
    )
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    starts_table = docs.sparkSession.createDataFrame(starts, "part int, before long")
    ranked = placed.join(F.broadcast(starts_table), "part").withColumn("rank", F.col("before") + F.col("place") + 1)
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        scored.where(~high).select(*columns, F.lit(None).cast("long").alias("rank"))
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(name: str) -> str:
    # Zero bytes become spaces, as patterns end at them in this engine.
    text = f"translate(replace(coalesce(text, ''), chr(0), ' '), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({text}, '[^\x01-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {name}"


RESAMPLING_SQL = rf"""
WITH crc AS ({CRC_TABLE_SQL}),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql("documents")}),
items AS (SELECT {_words_sql("benchmark")}),
occurring AS (SELECT DISTINCT unnest(words) AS word FROM (SELECT words FROM docs UNION ALL SELECT words FROM items)),
bucketed AS (SELECT word, ({crc_sql("word")} % {BUCKETS})::BIGINT AS bucket FROM occurring, crc),
source AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(words) AS word FROM docs) JOIN bucketed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(words) AS word FROM items) JOIN bucketed USING (word) GROUP BY bucket),
gains AS (
    SELECT b AS bucket, floor(1000 * ln(
        (coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM source) + {BUCKETS})::DOUBLE
        / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM target) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM range({BUCKETS}) AS all_buckets(b) LEFT JOIN source s ON s.bucket = b LEFT JOIN target t ON t.bucket = b
),
sums AS (
    SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM (SELECT r, unnest(words) AS word FROM docs) JOIN bucketed USING (word) JOIN gains USING (bucket) GROUP BY r
),
scored AS (
    SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM docs LEFT JOIN sums USING (r)
),
ranked AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n
    FROM scored WHERE n_features >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {DRAWN_PERCENT} * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
