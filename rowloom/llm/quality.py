"""Quality classifier by co-training: a text view and a page-metadata view teach each other."""

from __future__ import annotations

import operator
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowloom.llm.common import bounded_sample, pieces
from rowloom.plans.scratch import materialize

#: Bound of the labelled documents that are learned from.  Unlabelled documents have none.
MAX_LABELLED = 8_000
ROUNDS = 4
#: How sure a view must be to give the other a pseudo-label, and how many of all such documents it gives in a round.
CONFIDENT = 0.97
PER_ROUND = 300
#: Buckets that words, runs of four bytes, sources and languages are hashed to.
WORD_BUCKETS, GRAM_BUCKETS, SOURCE_BUCKETS, LANG_BUCKETS = 128, 128, 16, 8
#: Bytes of a text whose runs are hashed at once.
BLOCK = 1 << 20
SEED = 9

_SYMBOLS = np.frombuffer(b"#$%&*@^~=<>{}[]\\/_+|", np.uint8)
FIGURES = 14
TEXT_FEATURES, META_FEATURES = FIGURES + WORD_BUCKETS + GRAM_BUCKETS, SOURCE_BUCKETS + LANG_BUCKETS


def content_shares(raw: bytes, own: list[bytes]) -> np.ndarray:
    """Square roots of the shares of hashed words, then of hashed runs of four bytes; A-Z count as a-z."""
    hashed = np.fromiter(map(zlib.crc32, own), np.int64, len(own))
    words = np.bincount(hashed % WORD_BUCKETS, minlength=WORD_BUCKETS) / len(own)
    low, grams = np.frombuffer(raw.lower(), np.uint8), np.zeros(GRAM_BUCKETS)
    for start in range(0, len(low) - 3, BLOCK):
        part = low[start:start + BLOCK + 3].astype(np.uint64)
        code = part[:-3] << 24 | part[1:-2] << 16 | part[2:-1] << 8 | part[3:]
        grams += np.bincount((code * 2_654_435_761 >> 20) % GRAM_BUCKETS, minlength=GRAM_BUCKETS)
    return np.sqrt(np.concatenate([words, grams / max(1, len(low) - 3)]))


def text_view(text: str | None) -> np.ndarray:
    """A whole text: its hashed words and runs of characters, and figures of its form.  Empty texts give zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    own = raw.lower().split()
    if not own:
        return np.zeros(TEXT_FEATURES)
    n, share = len(own), np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = sum(map(operator.eq, own, own[1:])) / n
    symbols = share[_SYMBOLS].sum()
    distinct = len(set(own)) / n
    figures = [
        1.0, np.log1p(n), sum(map(len, own)) / n, distinct, distinct * np.log1p(n), repeats, np.sqrt(repeats),
        symbols, np.sqrt(symbols), share[48:58].sum(), share[65:91].sum(),
        len(set(lines)) / len(lines), len(lines) / n, share[[33, 63, 46, 44, 59]].sum(),
    ]
    return np.concatenate([figures, content_shares(raw, own)])


def meta_view(lang: str | None, source: str | None) -> np.ndarray:
    """Language and source as hashed marks; nulls count as values of their own.  Nothing of the text is in it."""
    out = np.zeros(META_FEATURES)
    out[xxhash.xxh32_intdigest(str(source)) % SOURCE_BUCKETS] = 1.0
    out[SOURCE_BUCKETS + xxhash.xxh32_intdigest(str(lang)) % LANG_BUCKETS] = 1.0
    return out


def _views(batch: pa.RecordBatch) -> np.ndarray:
    """Both views of each row, side by side, as half-precision numbers."""
    columns = [batch.column(c).to_pylist() for c in ("text", "lang", "source")]
    rows = [np.concatenate([text_view(t), meta_view(*m)]) for t, *m in zip(*columns)]
    return np.minimum(np.array(rows).reshape(-1, TEXT_FEATURES + META_FEATURES), 6e4).astype(np.float16)


def _unpacked(views: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(views), np.float16).reshape(-1, TEXT_FEATURES + META_FEATURES).astype(float)


@dataclass
class Logistic:
    """Logistic regression on standardized features, fitted by Newton's method with a ridge."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        weights = np.zeros(z.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
            gradient = z.T @ (p - y) + ridge * weights
            curve = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(z.shape[1])
            step = np.linalg.solve(curve, gradient)
            weights -= step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, weights)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass
class CoTrained:
    """The two views, and the calibrated combination of their logits (none before they are combined)."""

    text: Logistic
    meta: Logistic
    combined: Logistic | None = None

    def logits(self, views: np.ndarray) -> np.ndarray:
        return np.column_stack([self.text.logit(views[:, :TEXT_FEATURES]), self.meta.logit(views[:, TEXT_FEATURES:])])

    def score(self, views: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality: both views together, text alone, metadata alone."""
        single = self.logits(views)
        every = np.column_stack([self.combined.logit(single), single])
        return tuple((1 / (1 + np.exp(-every))).T)


#: Confident documents of a round: by the view that is sure of them, their views and pseudo-labels.
Taught = dict[str, tuple[np.ndarray, np.ndarray]]


def co_train(views: np.ndarray, y: np.ndarray, pool: Callable[[CoTrained, int], Taught]) -> CoTrained:
    """Rounds of confident pseudo-labels from each view to the other; a third of the labels calibrates the sum.

    ``pool`` gives, for the models of a round, the documents that each view is sure of.
    """
    held = np.arange(len(y)) % 3 == 0
    none = (np.zeros((0, views.shape[1])), np.zeros(0))
    taught: Taught = {"text": none, "meta": none}
    for number in range(ROUNDS):
        by_text, by_meta = taught["text"], taught["meta"]
        text = np.vstack([views[~held], by_meta[0]])[:, :TEXT_FEATURES]
        meta = np.vstack([views[~held], by_text[0]])[:, TEXT_FEATURES:]
        models = CoTrained(
            Logistic.fit(text, np.concatenate([y[~held], by_meta[1]]), ridge=5.0),
            Logistic.fit(meta, np.concatenate([y[~held], by_text[1]])),
        )
        if number + 1 < ROUNDS:
            taught = pool(models, number)
    return CoTrained(models.text, models.meta, Logistic.fit(models.logits(views[held]), y[held]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256):
        packed = pa.array([row.tobytes() for row in _views(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), packed], names=["id", "key", "views"])


def features(docs: DataFrame) -> DataFrame:
    """``id, key, views`` of every document: the id as text, a hash of id and content, both views packed."""
    key = F.xxhash64("doc_id", "text", "lang", "source")
    own = docs.select(F.col("doc_id").cast("string").alias("id"), key.alias("key"), "text", "lang", "source")
    return own.mapInArrow(_features, "id string, key long, views binary")


def _sureness(models: CoTrained) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            p = 1 / (1 + np.exp(-models.logits(_unpacked(batch.column("views").to_pylist()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(p[:, 0]), pa.array(p[:, 1])],
                names=["id", "key", "text", "meta"],
            )

    return run


def sure_of(rows: DataFrame, known: DataFrame, models: CoTrained, number: int) -> Taught:
    """What each view can teach the other: ``PER_ROUND`` documents drawn by lot from all unlabelled ones it is sure of.

    Every unlabelled document is scored.  Equal documents count once, and null ids are
    no labels' ids, so no key of a join or group is hot.
    """
    spread = F.coalesce("id", F.concat(F.lit("null:"), F.col("key").cast("string")))
    marks = rows.mapInArrow(_sureness(models), "id string, key long, text double, meta double").groupBy("key", "id").agg(
        F.max("text").alias("text"), F.max("meta").alias("meta")
    ).withColumn("_id", spread).join(known.select(F.col("id").alias("_id")), "_id", "left_anti")
    marks = materialize(marks, "quality-sureness")
    chosen = None
    for view in ("text", "meta"):
        sure = marks.where(F.greatest(F.col(view), 1 - F.col(view)) >= CONFIDENT)
        drawn = bounded_sample(sure, F.col("key"), PER_ROUND, SEED + number).select(
            "key", F.lit(view).alias("view"), (F.col(view) > 0.5).cast("double").alias("mark")
        )
        chosen = drawn if chosen is None else chosen.unionByName(drawn)
    # At most 2 * PER_ROUND keys.
    met = rows.select("key", "views").join(F.broadcast(chosen), "key").groupBy("key", "view").agg(
        F.min("views").alias("views"), F.min("mark").alias("mark")
    )
    got = sorted(met.collect(), key=lambda r: r["key"])
    return {
        view: (
            _unpacked([r["views"] for r in got if r["view"] == view]),
            np.array([r["mark"] for r in got if r["view"] == view], float),
        )
        for view in ("text", "meta")
    }


def learn(docs: DataFrame, labels: DataFrame) -> CoTrained | None:
    """A model from a bounded sample of labelled and from all unlabelled documents; None without labels of both kinds.

    Of repeated or conflicting labels of a document the lowest counts; null labels count as none.
    Of labelled documents that share an id the one of the lowest content hash counts.
    Runs its jobs before it returns.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("string").alias("id")
    ).agg(F.min("quality").cast("int").alias("quality"))
    marked = bounded_sample(known, F.col("id"), MAX_LABELLED, SEED)
    rows = materialize(features(docs), "quality-features")
    # At most MAX_LABELLED ids, and as many rows.
    own = rows.join(F.broadcast(marked), "id").groupBy("id").agg(
        F.min_by("views", "key").alias("views"), F.min("quality").alias("quality")
    ).collect()
    own = sorted(own, key=lambda r: r["id"])
    y = np.array([float(r["quality"] > 0) for r in own])
    if not len(y) or y.min() == y.max():
        return None
    shuffled = np.random.default_rng(SEED).permutation(len(own))
    return co_train(
        _unpacked([r["views"] for r in own])[shuffled], y[shuffled],
        lambda models, number: sure_of(rows, known, models, number),
    )


def _scores(model: CoTrained | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            every = model.score(_views(batch).astype(float)) if model else (np.ones(batch.num_rows),) * 3
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v, pa.float64()) for v in every)],
                names=[*batch.schema.names, "_score", "_text_score", "_meta_score"],
            )

    return run


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``_score, _text_score, _meta_score``, the probabilities of good quality.

    After learning, one pass over the texts and no shuffle.  Null or empty texts score like
    texts of no words; rows are independent of each other, so null or repeated ids
    change nothing.  Where nothing can be learned every document scores 1.
    """
    ddl = StructType(list(docs.schema.fields))
    for name in ("_score", "_text_score", "_meta_score"):
        ddl = ddl.add(name, "double")
    return docs.mapInArrow(_scores(learn(docs, labels)), ddl)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, text_score, meta_score, accepted`` of every document."""
    own = docs.select("doc_id", "text", "lang", "source")
    return scored(own, labels).select(
        "doc_id", F.col("_score").alias("score"), F.col("_text_score").alias("text_score"),
        F.col("_meta_score").alias("meta_score"), (F.col("_score") >= 0.5).alias("accepted"),
    )


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    return scored(docs, labels).where("_score >= 0.5").select(*docs.columns)
