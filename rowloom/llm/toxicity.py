"""Toxic spans by a linear-chain conditional random field; its marginals add up to a score of the document."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import bounded_sample, pieces, remainder
from rowloom.llm.phrase_index import item_words
from rowloom.llm.quality import Logistic

#: Bound of the labelled documents that are learned from, and of the token windows taken from each.
MAX_LABELLED = 6_000
WINDOWS = 2
WINDOW = 24
#: A feature marks toxic tokens if it occurs in so many toxic documents and is so many times as
#: frequent in them as in clean ones; at most so many candidates are considered.
MIN_DOCS, MIN_RATIO, MAX_CANDIDATES = 3, 30.0, 4_000
FOLDS, HELD_OUT = 5, 0
STEPS = 50
SEED = 3
#: Tokens of a block in the forward-backward scan, and words whose weight a task remembers.
BLOCK, CACHE_WORDS = 64, 300_000

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def word_features(word: bytes) -> list[bytes]:
    """Identity, beginnings and end of a token."""
    out = [b"w=" + word]
    out += [b"p%d=%s" % (k, word[:k]) for k in (3, 4, 5) if len(word) > k]
    return [*out, b"s3=" + word[-3:]]


@dataclass
class Field:
    """Weights of the field: features of state 1 against state 0, and transitions from a state to a state."""

    weights: dict[bytes, float]
    bias: float
    moves: np.ndarray

    def emission(self, word: bytes) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in word_features(word))


def marginals(emissions: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward odds, backward odds and emission factors of equally long chains, one per row.

    Odds are of state 1 against state 0: each step is a fraction of linear
    terms in the odds before, so no logarithms of sums are needed.
    """
    t = np.exp(moves)
    e = np.exp(np.clip(emissions, -30, 30))
    forward, backward = np.empty_like(e), np.ones_like(e)
    odds = np.ones(len(e))
    for k in range(e.shape[1]):
        odds = e[:, k] * (t[1, 1] * odds + t[0, 1]) / (t[1, 0] * odds + t[0, 0]) if k else e[:, 0]
        forward[:, k] = odds
    for k in range(e.shape[1] - 2, -1, -1):
        after = e[:, k + 1] * backward[:, k + 1]
        backward[:, k] = (t[1, 1] * after + t[1, 0]) / (t[0, 1] * after + t[0, 0])
    return forward, backward, e


def fit(windows: list[list[bytes]], tags: list[list[int]]) -> Field:
    """Maximum likelihood with a small penalty: gradients are observed less expected counts.

    Windows are filled up with tokens that are known to be in state 0.
    """
    ids: dict[bytes, int] = {b"": 0}
    words = np.array([[ids.setdefault(w, len(ids)) for w in [*own, *[b""] * (WINDOW - len(own))]] for own in windows])
    y = np.array([[*own, *[0] * (WINDOW - len(own))] for own in tags], float)
    names: dict[bytes, int] = {}
    pairs = [(w, names.setdefault(f, len(names))) for word, w in ids.items() for f in word_features(word)]
    of_word, feature = np.array(pairs).T
    theta = np.zeros(len(names) + 1 + 4)
    theta[len(names)] = -2.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n = y.size
    for step in range(1, STEPS + 1):
        weights, bias, moves = theta[:len(names)], theta[len(names)], theta[len(names) + 1:].reshape(2, 2)
        own = np.bincount(of_word, weights[feature], minlength=len(ids)) + bias
        forward, backward, e = marginals(own[words], moves)
        p = forward * backward / (1 + forward * backward)
        by_word = np.bincount(words.ravel(), (p - y).ravel(), minlength=len(ids))
        before, after = forward[:, :-1], e[:, 1:] * backward[:, 1:]
        t = np.exp(moves)
        joint = np.stack([np.full_like(before, t[0, 0]), t[0, 1] * after, t[1, 0] * before, t[1, 1] * before * after])
        joint /= joint.sum(axis=0)
        left, right = y[:, :-1], y[:, 1:]
        seen = np.array([((1 - left) * (1 - right)).sum(), ((1 - left) * right).sum(), (left * (1 - right)).sum(), (left * right).sum()])
        gradient = np.concatenate([
            np.bincount(feature, by_word[of_word], minlength=len(names)), [(p - y).sum()], joint.sum(axis=(1, 2)) - seen,
        ]) / n + 1e-6 * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        rate = 0.3 if step < STEPS // 2 else 0.1
        theta -= rate * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
    return Field(
        {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 1e-2}, float(theta[len(names)]),
        theta[len(names) + 1:].reshape(2, 2),
    )


def long_marginals(emissions: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Marginals of state 1 for chains of any length, many at once.

    Chains are cut into blocks.  A step is a 2x2 matrix acting on odds; the
    products of a block's matrices are made for all blocks together, then odds
    at block borders follow one after the other, then all blocks are filled in.
    """
    lengths = np.array([len(e) for e in emissions])
    blocks = -(-lengths // BLOCK)
    ends = np.cumsum(blocks)
    total = int(blocks.sum())
    if not total:
        return [np.zeros(0) for _ in emissions]
    t = np.exp(moves)
    e = np.ones((total, BLOCK))
    inside = np.zeros((total, BLOCK), bool)
    for own, end, n in zip(emissions, ends, blocks):
        flat = e[end - n:end].reshape(-1)
        flat[:len(own)] = np.exp(np.clip(own, -30, 30))
        inside[end - n:end].reshape(-1)[:len(own)] = True

    def scan(a, b, c, d, starts, ids, back):
        """Odds before each step, going through the columns in order."""
        columns = range(BLOCK - 1, -1, -1) if back else range(BLOCK)
        p, q, r, s = np.ones(total), np.zeros(total), np.zeros(total), np.ones(total)
        for k in columns:
            p, q, r, s = (a[:, k] * p + b[:, k] * r, a[:, k] * q + b[:, k] * s,
                          c[:, k] * p + d[:, k] * r, c[:, k] * q + d[:, k] * s)
            size = p + q + r + s
            p, q, r, s = p / size, q / size, r / size, s / size
        odds = np.empty(total)
        for chain in ids:
            value = starts
            for k in chain:
                odds[k] = value
                value = (p[k] * value + q[k]) / (r[k] * value + s[k])
        out = np.empty((total, BLOCK))
        for k in columns:
            out[:, k] = odds
            odds = (a[:, k] * odds + b[:, k]) / (c[:, k] * odds + d[:, k])
        return out

    one, zero = np.ones_like(e), np.zeros_like(e)
    chains = [range(end - n, end) for end, n in zip(ends.tolist(), blocks.tolist())]
    # Forward: odds after a step; the first step of a chain has no move before it.
    a, b = np.where(inside, e * t[1, 1], one), np.where(inside, e * t[0, 1], zero)
    c, d = np.where(inside, t[1, 0], zero), np.where(inside, t[0, 0], one)
    heads = (ends - blocks)[blocks > 0]
    a[heads, 0], b[heads, 0], c[heads, 0], d[heads, 0] = 0.0, e[heads, 0], 0.0, 1.0
    before = scan(a, b, c, d, 1.0, chains, False)
    forward = (a * before + b) / (c * before + d)
    # Backward: a step takes the odds behind a token to those before it.
    a, b = np.where(inside, e * t[1, 1], one), np.where(inside, t[1, 0], zero)
    c, d = np.where(inside, e * t[0, 1], zero), np.where(inside, t[0, 0], one)
    behind = scan(a, b, c, d, 1.0, [reversed(chain) for chain in chains], True)
    p = forward * behind / (1 + forward * behind)
    return [p[end - n:end].reshape(-1)[:length] for end, n, length in zip(ends, blocks, lengths)]


def _tagged(batch: pa.RecordBatch, field: Field, cache: dict) -> list[tuple[list[bytes], np.ndarray]]:
    every = [item_words(text) for text in batch.column("text").to_pylist()]
    if len(cache) > CACHE_WORDS:
        cache.clear()
    for word in set().union(*every).difference(cache):
        cache[word] = field.emission(word)
    emissions = [np.fromiter(map(cache.__getitem__, own), float, len(own)) for own in every]
    return list(zip(every, long_marginals(emissions, field.moves)))


def _sums(p: np.ndarray) -> list[float]:
    """What a document's marginals add up to: the logit of the surest token, and the expected toxic tokens."""
    if not len(p):
        return [-12.0, -12.0]
    top = float(np.clip(p.max(), 6e-6, 1 - 6e-6))
    return [float(np.log(top / (1 - top))), float(np.log(p.sum() + 6e-6))]


def spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens that are likelier toxic than not: code points from ``start`` to before ``end``."""
    out: list[dict] = []
    if not (p >= 0.5).any():
        return out
    last = -2
    for k, match in enumerate(TOKEN.finditer(text)):
        if p[k] >= 0.5:
            if last == k - 1:
                out[-1]["end"] = match.end()
                out[-1]["p"] = max(out[-1]["p"], float(p[k]))
            else:
                out.append({"start": match.start(), "end": match.end(), "p": float(p[k])})
            last = k
    return out


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])


def _score(field: Field | None, scale: Logistic | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, float] = {}
        for batch in pieces(batches, 256):
            texts = batch.column("text").to_pylist()
            if field is None:
                sums, found, score = [[-12.0, -12.0]] * len(texts), [[]] * len(texts), np.zeros(len(texts))
            else:
                tagged = _tagged(batch, field, cache)
                sums = [_sums(p) for _, p in tagged]
                found = [spans(text or "", p) for text, (_, p) in zip(texts, tagged)]
                score = 1 / (1 + np.exp(-scale.logit(np.array(sums).reshape(-1, 2)))) if scale else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sums, pa.list_(pa.float64())), pa.array(score, pa.float64()),
                pa.array(found, pa.list_(SPAN)),
            ], names=["doc_id", "sums", "score", "spans"])

    return run


def _apply(docs: DataFrame, field: Field | None, scale: Logistic | None) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _score(field, scale),
        f"doc_id {kind}, sums array<double>, score double, spans array<struct<start: long, end: long, p: double>>",
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each kind that have a feature, added up per batch."""
    for batch in pieces(batches, 128):
        kinds: tuple[Counter, Counter] = Counter(), Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            kinds[toxic].update({f for w in set(item_words(text)) for f in word_features(w)[:4]})
        keys = list(kinds[0] | kinds[1])
        yield pa.RecordBatch.from_arrays([
            pa.array(keys, pa.binary()), pa.array([kinds[1][k] for k in keys], pa.int64()),
            pa.array([kinds[0][k] for k in keys], pa.int64()),
        ], names=["feature", "bad", "good"])


def _having(candidates: set[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            found = [
                sorted({f for w in set(item_words(text)) for f in word_features(w)[:4]} & candidates)
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary()))], names=["features"])

    return run


def cover(having: list[list[bytes]]) -> set[bytes]:
    """The fewest features, greedily, that between them occur in all toxic documents that can be told."""
    docs: dict[bytes, set[int]] = {}
    for index, features in enumerate(having):
        for f in features:
            docs.setdefault(f, set()).add(index)
    chosen: set[bytes] = set()
    while docs:
        best = max(docs, key=lambda f: (len(docs[f]), f))
        met = docs.pop(best)
        if len(met) < MIN_DOCS:
            break
        chosen.add(best)
        docs = {f: own - met for f, own in docs.items() if own - met}
    return chosen


def _windows(lexicon: set[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            windows, tags = [], []
            for text, toxic, lot in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "lot"))):
                own = item_words(text)
                if not own:
                    continue
                mark = [int(bool(toxic) and not lexicon.isdisjoint(word_features(w)[:4])) for w in own]
                hits = [k for k, m in enumerate(mark) if m]
                draw = np.random.default_rng(lot)
                for w in range(WINDOWS):
                    at = hits[draw.integers(len(hits))] if hits and w == 0 else int(draw.integers(len(own)))
                    start = max(0, min(at - int(draw.integers(WINDOW)), len(own) - WINDOW))
                    windows.append(own[start:start + WINDOW])
                    tags.append(mark[start:start + WINDOW])
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.list_(pa.binary())), pa.array(tags, pa.list_(pa.int32()))],
                names=["words", "tags"],
            )

    return run


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Field | None, Logistic | None]:
    """The field and the scale of document scores, from a bounded sample of labelled rows outside the held-out fold.

    Labels are of documents.  Features that tell toxic documents from clean ones
    label the tokens of toxic documents; the field then learns from windows
    of labelled tokens.  Without labels of both kinds nothing is learned.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(
        remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    ).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marked = bounded_sample(known, F.col("doc_id"), MAX_LABELLED, SEED)
    # At most MAX_LABELLED ids.
    sample = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").withColumn(
        "lot", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    )
    kinds = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(kinds) < 2:
        return None, None
    counted = sample.select("text", "toxic").mapInArrow(_count, "feature binary, bad long, good long").groupBy(
        "feature"
    ).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    ratio = F.col("bad") / kinds[1] / ((F.col("good") + 0.5) / kinds[0])
    few = min(MIN_RATIO, kinds[0] / kinds[1])
    candidates = {
        bytes(r["feature"]) for r in counted.where((F.col("bad") >= MIN_DOCS) & (ratio >= few)).orderBy(
            F.col("bad").desc(), "feature"
        ).limit(MAX_CANDIDATES).collect()
    }
    having = sample.where("toxic = 1").select("text").mapInArrow(_having(candidates), "features array<binary>")
    lexicon = cover([list(map(bytes, r["features"])) for r in having.limit(MAX_LABELLED).collect()])
    rows = sample.select("text", "toxic", "lot").mapInArrow(
        _windows(lexicon), "words array<binary>, tags array<int>"
    ).limit(2 * WINDOWS * MAX_LABELLED).collect()
    windows = sorted((list(map(bytes, r["words"])), r["tags"]) for r in rows)
    if not windows:
        return None, None
    field = fit([w for w, _ in windows], [t for _, t in windows])
    sums = _apply(sample, field, None).select("doc_id", "sums").join(F.broadcast(marked), "doc_id")
    scale = sorted((r["sums"], r["toxic"]) for r in sums.select("sums", "toxic").limit(2 * MAX_LABELLED).collect())
    return field, Logistic.fit(np.array([s for s, _ in scale]), np.array([t for _, t in scale], float), ridge=0.1)


def tagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted, spans`` of every row; spans are code-point offsets with a probability.

    Only the text is an input of a score.  Null and empty texts score as
    texts without a toxic token.  Rows are independent: null and repeated ids
    are scored alike.  Where nothing can be learned every score is 0.
    """
    out = _apply(docs, *learn(docs, labels))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns: the fold, score and prediction of every document, and how many spans it has."""
    return tagged(docs, labels).select(
        "doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted",
        F.size("spans").alias("n_spans"),
    )
