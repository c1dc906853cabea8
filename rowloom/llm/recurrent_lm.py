"""Language-model scoring: a gated recurrent network in numpy with a class-factored output."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import pieces, remainder
from rowloom.plans.scratch import materialize

FOLDS, HELD_OUT = 5, 1
#: The end of a document as a token; no word is empty.
END = b""
#: Words that tasks look up themselves: the most frequent ones, of limited length,
#: which bounds the broadcast by HEAD_WORDS * HEAD_BYTES.  Counts of all other words are joined.
HEAD_WORDS, HEAD_BYTES = 150_000, 64
#: Words the network tells apart; all others are one class with their own counts.
VOCABULARY = 2_048
HIDDEN, EMBEDDED = 24, 24
#: The documents of each turn; weights of all tasks are averaged after a turn, and every training token is in one.
#: A task lays its documents end to end, STREAM tokens at a time or one
#: longer document, as GROUP lanes at most, of LANE tokens or more; back-propagation
#: is cut every BACK tokens while the state is carried on.
TURNS, GROUP, LANE, STREAM, BACK = 3, 1_024, 1_024, 1 << 20, 16
#: Learning rate of the first turn, and what it is multiplied by for each further one.
RATE, FALL = 0.02, 0.5
#: Tokens of a scoring window; the state is carried from one to the next.
WINDOW, DOCUMENTS = 64, 4_096
#: Targets whose output layer is computed at once, so that it stays in the cache.
BLOCK = 4_096
SEED = 5


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts as ``common.words`` cuts them, each text's followed by the end, and how many each text has.

    Arrow's functions take about a third of the time of Python's.
    """
    nothing, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    # Trimmed first: lower-casing a slice of a large batch was seen to give wrong texts (Arrow 23).
    texts = pc.ascii_lower(pc.fill_null(pc.ascii_trim_whitespace(texts.cast(pa.large_string())), nothing))
    # An empty word stands after the last space; nothing else makes one.
    texts = pc.if_else(pc.equal(texts, nothing), nothing, pc.binary_join_element_wise(texts, space, nothing))
    own = pc.ascii_split_whitespace(texts)
    return own.flatten().cast(pa.large_binary()), pc.list_value_length(own).to_numpy().astype(np.int64)


def _numbers(tokens: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each token among the known ones; their number, if it is not one of them."""
    return pc.index_in(tokens, value_set=known).fill_null(len(known)).to_numpy()


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of tokens, handed on for each piece of a batch."""
    for batch in pieces(batches, DOCUMENTS):
        token, c = pc.value_counts(_tokens(batch.column(0))[0]).flatten()
        yield pa.RecordBatch.from_arrays([token.cast(pa.binary()), c], names=["token", "c"])


def token_counts(training: DataFrame) -> DataFrame:
    """``token, c`` of every token of the training texts."""
    tallied = training.select("text").mapInArrow(_tally, "token binary, c long")
    return materialize(tallied.groupBy("token").agg(F.sum("c").alias("c")), "lm-counts")


@dataclass
class Head:
    """The most frequent words with their counts, and the totals of all."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int


def head_of(counts: DataFrame) -> Head:
    """Words as frequent as fit into the head: the cut is found from how many words have each count."""
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    short = counts.where(F.octet_length("token") <= HEAD_BYTES)
    room, least = HEAD_WORDS, None
    for row in short.groupBy("c").count().orderBy(F.col("c").desc()).limit(HEAD_WORDS).toLocalIterator():
        if row["count"] > room:
            break
        room, least = room - row["count"], row["c"]
    found = short.where(F.col("c") >= least).collect() if least is not None else []
    rows = sorted(((r["c"], bytes(r["token"])) for r in found), key=lambda r: (-r[0], r[1]))
    return Head([w for _, w in rows], np.array([c for c, _ in rows], np.int64), total["n"] or 0, total["v"])


class Network:
    """GRU with an output of two steps: the class of the next token, then the token within its class.

    Token ``size`` stands for every word outside the vocabulary and is alone in the
    last class.  Classes hold neighbours in frequency.
    """

    def __init__(self, counts: np.ndarray, rest: float):
        self.size = n = len(counts)
        rng = np.random.default_rng(SEED)
        # Classes of like sums of root frequencies: small ones for frequent words, so that the output costs least.
        mass = np.cumsum(np.sqrt(counts + 0.5))
        several = max(1, round(0.7 * np.sqrt(n)))
        cuts = np.searchsorted(mass, mass[-1] * np.arange(1, several) / several)
        self.bounds = np.unique([0, *cuts, n]).tolist()
        self.classes = np.append(np.searchsorted(self.bounds, np.arange(n), side="right") - 1, len(self.bounds) - 1)
        mass = np.bincount(self.classes, np.append(counts, rest) + 0.5).astype(np.float32)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.p = {
            "emb": draw(n + 1, EMBEDDED), "w": draw(EMBEDDED, 3 * HIDDEN), "u": draw(HIDDEN, 3 * HIDDEN),
            "b": np.zeros(3 * HIDDEN, np.float32), "wc": draw(HIDDEN, len(mass)), "bc": np.log(mass / mass.sum()),
            "ww": draw(HIDDEN, n), "bw": np.log((counts + 0.5).astype(np.float32)),
        }

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The state after each row of ``h``, and what its gradient needs."""
        return _cell(_by_gate(x), h, _by_gate(self.p["u"]))

    def log_probabilities(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log-probability of each target after the state in the same row."""
        own = self.classes[targets]
        order = np.argsort(own, kind="stable")
        turned, words, out = h[order], targets[order], np.empty(len(targets))
        cuts = np.searchsorted(own[order], np.arange(len(self.bounds)))
        for low in range(0, len(targets), BLOCK):
            rows = slice(low, low + BLOCK)
            logits = self.p["wc"].T @ turned[rows].T + self.p["bc"][:, None]
            out[rows] = _log_softmax_at(logits, self.classes[words[rows]])
        for k, (low, high) in enumerate(zip(self.bounds, self.bounds[1:])):
            for start in range(cuts[k], cuts[k + 1], BLOCK):
                rows = slice(start, min(start + BLOCK, cuts[k + 1]))
                logits = self.p["ww"][:, low:high].T @ turned[rows].T + self.p["bw"][low:high, None]
                out[rows] += _log_softmax_at(logits, words[rows] - low)
        back = np.empty_like(out)
        back[order] = out
        return back

    def train(self, streams: Iterable[np.ndarray], rate: float = RATE) -> int:
        """Adam over truncated back-propagation, once through each stream; how many tokens were predicted.

        A stream is cut into lanes that meet end to end, so that every token after its first is a target once.
        """
        state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        t = seen = 0
        for stream in streams:
            n = len(stream) - 1
            lanes = min(GROUP, max(1, n // LANE))
            size = -(-n // lanes)
            filled = np.concatenate([stream, np.zeros(lanes * size - n, stream.dtype)])
            own = np.lib.stride_tricks.sliding_window_view(filled, size + 1)[::size]
            left = n - np.arange(lanes) * size
            h = np.zeros((lanes, HIDDEN), np.float32)
            for start in range(0, size, BACK):
                tokens = own[:, start:start + BACK + 1].astype(np.int64)
                used = np.arange(start, start + tokens.shape[1] - 1) < left[:, None]
                grads, h = self.gradients(tokens, h, used)
                t += 1
                for k, g in grads.items():
                    m, v = state[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    self.p[k] -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
            seen += n
        return seen

    def gradients(
        self, tokens: np.ndarray, h: np.ndarray, used: np.ndarray | None = None
    ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean loss over one window, and the state after it.

        With ``used``, which targets count, documents follow each other in a row,
        and the state begins anew after each end, as it does in scoring.
        """
        p, (lanes, steps) = self.p, (len(tokens), tokens.shape[1] - 1)
        table, u = p["emb"] @ p["w"] + p["b"], _by_gate(p["u"])
        given, targets = tokens[:, :-1].T.ravel(), tokens[:, 1:].T.ravel()
        inputs, ends = _by_gate(table), np.zeros((steps, lanes), bool) if used is None else (given == 0).reshape(steps, lanes)
        kept, states = [], np.empty((steps, *h.shape), h.dtype)
        for k in range(steps):
            h = _begun(h, ends[k])
            x = inputs.take(given[k * lanes:(k + 1) * lanes], axis=1)
            kept.append((h, *_cell(x, h, u, states[k])[1:]))
            h = states[k]
        counted = np.ones(len(targets), h.dtype) if used is None else used.T.ravel().astype(h.dtype)
        scale = counted / max(1.0, float(counted.sum()))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        own = self.classes[targets]
        dout = np.empty_like(states)
        at, wct = np.arange(lanes), np.ascontiguousarray(p["wc"].T)
        for k in range(steps):
            now = slice(k * lanes, (k + 1) * lanes)
            error = _softmax(wct @ states[k].T + p["bc"][:, None])
            error[own[now], at] -= 1
            error *= scale[now]
            g["wc"] += states[k].T @ error.T
            g["bc"] += error.sum(axis=1)
            np.matmul(error.T, wct, out=dout[k])
        # Rows in order of the target's class, so that each class is a slice of them; the last class has no words to tell apart.
        order = np.argsort(own.astype(np.int16), kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(self.bounds)))
        order = order[:cuts[-1]]
        turned = states.reshape(-1, h.shape[1]).take(order, axis=0)
        words, scale, more = targets[order], scale[order], np.empty_like(turned)
        for k, (low, high) in enumerate(zip(self.bounds, self.bounds[1:])):
            rows = slice(cuts[k], cuts[k + 1])
            if rows.stop > rows.start:
                wwt = np.ascontiguousarray(p["ww"][:, low:high].T)
                error = _softmax(wwt @ turned[rows].T + p["bw"][low:high, None])
                error[words[rows] - low, np.arange(rows.stop - rows.start)] -= 1
                error *= scale[rows]
                g["ww"][:, low:high], g["bw"][low:high] = turned[rows].T @ error.T, error.sum(axis=1)
                np.matmul(error.T, wwt, out=more[rows])
        dout.reshape(-1, h.shape[1])[order] += more
        dh, moved = np.zeros_like(h), np.empty((3, steps, *h.shape), h.dtype)
        du, dhs, gu, ut = np.empty_like(moved[:, 0]), np.empty_like(moved[:, 0]), np.zeros_like(u), u.transpose(0, 2, 1)
        for k in range(steps - 1, -1, -1):
            before, z, r, n, hn = kept[k]
            dh += dout[k]
            dz, dr, dn = moved[:, k]
            np.multiply(dh * (1 - z), 1 - n * n, out=dn)
            np.multiply(dh * (before - n), z * (1 - z), out=dz)
            np.multiply(dn * hn, r * (1 - r), out=dr)
            du[:2] = moved[:2, k]
            np.multiply(dn, r, out=du[2])
            gu += before.T @ du
            np.matmul(du, ut, out=dhs)
            dh *= z
            dh += dhs[0]
            dh += dhs[1]
            dh += dhs[2]
            dh[ends[k]] = 0
        g["u"] = gu.transpose(1, 0, 2).reshape(p["u"].shape)
        # Sums by token: rows in order of tokens, added up from each token's first, two numbers at once.
        dtable = np.zeros_like(table)
        order = np.argsort(given.astype(np.uint16), kind="stable")
        present, first = np.unique(given[order], return_index=True)
        turned = moved.reshape(3, -1, h.shape[1]).take(order, axis=1)
        sums = np.add.reduceat(turned.view(np.result_type(turned, np.complex64)), first, axis=1).view(turned.dtype)
        dtable[present] = np.concatenate(sums, axis=1)
        g["emb"], g["w"], g["b"] = dtable @ p["w"].T, p["emb"].T @ dtable, dtable.sum(axis=0)
        size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        return {k: v * min(1.0, 1.0 / (size + 1e-9)) for k, v in g.items()}, h

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each whole document; the state is carried from window to window.

        Documents follow each other in at most ``GROUP`` lanes, the longest first, each in the lane that is
        shortest so far; the state begins anew with each.  Lanes are in order of length,
        so that those still going on are always the first rows.
        """
        total, lengths = np.zeros(len(documents)), [len(d) for d in documents]
        lanes = [(0, lane, []) for lane in range(min(GROUP, len(documents)))]
        for k in sorted(range(len(documents)), key=lambda k: -lengths[k]):
            n, lane, own = lanes[0]
            own.append(k)
            heapq.heapreplace(lanes, (n + lengths[k], lane, own))
        lanes.sort(key=lambda lane: (-lane[0], lane[1]))
        order = [k for *_, own in lanes for k in own]
        if not order:
            return total
        # All lanes end to end: targets, whose they are, and what comes before each.
        flat, owner = np.concatenate([documents[k] for k in order]), np.repeat(order, [lengths[k] for k in order])
        # Every document begins after the end of another.
        begun = np.append(True, owner[1:] != owner[:-1])
        given = np.where(begun, 0, np.append(0, flat[:-1]))
        size = np.array([n for n, *_ in lanes])
        first = np.cumsum(size) - size
        table, u = _by_gate((self.p["emb"] @ self.p["w"] + self.p["b"]).astype(np.float32)), _by_gate(self.p["u"])
        h = np.zeros((len(lanes), HIDDEN), np.float32)
        for start in range(0, int(size[0]), WINDOW):
            going = np.searchsorted(-size, -np.arange(start, min(start + WINDOW, int(size[0]))))
            at = np.concatenate([first[:n] + start + k for k, n in enumerate(going.tolist())])
            before, new, states, low = given[at], begun[at], np.empty((len(at), HIDDEN), np.float32), 0
            for n in going.tolist():
                rows = slice(low, low + n)
                h = _cell(table.take(before[rows], axis=1), _begun(h[:n], new[rows]), u, states[rows])[0]
                low += n
            total += np.bincount(owner[at], self.log_probabilities(states, flat[at]), minlength=len(total))
        return total


def _by_gate(rows: np.ndarray) -> np.ndarray:
    """The parts of each row that belong to the three gates, each part an array without gaps."""
    return np.ascontiguousarray(rows.reshape(len(rows), 3, -1).transpose(1, 0, 2))


def _begun(h: np.ndarray, new: np.ndarray) -> np.ndarray:
    """States with those set to nothing where a document begins."""
    if new.any():
        h = h.copy()
        h[new] = 0
    return h


def _cell(x: np.ndarray, h: np.ndarray, u: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """One step of the gated unit for states in rows, ``x`` and ``u`` by gate: the new state, both gates, the candidate and its own part."""
    hu = h @ u
    gates = x[:2] + hu[:2]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    (z, r), hn = gates, hu[2]
    n = r * hn
    n += x[2]
    # The hyperbolic tangent; numpy takes less time for an exponential.
    n *= -2
    np.exp(n, out=n)
    n += 1
    np.divide(2, n, out=n)
    n -= 1
    new = np.subtract(h, n, out=out)
    new *= z
    new += n
    return new, z, r, n, hn


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Of each column, in place."""
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of one row in each column."""
    logits -= logits.max(axis=0)
    chosen = logits[at, np.arange(len(at))].astype(np.float64)
    return chosen - np.log(np.exp(logits, out=logits).sum(axis=0))


def _encode(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Numbers of the tokens of each text with its end, and a seeded lot that differs from row to row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(pickle.loads(shared.value), pa.large_binary())
        draw = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        for batch in pieces(batches, DOCUMENTS):
            tokens, n = _tokens(batch.column(0))
            data = _numbers(tokens, known).astype("<u2")
            ends = np.append(0, 2 * np.cumsum(n))
            out = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            lots = draw.integers(0, 1 << 62, len(out))
            yield pa.RecordBatch.from_arrays([pa.array(lots, pa.int64()), out.cast(pa.binary())], names=["lot", "tokens"])

    return run


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Documents end to end, each stream beginning with the end before its first document."""
    start = np.zeros(1, "<u2")
    held, n = [start], 0
    for batch in pieces(batches, 256):
        for own in batch.column(0).to_pylist():
            held.append(np.frombuffer(own, "<u2"))
            n += len(held[-1])
            if n >= STREAM:
                yield np.concatenate(held)
                held, n = [start], 0
    if n:
        yield np.concatenate(held)


LEARNED = "part int, n long, weights binary"


def _learned(part: int, n: int, weights: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([weights.astype("<f8").tobytes()], pa.binary())
    ], names=["part", "n", "weights"])


def _train(shared, rate: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row a task: the weights after all its documents, times the number of its tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = pickle.loads(shared.value)
        n = network.train(_streams(batches), rate)
        if n:
            flat = np.concatenate([v.ravel() for v in network.p.values()]).astype(np.float64)
            yield _learned(TaskContext.get().partitionId(), n, flat * n)

    return run


def _sum(rows: list) -> tuple[int, np.ndarray]:
    """Sums of tokens and weights, in the order of the parts, so that every run rounds alike."""
    rows = sorted(rows, key=lambda r: r[0])
    total = np.zeros(len(rows[0][2]) // 8)
    for row in rows:
        total += np.frombuffer(row[2], "<f8")
    return sum(row[1] for row in rows), total


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
    if rows:
        yield _learned(min(r[0] for r in rows), *_sum(rows))


def fit(training: DataFrame, head: Head) -> Network:
    """The network, its output begun at the corpus counts and fitted on every token of the training texts.

    Documents are numbered once and dealt to tasks and turns by lot.  In each turn every
    task goes on from the same weights through all its documents of that turn; the
    weights of all tasks are averaged by tokens, first in groups of tasks, then on the driver,
    which holds about the root of the number of tasks, each of the network's fixed size.
    """
    # The end of a document is token 0, the start of every document.
    ordered = [END, *[w for w in head.words if w != END]][:VOCABULARY]
    counted = dict(zip(head.words, head.counts.tolist()))
    counts = np.array([counted.get(w, 0) for w in ordered], np.float64)
    network = Network(counts, max(0.0, head.tokens - counts.sum()))
    network.vocabulary = ordered
    share = lambda x: training.sparkSession.sparkContext.broadcast(cloudpickle.dumps(x))
    dealt = training.select("text").mapInArrow(_encode(share(ordered)), "lot long, tokens binary")
    turn = (F.col("lot") % TURNS).cast("int").alias("turn")
    # In order of turns, so that a turn's scan can leave out the pages of the others.
    tokens = dealt.repartition("lot").select(turn, "lot", "tokens").sortWithinPartitions("turn", "lot").drop("lot")
    tokens = materialize(tokens, "lm-tokens")
    groups = max(1, int(np.ceil(np.sqrt(tokens.rdd.getNumPartitions()))))
    for k in range(TURNS):
        own = tokens.where(F.col("turn") == k).select("tokens")
        learned = own.mapInArrow(_train(share(network), RATE * FALL ** k), LEARNED)
        rows = learned.repartition(groups, F.col("part") % groups).mapInArrow(_add, LEARNED).collect()
        if rows:
            n, total = _sum([tuple(r) for r in rows])
            cuts = np.cumsum([v.size for v in network.p.values()])[:-1]
            network.p = {
                k: w.reshape(v.shape).astype(np.float32)
                for (k, v), w in zip(network.p.items(), np.split(total / n, cuts))
            }
    return network


PARTS = (
    "part int, row long, doc_id {kind}, n_tokens long, n_known long, base double, score double, "
    "tail array<struct<token: binary, n: int>>"
)


def _tails(tokens: pa.Array, sizes: np.ndarray, missing: np.ndarray) -> pa.Array:
    """Of each text the different tokens among the missing ones, with how often it has them."""
    own = tokens.take(pa.array(missing)).dictionary_encode()
    several = max(1, len(own.dictionary))
    rows = np.repeat(np.arange(len(sizes)), sizes)[missing]
    pairs, times = np.unique(rows * several + own.indices.to_numpy(), return_counts=True)
    rows, numbers = np.divmod(pairs, several)
    words = own.dictionary.take(pa.array(numbers)).cast(pa.binary())
    ends = pa.array(np.searchsorted(rows, np.arange(len(sizes) + 1)), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([words, pa.array(times, pa.int32())], names=["token", "n"]))


def _score(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, network = pickle.loads(shared.value)
        known, listed = {w: i for i, w in enumerate(head.words)}, pa.array(head.words, pa.large_binary())
        base = np.log10((np.append(head.counts, 0) + 0.5) / (head.tokens + 0.5 * (head.distinct + 1)))
        inside = np.full(len(head.words) + 1, network.size, np.int64)
        for token, word in enumerate(network.vocabulary):
            if word in known:
                inside[known[word]] = token
        kept = sum(w in known for w in network.vocabulary)
        covered = int(sum(head.counts[known[w]] for w in network.vocabulary if w in known))
        rest = head.tokens - covered + 0.5 * (head.distinct - kept + 1)
        # Log-probability within the last class, for words of the head that are in it.
        within = np.where(inside == network.size, np.log10((np.append(head.counts, 0) + 0.5) / rest), 0.0)
        base[-1] = within[-1] = 0.0
        part, row, absent = TaskContext.get().partitionId(), 0, len(head.words)
        for batch in pieces(batches, DOCUMENTS):
            tokens, sizes = _tokens(batch.column(1))
            found, n = _numbers(tokens, listed), len(sizes)
            first = np.cumsum(sizes) - sizes
            sums = lambda x: np.add.reduceat(x, first)
            natural = network.score(np.split(inside[found], first[1:]))
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()), batch.column(0),
                pa.array(sizes), pa.array(sums((found != absent).astype(np.int64))), pa.array(sums(base[found])),
                pa.array(natural / np.log(10) + sums(within[found])), _tails(tokens, sizes, np.flatnonzero(found == absent)),
            ], names=["part", "row", "doc_id", "n_tokens", "n_known", "base", "score", "tail"])
            row += n

    return run


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Counts are of all training texts.  A task scores the words of the head and the
    classes of all tokens; counts of rarer words are joined by word, and
    their parts added to the document.  Null and empty texts are the end token
    alone.  Null ids count as empty text for the fold; repeated rows are scored
    alike and all returned.  Without training texts every token is unknown.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    training = own.where(~held_out)
    counts = token_counts(training)
    head = head_of(counts)
    network = fit(training, head)
    kind = own.schema["doc_id"].dataType.simpleString()
    parts = materialize(
        own.mapInArrow(_score(spark.sparkContext.broadcast(cloudpickle.dumps((head, network)))), PARTS.format(kind=kind)), "lm-parts"
    )
    n, v = head.tokens, head.distinct
    in_head = dict(zip(head.words, head.counts.tolist()))
    inside = [w for w in network.vocabulary if w in in_head]
    rest = n - sum(in_head[w] for w in inside) + 0.5 * (v - len(inside) + 1)
    tail = parts.select("part", "row", F.explode("tail").alias("t")).select(
        "part", "row", F.col("t.token").alias("token"), F.col("t.n").alias("n")
    )
    c = F.coalesce(F.col("c"), F.lit(0))
    added = tail.join(counts, "token", "left").groupBy("part", "row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))).alias("base_more"),
        F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(rest))).alias("score_more"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return parts.drop("tail").join(added, ["part", "row"], "left").select(
        "doc_id", held_out.alias("held_out"), "n_tokens", (F.col("n_known") + zero("more")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + zero("base_more")).alias("base_score"),
        (F.col("score") + zero("score_more")).alias("score"),
    )
