"""Spelling variants grouped by a trie of letter-group counts.

Two words one edit apart differ by at most one letter too many and one too few,
so their counts of letters by group do as well.  Words lie in a trie whose level
*i* branches by the count of group *i*; a depth-first walk of two tries at once
spends a surplus and a deficit of one each, and words of the leaves it reaches
are verified.  On Spark the trie is cut at a level: each node there is a shard of
its own, and a word is sent as a query to the shards that the budget can reach.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import pieces
from rowloom.plans.scratch import materialize

MIN_LETTERS = 7
MIN_COUNT = 2
#: A form occurs so many times as often as the word it stands for.
FORM_RATIO = 10
#: One run in so many loses a letter, by hash.
TYPO_SHARE = 31
GROUPS = 16
#: Letters by frequency are dealt out to the groups in turn; any other letter goes by its code point.
LETTERS = "eaiotnrshldcumfpgwybvkxjqz"
#: A shard of the trie holds at most so many words; a node with more at the last level is cut into slices.
SHARD_WORDS = 30_000
MAX_LEVEL = 8
#: Words counted in a task before they are handed on.
HELD_WORDS = 300_000

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)
_GROUP = {letter: place % GROUPS for place, letter in enumerate(LETTERS)}


def run_words(doc_id: object, text: str | None) -> Counter:
    """Words of one text: runs of letters, A-Z lower-cased, some of them with one letter less."""
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for word, n in Counter(map(re.Match.group, _RUN.finditer(lowered))).items():
        h = zlib.crc32(word.encode(), start)
        if h % TYPO_SHARE == 0:
            place = h % len(word)
            word = word[:place] + word[place + 1:]
            if len(word) < MIN_LETTERS:
                continue
        found[word] += n
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    for batch in pieces(batches, 256):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.update(run_words(doc_id, text))
        if len(held) >= HELD_WORDS:
            yield handed()
            held.clear()
    if held:
        yield handed()


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: every word with its occurrences, summed in tasks before the shuffle."""
    counted = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def vector(word: str) -> bytes:
    """Letters of each group in a word; 255 stands for more."""
    counts = [0] * GROUPS
    for letter in word:
        group = _GROUP.get(letter)
        counts[ord(letter) % GROUPS if group is None else group] += 1
    return bytes(map(min, counts, [255] * GROUPS))


@lru_cache(1 << 16)
def later_nodes(node: bytes) -> tuple[bytes, ...]:
    """Nodes of the same level, later in order, that a surplus and a deficit of one reach.

    The first count that differs is then higher by one; a pair of
    nodes is met from one of its sides only.  Where 255 stands for a higher
    count, a letter more or less may leave it as it is: then one count differs, or none.
    """
    reached = []
    for i, count in enumerate(node):
        if count < 255:
            up = node[:i] + bytes([count + 1]) + node[i + 1:]
            reached.append(up)
            reached += [up[:j] + bytes([up[j] - 1]) + up[j + 1:] for j in range(i + 1, len(up)) if up[j]]
    return tuple(reached)


class Leaf:
    """Words of one vector."""

    __slots__ = ("vector", "words", "by_half")

    def __init__(self, of: bytes):
        self.vector, self.words, self.by_half = of, [], {}

    def halves(self, size: int) -> tuple[dict, dict]:
        """Words by their first and by their last ``size`` letters: one edit leaves one of both alone."""
        if size not in self.by_half:
            firsts: dict = {}
            lasts: dict = {}
            for word in self.words:
                firsts.setdefault(word[:size], []).append(word)
                lasts.setdefault(word[-size:], []).append(word)
            self.by_half[size] = firsts, lasts
        return self.by_half[size]


def trie(words: Iterator[str]) -> dict | Leaf | None:
    """Nested dicts by count; a node with one leaf below it is that leaf."""
    leaves: dict[bytes, Leaf] = {}
    for word in words:
        of = vector(word)
        if of not in leaves:
            leaves[of] = Leaf(of)
        leaves[of].words.append(word)

    def grown(below: list[Leaf], level: int) -> dict | Leaf:
        if len(below) == 1:
            return below[0]
        branches: dict[int, list[Leaf]] = {}
        for leaf in below:
            branches.setdefault(leaf.vector[level], []).append(leaf)
        return {count: grown(part, level + 1) for count, part in branches.items()}

    return grown(list(leaves.values()), 0) if leaves else None


def one_edit(a: str, b: str) -> bool:
    """Whether different words of about equal length differ by one letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _verified(a: Leaf, b: Leaf) -> Iterator[tuple[str, str]]:
    same = a is b
    if len(a.words) * len(b.words) <= 6:
        for word in a.words:
            for other in b.words:
                if (word < other or not same) and word != other and one_edit(word, other):
                    yield word, other
        return
    by_length: dict[int, list[str]] = {}
    for word in a.words:
        by_length.setdefault(len(word), []).append(word)
    shortest = min(map(len, b.words))
    for length, words in by_length.items():
        size = min(length, shortest) // 2
        firsts, lasts = b.halves(size)
        for word in words:
            first = word[:size]
            for other in firsts.get(first, ()):
                if (word < other or not same) and word != other and one_edit(word, other):
                    yield word, other
            for other in lasts.get(word[-size:], ()):
                if other[:size] != first and (word < other or not same) and one_edit(word, other):
                    yield word, other


def _leaf_budget(a: bytes, b: bytes, level: int, surplus: int, deficit: int) -> bool:
    while level < GROUPS:
        x, y = a[level], b[level]
        if x != y:
            if surplus and y == x + 1:
                surplus = 0
            elif deficit and y == x - 1:
                deficit = 0
            else:
                return False
        level += 1
    return True


def near_pairs(queries: dict | Leaf | None, index: dict | Leaf | None) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart, depth first through both tries; a trie with itself gives each pair once.

    ``surplus`` and ``deficit`` are what is left of the budget: a letter that the
    index word has and the query has not, and the reverse.
    """
    stack = [(queries, index, 0, 1, 1)] if queries is not None and index is not None else []
    while stack:
        q, i, level, surplus, deficit = stack.pop()
        q_leaf, i_leaf = type(q) is Leaf, type(i) is Leaf
        if q_leaf and i_leaf:
            if q is i or _leaf_budget(q.vector, i.vector, level, surplus, deficit):
                yield from _verified(q, i)
            continue
        itself, below = q is i, level + 1
        for count, branch in ((q.vector[level], q),) if q_leaf else q.items():
            steps = [(count, surplus, deficit)]
            if surplus:
                steps.append((count + 1, 0, deficit))
            # Within one trie the reverse of a surplus is met from the other side.
            if deficit and not itself:
                steps.append((count - 1, surplus, 0))
            for wanted, s, d in steps:
                if i_leaf:
                    if i.vector[level] == wanted:
                        stack.append((branch, i, below, s, d))
                else:
                    other = i.get(wanted)
                    if other is not None:
                        stack.append((branch, other, below, s, d))


def _route(level: int):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for word, n in zip(words, counts):
                node = vector(word)[:level]
                rows.append((node, True, word, n))
                rows += [(other, False, word, n) for other in later_nodes(node)]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.bool_()),
                pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64()),
            ], names=["node", "own", "word", "n"])

    return route


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = Counter(vector(word)[:MAX_LEVEL] for word in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["node", "n"]
        )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards one after another: first their own words, which are indexed, then queries from other shards."""
    shard, index, index_trie, asked, n_of = None, [], None, [], {}

    def found(queries) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for a, b in near_pairs(queries, index_trie):
            rows.append((a, b, n_of[b]))
            rows.append((b, a, n_of[a]))
            if len(rows) >= 20_000:
                yield _pairs(rows)
                rows = []
        if rows:
            yield _pairs(rows)

    def ended() -> Iterator[pa.RecordBatch]:
        nonlocal index_trie, index, asked
        if index:
            index_trie, index = trie(iter(index)), []
            yield from found(index_trie)
        if asked:
            yield from found(trie(iter(asked)))
            for word in asked:
                del n_of[word]
            asked = []

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(5)]
        for node, piece, query, word, n in zip(*columns):
            if (node, piece) != shard:
                yield from ended()
                shard, index_trie, n_of = (node, piece), None, {}
            n_of[word] = n
            if query:
                asked.append(word)
                if len(asked) >= SHARD_WORDS:
                    yield from ended()
            else:
                index.append(word)
    yield from ended()


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    a, b, n = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"]
    )


def cut_level(words: DataFrame, shard_words: int = SHARD_WORDS) -> int:
    """The first level at which no node of the trie has more than ``shard_words`` words, or the last."""
    nodes = words.select("word").mapInArrow(_nodes, "node binary, n long").groupBy("node").agg(F.sum("n").alias("n"))
    levels = nodes.select(F.explode(F.sequence(F.lit(1), F.lit(MAX_LEVEL))).alias("level"), "node", "n")
    by_node = levels.groupBy("level", F.expr("substring(node, 1, level)").alias("node")).agg(F.sum("n").alias("n"))
    largest = {r["level"]: r["n"] for r in by_node.groupBy("level").agg(F.max("n").alias("n")).collect()}
    return next((k for k in range(1, MAX_LEVEL) if largest.get(k, 0) <= shard_words), MAX_LEVEL)


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, level: int | None = None) -> DataFrame:
    """``word, near, near_n``: both directions of each pair of ``words`` (written, unique) one edit apart."""
    level = level or cut_level(words, shard_words)
    routed = words.select("word", "n").mapInArrow(_route(level), "node binary, own boolean, word string, n long")
    shards = routed.where("own").groupBy("node").agg(
        F.ceil(F.count("*") / F.lit(float(shard_words))).cast("int").alias("slices")
    )
    home = F.pmod(F.xxhash64("word"), F.col("slices")).cast("int")
    # Words of a sliced shard are indexed in one slice and asked for in the later ones.
    own = F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda k: k >= home)
    placed = routed.join(shards, "node").select(
        "node", F.explode(F.when(F.col("own"), own).otherwise(F.sequence(F.lit(0), F.col("slices") - 1))).alias("piece"),
        "own", "word", "n", home.alias("home"),
    ).select("node", "piece", (~F.col("own") | (F.col("piece") != F.col("home"))).alias("query"), "word", "n")
    return placed.repartition("node", "piece").sortWithinPartitions("node", "piece", "query").mapInArrow(
        _search, "word string, near string, near_n long"
    )


def roots(links: DataFrame, longest: int) -> DataFrame:
    """``word, root``: the end of each chain of ``word, form`` links of at most ``longest`` steps, by pointer jumping."""
    ends = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1, longest)))):
        ends = materialize(ends, "spelling-roots")
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("_end"))
        ends = ends.join(ahead, "root", "left").select("word", F.coalesce("_end", "root").alias("root"))
    return ends


def spelling_groups(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``docs`` (``doc_id, text`` are read).

    A word's form is its near word of the largest count, ties by code point, if that
    count is ten times the word's own; counts grow along forms, so a chain ends
    after as many steps as the largest count has digits.

    Null text: no words.  Null id: hashed as empty text.  Repeated rows count
    again.  A text is read whole, one at a time; its words are held by kind.
    A word in a third of all texts is one row per task before the shuffle.  Empty
    table: no rows.  Runs its jobs before it returns.
    """
    words = materialize(word_counts(docs), "spelling-words")
    best = near_words(words, shard_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    chosen = F.coalesce(-F.col("best.less") >= FORM_RATIO * F.col("n"), F.lit(False))
    table = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"),
    ), "spelling-forms")
    links = table.where(F.col("form").isNotNull())
    most = links.agg(F.max("form_n")).first()[0] or 0
    return table.join(roots(links, len(str(most))), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: crc32 has no function in the SQL engine: a table of 256 remainders, then one step per byte.
CRC_TABLE_SQL = """
    SELECT list(c ORDER BY b) AS tab FROM (
        SELECT b, list_reduce([b::UBIGINT] || list_transform(range(8), lambda k: 0::UBIGINT),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b))"""


def crc_sql(text: str) -> str:
    """SQL of the crc32 of a text, with ``tab`` of :data:`CRC_TABLE_SQL` at hand."""
    digits = f"hex(encode({text}))"
    byte = "('0123456789ABCDEF'.strpos({0}[2 * i + 1]) - 1) * 16 + '0123456789ABCDEF'.strpos({0}[2 * i + 2]) - 1".format(digits)
    return (
        f"xor(list_reduce([4294967295::UBIGINT] || list_transform(range(strlen({text})), lambda i: ({byte})::UBIGINT), "
        f"lambda c, b: xor(tab[(xor(c, b) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT)"
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPELLING_SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE_SQL}),
runs AS (
    SELECT doc_id, word, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS word
        FROM documents)
    WHERE length(word) >= {MIN_LETTERS} GROUP BY ALL
),
hashed AS (
    SELECT word, n, {crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || word")} AS h FROM runs, crc
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % {TYPO_SHARE} = 0
            THEN word[1:(h % length(word))::BIGINT] || word[(h % length(word))::BIGINT + 2:] ELSE word END AS word
        FROM hashed)
    WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT DISTINCT word, n, word[1:i - 1] || word[i + 1:] AS short FROM places),
near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM places a JOIN places b
        ON a.i = b.i AND a.word[1:a.i - 1] = b.word[1:b.i - 1] AND a.word[a.i + 1:] = b.word[b.i + 1:]
    WHERE a.word <> b.word
    UNION ALL SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.short = w.word
    UNION ALL SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.short = w.word
),
best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word
),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN near_n >= {FORM_RATIO} * w.n THEN near END AS form, CASE WHEN near_n >= {FORM_RATIO} * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
walk AS (
    SELECT word, word AS at, form AS onward FROM forms
    UNION ALL SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON walk.onward = forms.word
)
SELECT forms.word, forms.form, walk.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN walk ON walk.word = forms.word AND walk.onward IS NULL
"""
