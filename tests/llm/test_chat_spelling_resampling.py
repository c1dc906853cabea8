"""Resampling, spelling groups and chat trees against brute force on odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rowloom.llm import chat_tree, queries, resampling, spelling_groups

DOCS = "doc_id long, text string, word string, n int, rank string, score string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def variants(seed, n):
    """Words that are often one edit apart, some of them frequent."""
    draw = random.Random(seed)
    words = set()
    while len(words) < n:
        word = list(draw.choice(["spelling", "grouping", "fréquente", "überträgt", "abababab"]))
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(word))
            word[at:at + draw.randrange(2)] = draw.choice(["", "a", "b", "é", "ß"])
        words.add("".join(word))
    return sorted(words)


@pytest.fixture(scope="module")
def odd(spark):
    draw = random.Random(1)
    words = variants(2, 400)
    rows = [(i, " ".join(draw.choices(words, [1 / (k + 1) for k in range(len(words))], k=200)), "w", 1, "r", "s") for i in range(40)]
    rows += [rows[0], rows[0], (40, None, None, None, None, None), (41, "", None, None, None, None), (None, rows[3][1], None, None, None, None)]
    rows += [(42, "GROUPING Grouping×grouping\x00x" * 3000, None, None, None, None), (43, "x" * 60_000 + " İstanbul \U0001f600", None, None, None, None)]
    rows += [(44, "A" * 700 + " " + "a" * 701 + " " + "a" * 700 + " " + "a" * 701, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(counts):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if brute_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best and counts[best] >= 10 * counts[word] else None
    out = set()
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        out.add((word, form[word], root, counts[word], len(near[word]), counts[form[word]] if form[word] else None))
    return out


@pytest.mark.parametrize("shard_words", [spelling_groups.SHARD_WORDS, 7])
def test_spelling_groups(odd, shard_words):
    """With shards of 7 words the trie is cut at its last level and into slices."""
    got = [tuple(r) for r in spelling_groups.spelling_groups(odd, shard_words).collect()]
    want = brute_groups(brute_words([(r["doc_id"], r["text"]) for r in odd.collect()]))
    assert len(got) == len(want) and set(got) == want
    assert any(f for _, f, *_ in want) and any(r != f for _, f, r, *_ in want if f)


def test_trie_walk():
    words = variants(5, 700) + ["a" * 300, "a" * 301, "a" * 299 + "b", "a" * 300 + "b"]
    tree = spelling_groups.trie(iter(words))
    got = list(spelling_groups.near_pairs(tree, tree))
    want = {frozenset(p) for p in itertools.combinations(words, 2) if brute_near(*p)}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)
    other = spelling_groups.trie(iter(words[::2]))
    both = {(a, b) for a in words for b in words[::2] if brute_near(a, b)}
    assert set(spelling_groups.near_pairs(tree, other)) == both
    for level in (1, 3, 8):
        for a, b in map(tuple, want):
            x, y = sorted(spelling_groups.vector(w)[:level] for w in (a, b))
            assert x == y or y in spelling_groups.later_nodes(x)


def test_spelling_empty(odd):
    assert spelling_groups.spelling_groups(odd.limit(0)).collect() == []
    assert spelling_groups.spelling_groups(odd.where("doc_id in (40, 41)")).collect() == []


def test_root_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    got = {r["word"]: r["root"] for r in spelling_groups.roots(links, 11).collect()}
    assert got == {f"w{i}": "w11" for i in range(11)}


def brute_resample(docs, items, longest):
    def features(text):
        words = WORD.findall(lower(text))
        return len(words), [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]

    def buckets(texts):
        return Counter(zlib.crc32(f.encode()) % 10000 for text in texts for f in features(text)[1])

    s, t = buckets([x for _, x in docs]), buckets(items)
    s_all, t_all = s.total() + 10000, t.total() + 10000
    rows = []
    for doc_id, text in docs:
        n, own = features(text)
        sums = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in (zlib.crc32(f.encode()) % 10000 for f in own))
        weight = sums // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((n, doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    drawn = 10 * sum(r[0] >= 20 for r in rows) // 100
    order = sorted((r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is None, r[1] or 0))[:drawn]
    ranks = Counter()
    return [(*r[1:], None) for r in rows], [(*r[1:], k + 1) for k, r in enumerate(order)]


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling(spark, odd, longest):
    items = spark.createDataFrame([("a", "spelling grouping,grouping"), ("b", None), ("c", "überträgt x" * 50)], "item_id string, text string")
    got = [tuple(r) for r in resampling.resample(odd, items, longest=longest).collect()]
    rows, drawn = brute_resample([(r["doc_id"], r["text"]) for r in odd.collect()], [r["text"] for r in items.collect()], longest)
    assert Counter(g[:4] for g in got) == Counter(r[:4] for r in rows)
    assert sorted((g for g in got if g[4]), key=lambda g: g[4]) == drawn and len(drawn) == 4


def test_resampling_empty(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(odd.limit(0), none).collect() == []
    assert resampling.resample(odd, none).count() == odd.count()
    texts = odd.selectExpr("concat('d', doc_id) AS doc_id", "text")
    assert resampling.resample(texts, none).schema["doc_id"].dataType.simpleString() == "string"


def test_resampling_many_ties(spark):
    """One id in all rows: equal scores, and ranks without gaps."""
    docs = spark.createDataFrame([(7, "the same " * 20)] * 300, "doc_id long, text string").repartition(9)
    got = resampling.resample(docs, docs.withColumnRenamed("doc_id", "item_id")).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 31))


def test_long_text_pieces():
    text = "ab cdé " * 20_000 + "x" * 50_000 + " tail"
    words, places = resampling.word_offsets(text)
    assert words == WORD.findall(text) and all(text[a:b] == w for w, (a, b) in zip(words, places))


CHATS = [
    (1, 0, "user", "hi", "z"), (1, 1, "assistant", "hello \\ ## ### #### </turn> \n ### User: x", "z"), (1, 2, "user", "bye", "z"),
    (2, 0, "user", "hi", "z"), (2, 1, "assistant", "hello \\ ## ### #### </turn> \n ### User: x", "z"), (2, 2, "assistant", None, None),
    (3, 0, "user", "hi", "z"), (3, 0, "user", "hi", "z"), (3, None, None, None, None), (4, 0, "tool: =x\\", "", None),
    (5, 3, "assistant", "<|endoftext|> \U0001f600 " * 3000, None), (5, 1, "system", "hi", None), (None, 0, "user", "no id", None),
    (None, 1, "assistant", "x", None), (6, 0, "user", "hi", None), (7, 0, "user", "h", None), (7, 1, "user", "i", None),
]
CHAT_ROWS = "conv_id long, turn long, role string, text string, path string"


def brute_chats(rows):
    by = {}
    for row in rows:
        by.setdefault(row[0], []).append(row[1:4])
    out = set()
    for conv_id, turns in by.items():
        turns = [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: tuple((v is not None, v or 0 if i == 0 else v or "") for i, v in enumerate(x)))]
        learned = "".join(t for r, t in turns if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.add((conv_id, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned)))
    return out


@pytest.mark.parametrize("pack_chars", [1, 40, chat_tree.PACK_CHARS])
def test_chats(spark, tmp_path, pack_chars):
    rows = CHATS + [(100 + k, t, r, x, None) for k in range(50) for t, r, x in ((0, "user", "hot"), (1, "assistant", "same" if k % 2 else f"own {k}"))]
    frame = spark.createDataFrame(rows, CHAT_ROWS).repartition(5)
    path = f"{tmp_path}/packs"
    chat_tree.write(frame, path, queries.tokenizer_path(), pack_chars)
    got = chat_tree.digest(chat_tree.read(spark, path), queries.tokenizer_path()).collect()
    want = brute_chats([r[:4] for r in rows])
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)


def test_tree_shares_turns(spark, tmp_path):
    """In one range and one pack each shared turn is emitted once, and attention skips other branches."""
    rows = spark.createDataFrame(CHATS, CHAT_ROWS)
    held = [tuple(r) for r in chat_tree.conversations(rows).orderBy("path", "conv_id").collect()]
    pack = chat_tree.Pack()
    distinct = set()
    for conv_id, path, roles, texts in held:
        keys = [bytes(path[k:k + 16]) for k in range(0, len(path), 16)]
        distinct.update(keys)
        pack.add(conv_id, keys, roles, texts)
    made = pack.row(chat_tree.tokenizer(queries.tokenizer_path()))
    assert len(made["turns"]) == len(distinct) and len(made["ids"]) == len(made["position_ids"]) == made["turns"][-1]["end"]
    for turn in made["turns"]:
        chain, place = [], turn["parent"]
        while place >= 0:
            chain = list(range(made["turns"][place]["start"], made["turns"][place]["end"])) + chain
            place = made["turns"][place]["parent"]
        assert [k for s in turn["attends"] for k in range(s["start"], s["end"])] == chain
        assert made["position_ids"][turn["start"]] == len(chain)
    assert any(len(t["attends"]) > 1 for t in made["turns"]) or len({t["parent"] for t in made["turns"]}) > 3


def test_chats_empty(spark, tmp_path):
    rows = spark.createDataFrame([], CHAT_ROWS)
    chat_tree.write(rows, f"{tmp_path}/none", queries.tokenizer_path())
    assert chat_tree.digest(chat_tree.read(spark, f"{tmp_path}/none"), queries.tokenizer_path()).collect() == []


def test_few_packs_a_row_group(spark, tmp_path, monkeypatch):
    """A reader that takes a row group at once holds some packs, not all of a file."""
    monkeypatch.setitem(chat_tree.ROW_GROUPS, "parquet.block.size", 1 << 17)
    draw = random.Random(6)
    rows = [(k, 0, "user", "".join(draw.choices("abcdefgh ,.", k=20_000)), None) for k in range(80)]
    spark.conf.set("spark.sql.files.minPartitionNum", 1)
    try:
        chat_tree.write(spark.createDataFrame(rows, CHAT_ROWS), f"{tmp_path}/packs", queries.tokenizer_path(), 20_000)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    files = [pq.ParquetFile(f).metadata for f in tmp_path.glob("packs/*.parquet")]
    assert sum(m.num_rows for m in files) == 80 and max(m.num_rows for m in files) > 20
    assert all(m.row_group(k).num_rows <= 20 for m in files for k in range(m.num_row_groups))
    got = chat_tree.digest(chat_tree.read(spark, f"{tmp_path}/packs"), queries.tokenizer_path()).collect()
    assert {tuple(r)[:5] for r in got} == brute_chats([r[:4] for r in rows]) and len(got) == 80


def test_copies_and_empty_turns_are_handed_on():
    """Conversations that add no characters end a pack, or a batch, by their number."""
    n = chat_tree.PACK_CONVERSATIONS + 10
    rows = pa.RecordBatch.from_pydict({"conv_id": pa.array(range(n)), "role": pa.nulls(n, pa.string()), "text": pa.nulls(n, pa.string())})
    chained = list(chat_tree._chained(iter([rows])))
    assert len(chained) > 1 and sum(b.num_rows for b in chained) == n
    packs = list(chat_tree._packed(queries.tokenizer_path(), chat_tree.PACK_CHARS, None)(iter(chained)))
    assert [len(p.column("conversations")[0]) for p in packs] == [chat_tree.PACK_CONVERSATIONS, 10]
    read = [b for b in chat_tree._digest(queries.tokenizer_path())(iter(packs))]
    assert [i for b in read for i in b.column("conv_id").to_pylist()] == list(range(n))
    assert {tuple(c.to_pylist()[0] for c in b.columns[1:]) for b in read} == {tuple(c.to_pylist()[-1] for c in b.columns[1:]) for b in read}


def test_escape():
    draw = random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choices(["#", "\\", "</turn>", "<", "/turn>", "\n", ": ", "### User: ", "=", "x"], k=draw.randrange(9)))
        assert chat_tree.unescape(chat_tree.escape(text)) == text
        assert "###" not in chat_tree.escape(text) and "</turn>" not in chat_tree.escape(text)
        turns = [(text, text[::-1]), ("assistant", text), ("", "")]
        assert chat_tree.parse("".join(chat_tree.header(r) + chat_tree.escape(t) + chat_tree.CLOSE for r, t in turns)) == turns
