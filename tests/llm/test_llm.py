"""Operators of the data pipeline against brute force, exact round trips and SQL."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from rowloom.llm import (
    gif_media, mixing, near_duplicates, phrase_index, pii, quality, queries, recurrent_lm,
    token_files, toxicity, url_rules,
)
from rowloom.llm.common import BATCH_ROWS, small_batches, table, words

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, target int"
#: Nulls in every column, an empty text, white space, ties, repeated rows, a long text, clashing extra columns.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 49, "x", 1),
    (1, "the quick brown fox jumps over the lazy dog again", "en", "a", 49, "x", 1),
    (2, "the quick brown fox jumps over the lazy dog again", None, None, None, None, None),
    (3, None, None, "b", None, None, None),
    (4, "", "en", "b", 0, None, None),
    (5, " \n\t ", "en", "c", 4, None, None),
    (None, "words without an id, mail a@b.org  twice  spaced", "en", None, 10, None, None),
    (6, "lorem ipsum " * 20_000, "en", "c", 240_000, None, None),
    (7, "é" * 300 + " 4249604924884952 +1 (979) 555-6697", "fr", "c", 5, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = Counter(duck.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall())
    assert Counter(map(tuple, got.select(*columns).collect())) == want


def test_url_rules(spark):
    urls = [
        "http://a.example.org/es/1", "HTTPS://A.EXAMPLE.ORG/en/12?x=1", "http://b.org", "http://b.org/q#f",
        "http://x.com/de/1", "no scheme", None, "", "http://h?q", "http://x.com/fr/",
    ]
    pages = spark.createDataFrame([(i, u, "h", "z") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:5] for r in url_rules.judge(pages, labels).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("b.org", "", None, "allow") and got[3] == ("b.org", "/q", "org/", "allow")
    assert got[4][2:] == ("com/de/", "block") and got[9][2:] == ("com/fr/", "allow")
    assert got[5] == got[6] == got[7] == ("", "", None, "allow") and got[8][:2] == ("h", "")


def test_url_mining(spark):
    rows = [(i, f"http://{'bad' if i % 4 == 0 else 'good'}{'' if i % 8 else 'x'}.net/{'spam' if i % 4 == 0 else 'p'}/{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    got = url_rules.judge(pages, labels).collect()
    assert all((r["verdict"] == "block") == (r["page_id"] % 4 == 0) for r in got) and len(got) == 400


def test_mixing_odd_rows(odd):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in got)
    # Whole documents only: a source is off its target by less than its largest document.
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    texts = Counter(r["text"] for r in mixed.collect())
    assert sum(len(words(t)) * n for t, n in texts.items()) == sum(r["taken"] for r in got)
    assert set(texts) <= {r[1] for r in ODD}
    assert mixing.mix(odd.limit(0)).count() == mixing.mixed_documents(odd.limit(0)).count() == 0


def test_mixing_near_targets(spark):
    """Null ids, a hot source and documents of 30,000 words: whole texts, and sources near their targets."""
    rows = [
        (None if i % 3 == 0 else i, f"w{i} " * (30_000 if i % 400 == 0 else 5 + i * 7 % 90), "abc"[min(2, i % 7)])
        for i in range(4_000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        taken = sum(r["taken"] for r in own)
        assert abs(taken - own[0]["target"]) <= 0.002 * own[0]["target"]
        assert {r["taken"] // r["size"] for r in own} <= {own[0]["repeats"], own[0]["repeats"] + 1}
    mixed = Counter((r["doc_id"], r["text"]) for r in mixing.mixed_documents(docs).collect())
    assert set(mixed) <= {r[:2] for r in rows} and max(mixed.values()) <= 3
    assert sum(len(t.split()) * n for (_, t), n in mixed.items()) == sum(r["taken"] for r in got)


def test_forward_backward():
    rng = np.random.default_rng(0)
    e, moves = rng.normal(size=6), rng.normal(size=(2, 2))
    total, want = 0.0, np.zeros(6)
    for z in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(e[i] * z[i] for i in range(6)) + sum(moves[z[i], z[i + 1]] for i in range(5)))
        total, want = total + w, want + w * np.array(z)
    long = rng.normal(size=300)
    f, b, _ = toxicity.marginals(long[None], moves)
    got = toxicity.long_marginals([e, np.zeros(0), long], moves)
    assert np.allclose(got[0], want / total) and np.allclose(got[2], (f * b / (1 + f * b))[0])


def test_toxicity(spark, odd):
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.scored(table(spark, "/root/testdata/sf0.1", "documents"), labels).join(labels, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert sum((r["toxic"] == 1) == (r["predicted"] == 1) for r in held) >= 0.95 * len(held)
    none = toxicity.tagged(odd, labels.limit(0)).collect()
    assert len(none) == len(ODD) and all(r["score"] == 0 for r in none)
    text = "You ARE stupid, stupid é!"
    assert toxicity.spans(text, np.array([0, 0, .9, .8, 0])) == [{"start": 8, "end": 22, "p": .9}]


def brute_components(texts):
    sets = {i: set(near_duplicates.shingles(t).tolist()) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(docs, rows):
    want = brute_components(rows)
    got = near_duplicates.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    kept = near_duplicates.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_near_duplicates_chain(spark):
    """A chain of texts, each like the next only, is one component."""
    base = [f"w{i}" for i in range(200)]
    texts = {i: " ".join([*(f"x{k}" for k in range(12 * i)), *base[12 * i:]]) for i in range(8)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(frame).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_odd_rows(odd):
    got = near_duplicates.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[2]["component_id"] == 1 and not by[2]["kept"] and by[4]["component_id"] == 4 and by[3]["n_shingles"] == 0
    assert near_duplicates.distinct_documents(odd).where("doc_id = 1").count() == 1


def test_rows_by_text(spark):
    """Null and repeated ids lose no group of near-duplicates and no clean document."""
    t = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    rows = [(None, t["a"]), (None, t["a"]), (None, t["b"]), (7, t["c"]), (7, t["c"]), (7, t["d"]), (5, t["d"]), (7, t["e"]), (None, t["c"]), (8, t["f"])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.distinct_documents(frame).collect()
    want = [(None, t["a"]), (None, t["b"]), (7, t["c"]), (5, t["d"]), (7, t["e"]), (8, t["f"])]
    assert Counter(map(tuple, got)) == Counter(want)
    bench = spark.createDataFrame([(1, t["a"]), (2, t["d"])], "item_id long, text string")
    left = phrase_index.clean_documents(frame, bench).collect()
    assert Counter(map(tuple, left)) == Counter(r for r in rows if r[1] not in (t["a"], t["d"]))


def test_recurrent_gradient():
    net = recurrent_lm.Network(np.array([5.0, 4, 3, 2, 1]), 2.0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    tokens, h0 = np.random.default_rng(0).integers(0, 6, (3, 6)), np.zeros((3, recurrent_lm.HIDDEN))

    def loss():
        h, t, total = h0, net.p["emb"] @ net.p["w"] + net.p["b"], 0.0
        for k in range(5):
            h = net.step(t[tokens[:, k]], h)[0]
            total -= net.log_probabilities(h, tokens[:, k + 1]).sum()
        return total / 15

    grads, _ = net.gradients(tokens, h0)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        down = loss()
        net.p[name][at] += 1e-5
        assert np.isclose((up - down) / 2e-5, g[at], rtol=1e-4)
    probabilities = np.exp(net.log_probabilities(np.repeat(np.random.default_rng(1).normal(size=(1, recurrent_lm.HIDDEN)), 6, 0), np.arange(6)))
    assert np.isclose(probabilities.sum(), 1)


def test_recurrent_scores(docs, rows, odd):
    counts = Counter()
    for i, text in rows.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*words(text), b""])
    n, v = sum(counts.values()), len(counts)
    got = recurrent_lm.scored(docs).collect()
    for r in got:
        own = [*words(rows[r["doc_id"]]), b""]
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert np.isclose(r["base_score"], base) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert recurrent_lm.scored(odd).count() == len(ODD) and recurrent_lm.scored(odd.limit(0)).count() == 0


def test_recurrent_learns_from_all(spark):
    """Two long documents among thousands of short ones are learned from to their ends."""
    long = " ".join(["left", "right"] * 2_500)
    texts = [long if i in (40, 2_000) else "a" for i in range(3_000)]
    ids = [i for i in range(9_000) if zlib.crc32(str(i).encode()) % 5 != 1][:3_000]
    frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = [r for r in recurrent_lm.scored(frame).collect() if r["n_tokens"] > 2]
    assert len(got) == 2 and all(r["score"] > 0.5 * r["base_score"] for r in got), got
    stream = np.arange(1, 5_001).astype("<u2")
    net, targets = recurrent_lm.Network(np.ones(6_000), 0.0), []
    plain = net.gradients
    net.gradients = lambda t, h, used: (targets.extend(t[:, 1:][used].tolist()), plain(t, h, used))[1]
    assert net.train([stream]) == 4_999 and sorted(targets) == list(range(2, 5_001))


def test_recurrent_gradient_of_documents():
    """With several documents in a row, gradients are those of documents on their own."""
    net = recurrent_lm.Network(np.array([5.0, 4, 3, 2, 1]), 2.0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    tokens, zero = np.array([[0, 3, 2, 0, 4, 1, 0]]), np.zeros((1, recurrent_lm.HIDDEN))
    both, _ = net.gradients(tokens, zero, np.ones((1, 6), bool))
    first, second = (net.gradients(tokens[:, a:a + 4], zero)[0] for a in (0, 3))
    assert all(np.allclose(both[k], (first[k] + second[k]) / 2, atol=1e-6) for k in both)


def test_recurrent_scores_in_lanes(monkeypatch):
    """Documents that share lanes are scored as each would be alone."""
    rng = np.random.default_rng(3)
    net = recurrent_lm.Network(np.arange(40.0, 0, -1), 5.0)
    documents = [np.append(rng.integers(1, 41, n), 0) for n in (0, 3, 200, 1, 70, 64, 0, 130, 9, 500)]
    table, want = net.p["emb"] @ net.p["w"] + net.p["b"], []
    for own in documents:
        h, total = np.zeros((1, recurrent_lm.HIDDEN), np.float32), 0.0
        for before, target in zip([0, *own[:-1]], own):
            h = net.step(table[[before]], h)[0]
            total += net.log_probabilities(h, np.array([target]))[0]
        want.append(total)
    for lanes in (1, 3, 1_024):
        monkeypatch.setattr(recurrent_lm, "GROUP", lanes)
        assert np.allclose(net.score(documents), want, rtol=1e-5)
    assert len(net.score([])) == 0


def test_recurrent_words():
    """Words are cut as elsewhere, in slices of batches too, and counted in less time than in Python."""
    rng = np.random.default_rng(4)
    parts = [" ", "  ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\x00", "É", "İ", *["a", "Bc", "DEF ", "the "] * 4]
    texts = ["".join(rng.choice(parts, n)) if n % 9 else None for n in rng.integers(0, 300, 6_000).tolist()]
    texts[4_096], texts[5_000] = "", " \n "
    for low, n in ((0, 6_000), (4_096, 1_904), (4_999, 2), (7, 1)):
        tokens, sizes = recurrent_lm._tokens(pa.array(texts).slice(low, n))
        want = [[*words(t), b""] for t in texts[low:low + n]]
        assert sizes.tolist() == [len(w) for w in want] and tokens.to_pylist() == [w for own in want for w in own]
    numbers = (1 / rng.random(1_000_000)).astype(np.int64).astype(str)
    batch = pa.record_batch({"text": [" ".join(numbers[k:k + 500]) for k in range(0, 1_000_000, 500)]})
    plain, own = [], []
    for _ in range(5):
        start, want = time.process_time(), Counter()
        for text in batch.column(0).to_pylist():
            want.update([*words(text), b""])
        plain.append(time.process_time() - start)
        start = time.process_time()
        rows = list(recurrent_lm._tally(iter([batch])))
        own.append(time.process_time() - start)
    counts = Counter()
    for row in (r for b in rows for r in b.to_pylist()):
        counts[row["token"]] += row["c"]
    assert counts == want and min(own) < 0.8 * min(plain), (own, plain)


def test_simple8b():
    rng = np.random.default_rng(1)
    for n, high in itertools.product((0, 1, 2, 1000, 40_000), (2, 300, 60_000, 2**32, 2**62)):
        ids = rng.integers(0, high, n).astype(np.uint64)
        ids[rng.random(n) < 0.3] = 0
        assert (token_files.unpack(*token_files.pack(ids), n) == ids).all()


def test_token_files(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    token_files.write(odd, str(tmp_path / "t"), path)
    got = token_files.read(spark, str(tmp_path / "t")).orderBy("start").collect()
    whole, at = Tokenizer.from_file(path), 0
    assert len(got) == len(ODD) and [r["doc_id"] for r in got] == [None, 1, 1, 2, 3, 4, 5, 6, 7]
    texts = {i: t or "" for i, t, *_ in ODD}
    for r in got:
        ids = [*whole.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0]
        assert (r["start"], bytes(r["ids"])) == (at, np.array(ids, "<u4").tobytes())
        at += len(ids)
    encode = token_files.Encoder(path)
    tricky = ["a  b", "a \n b", "\n a", " ", "x <|endoftext|> y", "don't 12,5 é ü", "tail ", "a\tb  \n", ""]
    assert encode(tricky) == [encode.encode_whole(t) for t in tricky]


def test_decontamination(spark, docs, rows, odd):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    bench = table(spark, SF_DIR, "benchmark")
    windows = {}
    for r in bench.collect():
        own = cut(r["text"])
        for k in range(max(1, len(own) - 12)):
            if own:
                windows.setdefault(tuple(own[k:k + 13]), set()).add(str(r["item_id"]))
    sizes = {len(w) for w in windows}
    for r in phrase_index.contamination(docs, bench).collect():
        own, hit, items = cut(rows[r["doc_id"]]), set(), set()
        for k, size in itertools.product(range(len(own)), sizes):
            met = windows.get(tuple(own[k:k + size])) if k + size <= len(own) else None
            if met:
                hit.update(range(k, k + size))
                items |= met
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (len(own), len(hit), len(items), sha)
    short = spark.createDataFrame([(1, "Brown fox"), (2, None), (2, "!"), (None, "lazy cat")], "item_id long, text string")
    got = phrase_index.contamination(odd, short).collect()
    assert len(got) == len(ODD) and {r["doc_id"] for r in got if r["contaminated"]} == {1, 2}
    clean = phrase_index.clean_documents(odd, short)
    assert clean.columns == odd.columns and clean.count() == len(ODD) - 3


def test_decontamination_blocks(docs, spark, monkeypatch):
    """Searching block by block gives the same rows, and a shifted word is a proximity match."""
    bench = table(spark, SF_DIR, "benchmark")
    whole = sorted(map(tuple, phrase_index.contamination(docs, bench).collect()))
    monkeypatch.setattr(phrase_index, "QUERY_WORDS", 400)
    assert sorted(map(tuple, phrase_index.contamination(docs, bench).collect())) == whole
    own = spark.createDataFrame([(1, "a b extra c d")], "doc_id long, text string")
    found = phrase_index.search(phrase_index.build(own), spark.createDataFrame([(9, "a b c d")], "item_id long, text string"))
    assert found.first()["items"] == [] and found.first()["near"] == ["9"]


def test_gif(odd):
    rng = np.random.default_rng(2)
    for data in (bytes(64), rng.integers(0, 256, 64 * 3000).astype(np.uint8).tobytes(), (b"the cat " * 90_000)[:64 * 9000]):
        frames = gif_media.decode(gif_media.encode(data))
        assert b"".join(f.area[..., 0].tobytes() for f in frames) == data
    got = gif_media.features(gif_media.store(odd)).collect()
    texts = {i: t for i, t, *_ in ODD}
    assert len(got) == len(ODD)
    for r in got:
        data, n = gif_media.payload(texts[r["doc_id"]])
        assert (r["n_bytes"], r["payload_sha256"], r["tail_crc32"]) == (n, hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))


def test_gif_colours():
    """Colours of equal brightness lie in different bins."""
    red, blue = np.zeros((4, 2, 3), np.uint8), np.zeros((4, 2, 3), np.uint8)
    red[..., 0] = blue[..., 2] = 200
    bins = gif_media.BINS
    assert gif_media.histogram(red) != gif_media.histogram(blue)
    assert gif_media.histogram(red)[200 * bins >> 8] == 8 and gif_media.histogram(blue)[2 * bins + (200 * bins >> 8)] == 8
    assert sum(gif_media.histogram(red)) == 24


def test_gif_rules():
    """Transparency, disposal, a local palette and interlacing of a hand-made file of two frames."""
    def image(samples, control, flags=0, palette=b""):
        return b"\x21\xf9\x04" + control + b"\0" + b"\x2c" + bytes(4) + b"\x01\0\x08\0" + bytes([flags]) + palette + b"\x08" + gif_media._blocks(gif_media.lzw_encode(bytes(samples)))

    red = bytes([9, 0, 0]) * 256
    gif = (
        b"GIF89a\x01\0\x08\0\xf7\0\0" + gif_media.GREY + image(range(8), bytes([1 << 2, 5, 0, 0]))
        + image([7, 7, 7, 7, 7, 7, 7, 0], bytes([2 << 2 | 1, 7, 0, 7]), 0xC7, red)
        + image([3] * 8, bytes([0, 1, 0, 0])) + b"\x3b"
    )
    first, second, third = gif_media.decode(gif)
    assert first.area[:, 0, 0].tolist() == list(range(8)) and first.delay_cs == 5
    # Interlaced: the last sample stored is row 7; 7 is transparent, so the first frame shows elsewhere.
    assert second.area[:, 0, 0].tolist() == [0, 1, 2, 3, 4, 5, 6, 9] and second.delay_cs == 7
    assert third.area[:, 0, 0].tolist() == [3] * 8


def test_quality(spark, odd):
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    got = quality.judged(table(spark, "/root/testdata/sf0.01", "documents"), labels).join(labels, "doc_id").collect()
    assert sum((r["quality"] == 1) == r["accepted"] for r in got) >= 0.97 * len(got)
    assert quality.judged(odd, labels).count() == len(ODD)
    assert quality.accepted_documents(odd, labels.limit(0)).count() == len(ODD)
    assert quality.judged(odd.limit(0), labels).count() == 0


def test_quality_held_out(spark):
    """Labels of a fifth of the documents are kept back; both kinds must be found among them."""
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    got = quality.judged(docs, labels.where("doc_id % 5 != 0")).join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
    bad = [r for r in got if r["quality"] == 0]
    refused = [r for r in got if not r["accepted"]]
    hits = sum(not r["accepted"] for r in bad)
    assert len(bad) > 50 and hits >= 0.85 * len(bad) and hits >= 0.85 * len(refused)


def test_quality_pool_is_whole(spark, monkeypatch):
    """Every unlabelled document that a view is sure of may be drawn: null ids and repeated rows too, none twice."""
    monkeypatch.setattr(quality, "PER_ROUND", 1_000)
    rows = [(i if i % 3 else None, f"word{i} text", "en", "s") for i in range(300)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame([(str(i), 1) for i in range(0, 300, 10)], "id string, quality int")

    class Sure:
        def logits(self, views):
            return np.column_stack([np.full(len(views), 9.0), np.zeros(len(views))])

    taught = quality.sure_of(quality.features(docs), known, Sure(), 0)
    labelled = sum(1 for i in range(0, 300, 10) if i % 3)
    assert len(taught["text"][1]) == 300 - labelled and taught["text"][1].all() and not len(taught["meta"][1])


def test_content_shares():
    text = ("Ab cab " * 40).encode()
    got = quality.content_shares(text, text.lower().split())
    low = text.lower()
    grams = Counter((int.from_bytes(low[i:i + 4], "big") * 2_654_435_761 % 2**64 >> 20) % 128 for i in range(len(low) - 3))
    want = [np.sqrt(grams[b] / (len(low) - 3)) for b in range(128)]
    assert np.allclose(got[128:], want) and np.isclose((got[:128] ** 2).sum(), 1)


def test_pii_patterns(spark, odd):
    base = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    rng, texts = np.random.default_rng(5), ["a@b.com_x@y.com@z.w", "1.2.3.4.5 256.1.1.1 00255.0.0.01", "GB82 WEST 1234 5698 7654 32"]
    texts += ["".join(rng.choice(list("a@.+(-) 0123456789b"), 400)) for _ in range(60)]
    texts += ["4249604924884952 +1 (979) 555-6697 bank IBAN DE89370400440532013000", "1" * 40_000, "a" * 50_000]
    got = pii.digest(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    for r in got:
        spans = []
        for rank, (kind, pattern) in enumerate(base.items()):
            if kind == "email" and len(texts[r["doc_id"]]) > 10_000:
                continue
            for m in re.finditer(pattern, texts[r["doc_id"]]):
                d = re.sub("[^0-9]", "", m.group())
                ok = {"email": True, "ip": kind == "ip" and max(map(int, m.group().split("."))) <= 255,
                      "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
                if ok:
                    spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
        want = ",".join(s for *_, s in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (r, want)
    assert [r["spans"] for r in got if "iban" in r["spans"]][0] == "iban:0:27"
    plan = pii.find(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and pii.find(odd).count() == len(ODD)


def test_pii_iban_before_words(spark):
    """What follows an IBAN, or looks like one before it, does not hide it."""
    plain, spaced = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    texts = {
        f"{plain} Please": [plain], f"IBAN {plain} BIC COBADEFF": [plain], f"{spaced} 2024": [spaced], f"{plain}EUR 5": [plain],
        f"{plain} {spaced} NO9386011117947 OK": [plain, spaced, "NO9386011117947"], f"REF AB12 {plain} Z": [plain],
        "DE89370400440532013001 Please": [], plain[:-1]: [], f"é {plain}\n7": [plain], "DE8 DE89": [],
    }
    got = pii.find(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    for r in got:
        text, want = list(texts.items())[r["doc_id"]]
        assert [text[s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "iban"] == want, text


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        docs = kept
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_parts_of_chunks_are_encoded_once():
    """Words inside a chunk, such as the runs of a hexadecimal number, are remembered like chunks are."""
    from rowloom.llm import token_files
    from rowloom.llm.queries import tokenizer_path

    encode = token_files.Encoder(tokenizer_path())
    texts = ["a 12ab34 éé%%% word%%%", "x (12ab56) word %%%b  c", "y 34ab12,ab \nz"]
    assert encode(texts) == [encode.encode_whole(t) for t in texts]
    assert {"12", "ab", "34", "%%%"} <= {w.strip() for w in encode.parts}


def test_chunks_are_made_once_and_looked_up_directly():
    made = []
    known = token_files.Remembered(lambda chunk: made.append(chunk) or chunk.encode())
    assert b"".join(map(known.__getitem__, ["a", "b", "a"])) == b"aba"
    assert made == ["a", "b"]


def test_small_batches_hold_inside_the_block_only(spark):
    before = spark.conf.get(BATCH_ROWS)
    with small_batches(spark, 100):
        sizes = spark.range(1000).coalesce(1).mapInArrow(lambda bs: (b.slice(0, 1) for b in bs), "id long").count()
        assert sizes == 10
    assert spark.conf.get(BATCH_ROWS) == before


def test_what_pipeline_stages_return_goes_to_python_in_small_batches(docs, spark, monkeypatch):
    """The check and other callers write what a stage returns themselves, outside of ``run``."""
    import corpus_pipeline

    before = spark.conf.get(BATCH_ROWS)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)
    rows = lambda *_: spark.range(0, 2000, 1, 1).mapInArrow(sizes, "n long")
    monkeypatch.setattr(quality, "accepted_documents", rows)
    monkeypatch.setattr(near_duplicates, "distinct_documents", rows)
    monkeypatch.setattr(phrase_index, "clean_documents", rows)
    monkeypatch.setattr(mixing, "mixed_documents", rows)
    monkeypatch.setattr(token_files, "write", lambda *_, **__: None)
    monkeypatch.setattr(token_files, "read", rows)
    monkeypatch.setattr(token_files, "digest", rows)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(BATCH_ROWS, before)
            found = stage(spark, docs, SF_DIR)
            assert [r["n"] for r in found.collect()] == [512, 512, 512, 464]
    finally:
        spark.conf.set(BATCH_ROWS, before)


def test_an_encoder_that_remembers_little_gives_the_same_ids():
    from rowloom.llm.queries import tokenizer_path

    texts = [f"word{i % 300} other{i}, and {i * 7} more words." for i in range(2000)]
    small, usual = token_files.Encoder(tokenizer_path(), 50), token_files.Encoder(tokenizer_path())
    for start in range(0, len(texts), 20):
        assert small(texts[start:start + 20]) == usual(texts[start:start + 20])
        assert max(len(small.cache), len(small.older), len(small.parts)) < 50 + 20 * 10
