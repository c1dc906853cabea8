"""Near-duplicates by one-permutation MinHash, banded buckets and star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import content, pieces, words
from rowloom.plans.scratch import materialize

SHINGLE = 5
#: Link if 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: Bins of the signature: BANDS bands of ROWS bins.  A pair at the threshold misses
#: all bands with probability (1 - 0.75 ** 4) ** 32 = 5e-6.
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
#: Bits of the parity sketch that rules out candidates inside the joins that make them, and
#: how many standard deviations a sketch may be off before a pair is ruled out.  The
#: first rounds, of so many centres a bucket, try only pairs whose sketches are within the mean at the threshold,
#: so that groups grow together before the many pairs near the threshold are tried.
SKETCH_BITS = 1024
SIGMAS = 4.5
EAGER_CENTRES = (4, 32)
#: Ids of candidate documents are broadcast up to this size; beyond it they are joined by shuffle.
BROADCAST_BYTES = 64 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that high bits choose a bin and the rest order it."""
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a short text is one shingle, no words none."""
    own = words(text)
    if not own:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    size = min(SHINGLE, len(own))
    total = np.full(len(own) - size + 1, size, np.uint64)
    for k in range(size):
        total = total * _M1 + hashes[k:len(own) - size + 1 + k]
    return np.unique(mixed(total))


#: Where an empty bin looks for a value: a sequence of its own for each bin.
_PROBES = (mixed(np.arange(BINS * 1024, dtype=np.uint64)) % np.uint64(BINS)).astype(np.int64).reshape(BINS, -1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """One-permutation MinHash: the least hash of each bin; empty bins are filled by optimal densification.

    An empty bin takes the value of the first filled bin in its own sequence
    of probes, so that filled bins are drawn evenly and independently.
    """
    bins, first = np.unique((hashes >> np.uint64(57)).astype(np.int64), return_index=True)
    values = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    values[bins], filled[bins] = hashes[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        hit = filled[_PROBES[empty]]
        source = _PROBES[empty, hit.argmax(axis=1)]
        source[~hit.any(axis=1)] = bins[0]
        values[empty] = values[source]
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """One bucket number for each band of a signature."""
    total = np.arange(BANDS, dtype=np.uint64)
    for column in values.reshape(BANDS, ROWS).T:
        total = mixed(total * _M2 + column)
    return total.view(np.int64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities of the set over ``SKETCH_BITS`` cells, as 64-bit words: two sets differ where their difference falls oddly."""
    cells = np.bincount((hashes & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 512):
        high, low, sizes, buckets, sketches = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            own = shingles(text)
            key = xxhash.xxh3_128_digest(own.tobytes())
            high.append(int.from_bytes(key[:8], "little", signed=True))
            low.append(int.from_bytes(key[8:], "little", signed=True))
            sizes.append(len(own))
            buckets.append(bands(signature(own)) if len(own) else [])
            sketches.append(sketch(own) if len(own) else [])
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
            pa.array(sizes, pa.int64()), pa.array(buckets, pa.list_(pa.int64())),
            pa.array(sketches, pa.list_(pa.int64())),
        ], names=["doc_id", "content", "node", "check", "n_shingles", "buckets", "sketch"])


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, content, node, check, n_shingles, buckets, sketch`` of each row.

    ``node, check`` name its shingle set, ``content`` its text.
    """
    ids = docs.select("doc_id", "text", content(docs).alias("content"))
    kind = ids.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, content long, node long, check long, n_shingles long, buckets array<long>, sketch array<long>"
    return materialize(ids.mapInArrow(_sign, ddl), "near-signed")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256):
        sets = [shingles(text) for text in batch.column(0).to_pylist()]
        keys = [xxhash.xxh3_128_digest(own.tobytes()) for own in sets]
        yield pa.RecordBatch.from_arrays([
            pa.array([int.from_bytes(k[:8], "little", signed=True) for k in keys], pa.int64()),
            pa.array([own.tobytes() for own in sets], pa.binary()),
        ], names=["node", "shingles"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256):
        keep = []
        for a, b in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= THRESHOLD * (len(a) + len(b) - common))
        chosen = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return materialize(met.mapInArrow(_linked, "a long, b long"), "near-links")


def labels(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node reachable, for every node of ``edges``; least neighbours, then jumps."""
    both = materialize(edges.select("a", "b").unionAll(edges.select(F.col("b"), F.col("a"))), "near-both")
    current = materialize(
        both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("label")
        ), "near-labels"
    )
    while True:
        far = current.select(F.col("node").alias("b"), F.col("label").alias("theirs"))
        best = both.join(far, "b").groupBy("a").agg(F.min("theirs").alias("theirs"))
        lower = current.join(best, current["node"] == best["a"]).select(
            "node", F.least("label", "theirs").alias("label"), F.col("label").alias("old")
        )
        jump = current.select(F.col("node").alias("label"), F.col("label").alias("next"))
        following = materialize(
            lower.join(jump, "label", "left").select(
                "node", F.least("label", F.coalesce("next", "label")).alias("label"), "old"
            ), "near-labels"
        )
        current = following.select("node", "label")
        if following.where("label < old").isEmpty():
            return current


def relabelled(known: DataFrame, new: DataFrame) -> DataFrame:
    """Components after links between components: ``known`` maps nodes, ``new`` maps labels."""
    moved = new.select(F.col("node").alias("label"), F.col("label").alias("to"))
    return materialize(
        known.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")),
        "near-components",
    )


def buckets(classes: DataFrame) -> DataFrame:
    """``node, bucket, centre, n, sketch`` for buckets of two nodes or more; the centre is the least node."""
    members = classes.select(F.explode("buckets").alias("bucket"), "node")
    stars = members.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("m"))
    shared = members.join(stars.where("m > 1").select("bucket", "centre"), "bucket")
    own = classes.select("node", F.col("n_shingles").alias("n"), "sketch")
    return materialize(shared.join(own, "node"), "near-buckets")


def may_link(n: Column, own: Column, cn: Column, theirs: Column, sigmas: float) -> Column:
    """Whether sizes and sketches leave a link possible.

    At the threshold two sets differ in (n + cn) / 7 shingles at most (25 / 175);
    the sketches of sets d apart differ in bits / 2 * (1 - exp(-2 d / bits)) cells,
    with the variance bits / 4 * (1 - e) - e * d, e = exp(-4 d / bits).  The condition
    is part of a join, which so emits only pairs worth a full comparison.
    """
    sizes = 100 * F.least(n, cn) >= THRESHOLD * F.greatest(n, cn)
    most = (n + cn) * ((100.0 - THRESHOLD) / (100 + THRESHOLD))
    mean = (1 - F.exp(most * (-2.0 / SKETCH_BITS))) * (SKETCH_BITS / 2)
    e = F.exp(most * (-4.0 / SKETCH_BITS))
    deviation = F.sqrt(F.greatest((1 - e) * (SKETCH_BITS / 4) - e * most, F.lit(0.0)))
    cells = sum((F.bit_count(own[i].bitwiseXOR(theirs[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return sizes & (cells <= mean + sigmas * deviation + 2)


def sets_of(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """``node, shingles`` of every node that shares a bucket, from one document of each.

    Only these documents are read again; the others' sets are never stored.
    """
    nodes = members.select("node").distinct()
    wanted = materialize(
        classes.join(nodes, "node").select("node", F.col("id").alias("_id")), "near-wanted"
    )
    ids = wanted.select("_id").distinct()
    if wanted.count() * 16 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    text = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = text.select("text").mapInArrow(_sets, "node long, shingles binary")
    return materialize(
        found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "near-sets"
    )


def pairs_of(chosen: DataFrame, placed: DataFrame, sigmas: float, every: DataFrame | None = None) -> DataFrame:
    """Pairs of each centre with the members of its bucket in other components that may be linked.

    With ``every``, the buckets of each node, a pair is made only in the first
    bucket that its nodes share.
    """
    if every is not None:
        chosen, placed = chosen.join(every, "node"), placed.join(every, "node")
    c = chosen.select(*[F.col(x).alias(f"c_{x}") for x in chosen.columns])
    possible = (F.col("bucket") == F.col("c_bucket")) & (F.col("label") != F.col("c_label")) & may_link(
        F.col("n"), F.col("sketch"), F.col("c_n"), F.col("c_sketch"), sigmas
    )
    if every is not None:
        place = F.array_position("buckets", F.col("bucket")).cast("int") - 1
        earlier = [F.slice(own, F.lit(1), place) for own in ("buckets", "c_buckets")]
        possible = possible & ~F.arrays_overlap(*earlier)
    return placed.join(c, possible).select(
        F.least("c_node", "node").alias("a"), F.greatest("c_node", "node").alias("b")
    ).distinct()


def components(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, label`` of all nodes that are linked with another.

    First each node is tried with the least centre it has: one pair a node.
    Sizes and sketches rule out most pairs that are not linked, inside the joins.
    Then buckets that still hold several components go on in rounds: centres are
    chosen among the members outside a bucket's largest component, and are
    paired with all members of other components; more of them in the second round,
    and in the last one all.  A bucket of one component gives no pairs.  In the end
    every pair of a bucket is joined, was tested or is ruled out by its
    sketch.  That loses a link at the threshold whose sketches are off by more than
    SIGMAS standard deviations, about 3 in a million by the normal approximation.
    """
    members = buckets(classes)
    sets = sets_of(docs, classes, members)
    nodes = materialize(members.groupBy("node").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch")
    ), "near-nodes")
    star = members.where("node <> centre").select("node", "centre", "n", "sketch").distinct()
    c = nodes.select(F.col("node").alias("c_node"), F.col("n").alias("c_n"), F.col("sketch").alias("c_sketch"))
    near = star.join(c, (F.col("centre") == F.col("c_node")) & may_link(
        F.col("n"), F.col("sketch"), F.col("c_n"), F.col("c_sketch"), SIGMAS
    ))
    first = near.groupBy("node").agg(F.min("centre").alias("a")).select("a", F.col("node").alias("b"))
    tested = materialize(first, "near-tested")
    links = confirmed(tested, sets)
    alone = nodes.select("node", F.col("node").alias("label"))
    known = relabelled(alone, labels(links))
    every = materialize(classes.select("node", "buckets").join(nodes.select("node"), "node", "left_semi"), "near-every")
    for centres in (*EAGER_CENTRES, None):
        placed = members.drop("centre").join(known, "node")
        spread = placed.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l < h")
        placed = materialize(placed.join(spread.select("bucket"), "bucket", "left_semi"), "near-placed")
        if placed.isEmpty():
            break
        parts = placed.groupBy("bucket", "label").count()
        largest = parts.groupBy("bucket").agg(F.max(F.struct("count", "label"))["label"].alias("most"))
        waiting = placed.join(largest, "bucket").where("label <> most").drop("most")
        if centres:
            slot = F.pmod(F.xxhash64("node"), F.lit(centres))
            least = waiting.groupBy("bucket", slot.alias("slot")).agg(
                F.min(F.struct("node", "label", "n", "sketch")).alias("c")
            )
            pairs = pairs_of(least.select("bucket", "c.*"), placed, 0.0)
        else:
            pairs = pairs_of(waiting, placed, SIGMAS, every)
        new = materialize(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        links = confirmed(new, sets)
        tested = tested.unionAll(new)
        if not links.isEmpty():
            u, v = (known.select(F.col("node").alias(c), F.col("label").alias(f"{c}l")) for c in "ab")
            between = links.join(u, "a").join(v, "b").select(F.col("al").alias("a"), F.col("bl").alias("b"))
            known = relabelled(known, labels(between.where("a <> b").distinct()))
    return known


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and ``node, id, row, label`` of each shingle set: its least id, its first row, its component.

    ``row`` is ``no_id, doc_id, content``: rows with ids come first.
    """
    rows = signed(docs)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")
    classes = materialize(
        rows.where("n_shingles > 0").groupBy("node", "check").agg(
            F.min("doc_id").alias("id"), F.min(row).alias("row"), F.first("n_shingles").alias("n_shingles"),
            F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"),
        ), "near-classes"
    )
    known = components(docs, classes)
    return rows, classes.select("node", "id", "row").join(known, "node", "left").select(
        "node", "id", "row", F.coalesce("label", "node").alias("label")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Rows with equal shingle sets are one node of the graph from the start,
    so exact copies cost one row each and are never paired.  The component's id is
    the least document id in it.  Null and empty texts have no shingles, are
    linked with nothing and keep their own id.  Null ids are never least; a
    component of null ids only has none, and is not kept.  Repeated rows are in
    one component and each returned.  Nodes are named by 64 bits of a 128-bit digest.
    """
    rows, named = grouped(docs)
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    found = named.join(least, "label").select("node", "component_id")
    with_words, without = rows.where("n_shingles > 0"), rows.where("n_shingles = 0")
    out = with_words.join(found, "node").select("doc_id", "n_shingles", "component_id").unionAll(
        without.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.withColumn("kept", kept)


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``; rows without words all stay.

    A row is known by its id and its text, so null and repeated ids lose nothing: the
    row of the least id stays, of several texts the first in order of a hash, and of equal rows one.
    """
    _, named = grouped(docs)
    first = named.groupBy("label").agg(F.min("row").alias("row")).select(
        F.col("row.doc_id").alias("_id"), F.col("row.content").alias("_first")
    )
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    own = Window.partitionBy("doc_id", "_content").orderBy("text")
    worded = docs.where(~empty).withColumn("_content", content(docs)).join(
        first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_content") == F.col("_first")), "left_semi"
    ).withColumn("_copy", F.row_number().over(own))
    return docs.where(empty).unionByName(worded.where("_copy = 1").select(*docs.columns))
