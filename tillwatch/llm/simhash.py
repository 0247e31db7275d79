"""SimHash near-duplicates, linked by BK-trees.

A document's fingerprint has 64 bits. Two fingerprints link if they differ in at most `RADIUS` bits,
and documents that links connect form a component.

Every distinct fingerprint is put into six shards, one for each pair of its four 16-bit blocks: two
fingerprints with two differing bits agree in at least two blocks, so some shard holds both. A shard
over `SHARD_LIMIT` is cut again, by the blocks of four bits in which two members may differ; such a
shard cannot hold more than 256 distinct fingerprints. One BK-tree is built for each shard, whose
size is thus bounded, and the shard's fingerprints are looked up in it, following only edges whose
distance is within the radius. All trees together grow with the corpus, so a tree travels to the
tasks that ask it and not to every executor. A shard reports its links as one link to the smallest
member for each member, not as pairs.

Nulls: a null or blank text has fingerprint zero and links like any other; a null doc_id joins its
component and is its id only where the whole component has none. Repeated rows give repeated rows.
Columns other than doc_id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import arrow_rows, map_arrow, text_of, unused
from tillwatch.sources.store import Store

SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD_LIMIT = 256
CHUNK = 1 << 16


def _hashes(words: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles, in arrays of at most CHUNK."""
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    for i in range(0, n, CHUNK):
        to = min(i + CHUNK, n)
        yield np.fromiter(
            (digest(joined[s : e - 1], SEED) for s, e in zip(starts[i:to], ends[i + last : to + last], strict=True)),
            np.uint64,
            to - i,
        )


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text; zero if it has no word."""
    words = text.lower().split()  # bytes: only A-Z change, and only ASCII white space separates
    if not words:
        return 0
    ones, n = np.zeros(64, np.int64), 0
    for h in _hashes(words, shingle):
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text, and the fingerprint as a signed long."""

    def make(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, texts, hashes = batch.columns
        for i, t, h in zip(ids, texts, hashes, strict=True):
            yield i.as_py(), h.as_py(), _signed(fingerprint(t.as_py(), shingle))

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().cast("binary").alias("text"),
        F.xxhash64(text_of()).alias("text_hash"),
    )
    return map_arrow(rows, arrow_rows(make, _FINGERPRINTS), "doc_id long, text_hash long, fp long")


class BKTree:
    """Integers by Hamming distance: a child hangs on the edge that is its distance to the parent."""

    def __init__(self):
        self.root = None
        self.children: dict[int, dict[int, int]] = {}

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = value
            self.children[value] = {}
            return
        node = self.root
        while distance := (node ^ value).bit_count():
            below = self.children[node]
            if distance not in below:
                below[distance] = value
                self.children[value] = {}
                return
            node = below[distance]

    def within(self, value: int, radius: int) -> list[int]:
        found, waiting = [], [] if self.root is None else [self.root]
        while waiting:
            node = waiting.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            below = self.children[node]
            waiting += [below[d] for d in range(distance - radius, distance + radius + 1) if d in below]
        return found


def shard_links(members: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Each member that is connected to a smaller one, with the smallest that links connect it to."""
    tree, parent = BKTree(), {}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in members:
        parent[value] = value
        for other in tree.within(value, radius):
            a, b = top(value), top(other)
            parent[max(a, b)] = min(a, b)
        tree.add(value)
    return ((x, top(x)) for x in members if parent[x] != x)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _unsigned(fps: np.ndarray) -> list[int]:
    return fps.astype(np.int64).view(np.uint64).tolist()


def _link_shards(radius: int):
    """Over rows sorted by shard: hold one shard at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links(kind, key, fp, cuts):
            out = []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e - s > 1:
                    out += [(_signed(a), _signed(b)) for a, b in shard_links(_unsigned(fp[s:e]), radius)]
            if out:
                a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_LINKS)

        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            kind, key, fp = (np.concatenate(c) for c in zip(*held, strict=True))
            if not len(fp):
                held = []
                continue
            new = np.flatnonzero((kind[1:] != kind[:-1]) | (key[1:] != key[:-1])) + 1
            cuts = np.concatenate([[0], new])
            yield from links(kind, key, fp, cuts)
            held = [(kind[cuts[-1] :], key[cuts[-1] :], fp[cuts[-1] :])]
        if held:
            kind, key, fp = held[0]
            yield from links(kind, key, fp, [0, len(fp)])

    return run


def _shards(fps: DataFrame, blocks: int, together: int, first: int = 0) -> DataFrame:
    """fp with each (kind, key): the bits of `together` blocks out of `blocks`, and which they are.

    The key keeps its bits in place, so fingerprints share it only if they agree in all of them.
    """
    width = 64 // blocks
    masks = [
        sum(((1 << width) - 1) << (width * b) for b in kept) for kept in combinations(range(blocks), together)
    ]
    keys: list[Column] = [
        F.struct(F.lit(first + i).alias("kind"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("at")).select("at.kind", "at.key", "fp")


def links(fps: DataFrame, store: Store, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """(a, b): distinct fingerprints and a smaller one connected to each, over all shards."""
    if radius > 2:
        raise ValueError("the shards find differences of at most two bits")
    coarse = _shards(fps, 4, 2)
    crowded = store.keep(coarse.groupBy("kind", "key").count().where(F.col("count") > limit).select("kind", "key"), "crowded")
    few = coarse.join(crowded, ["kind", "key"], "left_anti")
    # Two members of a crowded shard differ in at most 2 of 16 blocks of 4 bits; 14 blocks fixed
    # leave 8 free bits.
    many = _shards(coarse.join(crowded, ["kind", "key"], "left_semi").select("fp").distinct(), 16, 14, first=100)
    shards = few.select("kind", "key", "fp").union(many)
    partitions = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shards.repartition(partitions, "kind", "key").sortWithinPartitions("kind", "key", "fp")
    return map_arrow(dealt, _link_shards(radius), "a long, b long").distinct()


def connected(edges: DataFrame, store: Store) -> DataFrame:
    """(a, b): each node with a link and, unless it is that itself, the smallest node of its component.

    Alternates large-star and small-star steps, each written to the shared folder, until nothing changes. A step's
    files go once the step that reads them is written.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = store.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store.keep(large, "large_star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.explode(F.array(F.col("a"), F.col("b")))
        small = large.join(low, "a").select(ends.alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = store.keep(small, "small_star")
        for written, but in (("links", 0), ("large_star", 0), ("small_star", 1)):
            store.drop(written, but)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, text_hash, fp, component_id (the smallest doc_id), representative.

    `representative` is (no_id, doc_id, fp, text_hash) of the row that stands for the component.
    """
    store = Store(documents.sparkSession)
    rows = store.keep(fingerprints(documents, shingle), "simhash")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash")
    distinct = store.keep(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct_simhash")
    roots = connected(links(distinct.select("fp"), store, radius), store)
    of_fp = distinct.join(roots.withColumnsRenamed({"a": "fp", "b": "root"}), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    of_root = of_fp.groupBy("root").agg(F.min("first").alias("representative"))
    found = store.keep(of_fp.join(of_root, "root").select("fp", "representative"), "components")
    return rows.join(found, "fp").select(
        "doc_id", "text_hash", "fp", F.col("representative.doc_id").alias("component_id"), "representative"
    )


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents that stand for their components, with the columns they had.

    Of rows with the representative's doc_id and text the first by a hash of all columns stays, whatever the
    order of the input; rows that repeat wholly are one.
    """

    def key(doc_id: str, text_hash: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), text_hash.cast("string"))

    representatives = near_duplicates(documents, shingle, radius).select("representative.*").distinct()
    name, first = unused("_key", documents.columns), unused("_first", documents.columns)
    kept = Store(documents.sparkSession).keep(
        representatives.select(key("doc_id", F.col("text_hash")).alias(name)), "representatives"
    )
    return (
        documents.withColumn(name, key("doc_id", F.xxhash64(text_of())))
        .join(kept, name, "left_semi")
        .withColumn(first, F.row_number().over(Window.partitionBy(name).orderBy(F.xxhash64(*documents.columns))))
        .where(F.col(first) == 1)
        .select(*documents.columns)
    )
