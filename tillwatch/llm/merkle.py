"""Merkle manifest of a dataset, by time-forward processing.

Each row is a leaf, the SHA-256 of its fields. The leaves of a source, in order of doc_id, are the lowest
level of its tree; every `ARITY` consecutive nodes become the SHA-256 of their digests (as hex text, joined)
until one is left, the subroot. The subroots, in order of source, make a tree in the same way: the root.

A node is labelled by its level and its place, and labels give the order of time. Rather than look its
children up, a node finds their digests in a priority queue ordered by the label of the receiver: a
child sends its digest forward to its parent's time. The reversed sweep goes from the top to the leaves, and
each node sends its children what lies between them and the root: a leaf's proof is its siblings at each
level, and the suffix that it shares with its siblings comes from above.

At scale the nodes are cut into blocks of ARITY ** LEVELS consecutive ones of a tree, so a hot source is many
blocks. One Spark job sweeps all blocks of a height, each within a task that reads its nodes in order; the blocks'
tops are the nodes of the next job. There are log(leaves) / log(ARITY ** LEVELS) jobs up, and as many down, where
a block gets its suffix as a message that the shuffle sorts before its nodes. The queue of a block spills
sorted runs to temporary files of the task beyond `HELD` messages.

Nulls: a null field is `-`; a null source is a tree of its own, before the others; null doc_ids come first.
Rows with one doc_id in a source are ordered by their digest; rows equal in all fields tie, which changes
no digest. An empty table gives an empty result. Other columns than the five fields are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import map_arrow
from tillwatch.sources.store import Store

#: Fixed values of the format: the fields of a leaf, and how many nodes make one.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: A block has ARITY ** LEVELS nodes; its queue keeps this many messages in memory.
LEVELS, HELD = 6, 8_192
OUT_ROWS = 512


def digest_of(fields: Iterable[Column]) -> Column:
    """SHA-256 (hex) of the fields: `-` for a null, else the UTF-8 length, a colon and the value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def leaf(text: Column | None = None) -> Column:
    """The digest of a row, with another text than its own where one is given."""
    return digest_of([F.col(f) if f != "text" or text is None else text for f in FIELDS])


def combined(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class MessageQueue:
    """Messages in order of their keys; beyond `held` of them, sorted runs wait in temporary files."""

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.runs = held, [], []

    def send(self, key: tuple, message) -> None:
        heapq.heappush(self.heap, (key, message))
        if len(self.heap) > self.held:
            self.heap.sort(key=lambda x: x[0])
            file, count = tempfile.TemporaryFile(), len(self.heap)
            for one in self.heap:
                pickle.dump(one, file)
            file.seek(0)
            self.heap = []
            run = self._read(file, count)
            heapq.heappush(self.runs, (*next(run), len(self.runs), run))

    @staticmethod
    def _read(file, count: int) -> Iterator[tuple]:
        with file:
            for _ in range(count):
                yield pickle.load(file)

    def first(self) -> tuple | None:
        """The smallest key, or None if nothing is left."""
        return min((x[0][0] for x in (self.heap, self.runs) if x), default=None)

    def take(self):
        """The message with the smallest key."""
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0][0]):
            _, message, number, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (*following, number, run))
            return message
        return heapq.heappop(self.heap)[1]


class Suffix(NamedTuple):
    """What lies between a node and the root: the siblings left and right of it, and its parent's suffix."""

    before: str
    after: str
    above: Suffix | None

    def steps(self) -> Iterator[tuple[str, str]]:
        step = self
        while step is not None:
            yield step.before, step.after
            step = step.above


def written(suffix: Suffix | None) -> str:
    """`before|after` of each level up to the root, joined by `/`."""
    return "/".join(f"{before}|{after}" for before, after in suffix.steps()) if suffix else ""


def read(text: str) -> Suffix | None:
    suffix = None
    for step in reversed(text.split("/") if text else []):
        suffix = Suffix(*step.split("|"), suffix)
    return suffix


def folded(digest: str, suffix: Suffix | None) -> str:
    """The root that a leaf's digest and its siblings make."""
    for before, after in suffix.steps() if suffix else ():
        digest = combined((before, digest, after))
    return digest


def forward(digests: list[str], whole_tree: bool, levels: int = LEVELS, held: int = HELD) -> tuple[str, list]:
    """The top of a block, and its inner nodes in order of time as (level, place, digests of the children).

    A block that is a whole tree ends with one node, others at the height of the next job's nodes.
    """
    queue, log, n = MessageQueue(held), [], len(digests)
    if whole_tree and n == 1:
        return digests[0], log
    for place, digest in enumerate(digests):
        queue.send((1, place // ARITY, place % ARITY), digest)
    while True:
        level, place, _ = queue.first()
        children = []
        while (key := queue.first()) and key[:2] == (level, place):
            children.append(queue.take())
        digest = combined(children)
        log.append((level, place, children))
        alone = -(-n // ARITY**level) == 1
        if level == levels or whole_tree and alone:
            return digest, log
        queue.send((level + 1, place // ARITY, place % ARITY), digest)


def backward(log: list, count: int, top: Suffix | None, held: int = HELD) -> Iterator[Suffix | None]:
    """The suffixes of a block's nodes in their order, from its top's suffix."""
    if not log:
        return iter([top] * count)
    queue = MessageQueue(held)
    queue.send((-log[-1][0], log[-1][1]), top)
    for level, place, children in reversed_levels(log):
        above = queue.take()
        for i in range(len(children)):
            suffix = Suffix("".join(children[:i]), "".join(children[i + 1 :]), above)
            queue.send((1 - level, place * ARITY + i), suffix)
    return (queue.take() for _ in range(count))


def reversed_levels(log: list) -> list:
    """The log from the top level down, each level from left to right."""
    return sorted(log, key=lambda node: (-node[0], node[1]))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The rows of each (tree, block), which are the first two columns."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    return itertools.groupby(rows(), key=lambda row: row[:2])


def _emitted(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while held := list(itertools.islice(rows, OUT_ROWS)):
        arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow(kinds: str) -> pa.Schema:
    types = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(name, types[kind]) for name, kind in (part.split() for part in kinds.split(", "))])


_UP = "tree string, place long, size long, digest string"


def _sweep_up(levels: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[tuple]:
            for (tree, block), rows in _blocks(batches):
                nodes = list(rows)
                blocks = -(-nodes[0][3] // ARITY**levels)
                top, _ = forward([n[4] for n in nodes], blocks == 1, levels)
                yield tree, block, blocks, top

        return _emitted(tops(), _arrow(_UP))

    return run


_DOWN = "tree string, place long, path string, subroot string, root string"
_LEAVES = f"doc_id long, leaf string, folded_root string, {_DOWN}"


def _sweep_down(levels: int, leaves: bool) -> Callable:
    """Each block's first row is the message of its top's path; the others are its nodes.

    Leaves also get the root that their claimed digest makes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (tree, _), rows in _blocks(batches):
                *_, path, subroot, root = next(rows)
                nodes = list(rows)
                blocks = -(-nodes[0][3] // ARITY**levels)
                _, log = forward([n[4] for n in nodes], blocks == 1, levels)
                for node, suffix in zip(nodes, backward(log, len(nodes), read(path)), strict=True):
                    below = (tree, node[2], written(suffix), subroot, root)
                    yield (node[5], node[4], folded(node[6] or node[4], suffix), *below) if leaves else below

        return _emitted(found(), _arrow(_LEAVES if leaves else _DOWN))

    return run


def numbered(rows: DataFrame, store: Store, order: list[str]) -> DataFrame:
    """Add `place`, from 0, in each `tree`, and `size`, the number of its rows.

    Rows are put into ranges by tree and order and numbered within a range; each tree's share of a range is a
    run, and the runs before it say where it begins. A number given as the rows are written tells equal rows apart,
    so a row that repeats very often is cut into ranges too.
    """
    rows = store.keep(rows.withColumn("_given", F.monotonically_increasing_id()), "rows")
    by = ["tree", *order, "_given"]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_given")
    ranged = store.keep(ranged.withColumn("_at", F.monotonically_increasing_id()), "in_order")
    partition = F.shiftright("_at", 33).alias("_range")
    runs = ranged.groupBy("tree", partition).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = store.keep(
        runs.select(
            "tree",
            "_range",
            (F.sum("_rows").over(before) - F.col("_rows") - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(of_tree).alias("size"),
        ),
        "runs",
    )
    placed = ranged.withColumn("_range", partition).join(runs, ["tree", "_range"])
    return placed.withColumn("place", F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")


def _in_blocks(rows: DataFrame, levels: int, *columns: str) -> DataFrame:
    by = ["tree", "block"]
    dealt = rows.withColumn("block", F.expr(f"place div {ARITY**levels}")).select(*by, *columns)
    return dealt.repartition(*by).sortWithinPartitions(*by, "place")


def _upwards(rows: DataFrame, store: Store, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes that each job starts from, the lowest first, and the last node of each tree."""
    nodes, tops = [rows], []
    while True:
        blocks = _in_blocks(nodes[-1], levels, "place", "size", "digest")
        up = store.keep(map_arrow(blocks, _sweep_up(levels), _UP), "up")
        tops.append(up.where("size = 1").select("tree", F.lit(len(nodes)).alias("height"), "digest"))
        nodes.append(up.where("size > 1"))
        if nodes[-1].isEmpty():
            break
    last = tops[0]
    for more in tops[1:]:
        last = last.unionByName(more)
    return nodes[:-1], last


def _downwards(nodes: list[DataFrame], tops: DataFrame, store: Store, levels: int, leaves: bool) -> DataFrame:
    """The paths of the lowest nodes. `tops` has path, subroot and root of each tree's last node, with its height."""
    messages, none = None, F.lit(None)
    for height in range(len(nodes), 0, -1):
        lowest = leaves and height == 1
        begun = tops.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        messages = begun if messages is None else begun.unionByName(messages.withColumnRenamed("place", "block"))
        about = ["doc_id", "claimed"] if lowest else []
        columns = ["place", "size", "digest", *about]
        own = nodes[height - 1].withColumn("block", F.expr(f"place div {ARITY**levels}")).select("tree", "block", *columns)
        sent = messages.withColumn("place", F.lit(-1).cast("long"))
        both = (
            own.unionByName(sent, allowMissingColumns=True)
            .repartition("tree", "block")
            .sortWithinPartitions("tree", "block", "place")
        )
        id_, claimed = (F.col("doc_id"), F.col("claimed")) if lowest else (none.cast("long"), none.cast("string"))
        both = both.select("tree", "block", "place", "size", "digest", id_.alias("doc_id"), claimed.alias("claimed"), "path", "subroot", "root")
        messages = map_arrow(both, _sweep_down(levels, lowest), _LEAVES if lowest else _DOWN)
        if not lowest:
            messages = store.keep(messages, "down")
    return messages


def manifest(documents: DataFrame, claimed_text: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, place, leaf, subroot, root, path, folded_root of each row.

    `path` holds the siblings of each level, from the leaf to the root: `before|after`, joined by `/`; with the
    leaf's digest it makes the root. `folded_root` is the root so made where the row's text is
    `claimed_text` (its own where that is not given).
    """
    store = Store(documents.sparkSession)
    own = leaf()
    claimed = own if claimed_text is None else leaf(claimed_text)
    rows = documents.select(
        # Before all others where the source is null.
        F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        own.alias("digest"),
        F.nullif(claimed, own).alias("claimed"),
    )
    leaves = numbered(rows, store, ["doc_id", "digest"])
    nodes, subroots = _upwards(leaves, store, levels)
    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "height", "digest")
    sources = store.keep(numbered(sources, store, ["of"]), "sources")
    source_nodes, root = _upwards(sources, store, levels)
    top = root.select("tree", "height", F.lit("").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    paths = _downwards(source_nodes, top, store, levels, leaves=False).drop("subroot", "tree")
    tops = store.keep(
        sources.join(paths, "place").select(F.col("of").alias("tree"), "height", "path", F.col("digest").alias("subroot"), "root"),
        "tops",
    )
    found = _downwards(nodes, tops, store, levels, leaves=True)
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source")
    return found.select("doc_id", source, "place", "leaf", "subroot", "root", "path", "folded_root")


def tampered(text: Column, doc_id: Column) -> Column:
    """The text without its line feeds where 2 divides the CRC-32 of the id."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.translate(text, "\n", "")).otherwise(text)


def checked(documents: DataFrame) -> DataFrame:
    """The manifest's digests of each row, and whether its possibly tampered text still makes the root."""
    found = manifest(documents, tampered(F.col("text"), F.col("doc_id")))
    proof = F.translate("path", "|/", "")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(proof, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
