"""Ranked lexical search: exact inner products of sparse vectors, by ball trees.

A document is a vector over terms, w * ((10 ** 9 * tf) div (1000 * tf + 8 * m)), with the term's weight w
and the document's length norm m, all integers; an item counts its terms; the score is their inner product.
Documents are put into ball trees of at most `TREE` of them. A node is a run of documents with the centroid
c of their vectors and their greatest distance r from it, so no document in it scores more than

    <q, c> + |q| r

with an item q. Of a document of thousands of terms, an item sees a few dozen, and a radius over all of them would
hide these. So the ball is taken apart into one for each coordinate: the bound is the sum over the item's terms of
q * (c + r), with the centroid's coordinate and the greatest distance from it there. A search descends best-first: it
opens the node with the highest bound, until none can reach the tenth score found so far. Bounds are in double
precision and are raised by more than their rounding error; scores at leaves are exact integers.

Items come in blocks of at most `ITEMS` and about `ITEM_TERMS` terms. A block's vocabulary goes to the tasks; only its
terms of a document count, which changes no score. One pass over the texts writes the term counts, from which
N, L and the terms' document counts are taken over all documents. The vectors are then put into ranges of
their rarest terms (rare in the items, so that documents that answer one item share their trees), and each task
searches the trees of its range one after another with what it has found so far. A task sends ten rows per
item at most. Crowded terms are cut by doc_id, and rows that repeat wholly by a number given as they are counted.

Nulls: a null text has no terms. A null doc_id comes before all others in ties, and rows with equal doc_id are
ranked one by one. Items without terms, or whose terms no document has, get no rows; equal items are answered each.
An empty table gives an empty result. Columns other than doc_id, item_id and text are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import map_arrow
from tillwatch.sources.store import Store

TOP = 10
#: Items of a block and their terms; documents of a tree and their terms; documents of a leaf.
ITEMS, ITEM_TERMS = 256, 20_000
TREE, TREE_TERMS, LEAF = 2_048, 400_000, 16
#: Numbers of the directions along which trees are cut, and of the margin of a bound.
DIRECTIONS, MARGIN = 16, 1e-9
#: In UTF-8 the bytes of other than ASCII characters are all above 7F, so terms can be found in bytes.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NO_ID = np.iinfo(np.int64).min


def terms_of(text: bytes) -> list[bytes]:
    """The terms of UTF-8 text; `bytes.lower` changes A to Z alone."""
    return TERM.findall(text.lower())


@dataclass(frozen=True)
class Block:
    """Some items and the numbers of their terms; rarer terms among the items have smaller numbers."""

    ids: list
    counts: list[dict[int, int]]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame, most: int = ITEMS, most_terms: int = ITEM_TERMS) -> Iterator[Block]:
    """The items with terms, block by block; partitions of the table come to the driver one at a time."""
    held, terms = [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        counts = Counter(terms_of((row.text or "").encode()))
        if not counts:
            continue
        if held and (len(held) == most or terms + len(counts) > most_terms):
            yield _block(held)
            held, terms = [], 0
        held.append((row.item_id, counts))
        terms += len(counts)
    if held:
        yield _block(held)


def _block(held: list[tuple]) -> Block:
    used = Counter(term for _, counts in held for term in counts)
    vocabulary = {term: i for i, (term, _) in enumerate(sorted(used.items(), key=lambda x: (x[1], x[0])))}
    return Block([i for i, _ in held], [{vocabulary[t]: n for t, n in c.items()} for _, c in held], vocabulary)


_COUNTS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
)


def _count(vocabulary: dict[bytes, int]):
    """Rows of (doc_id, n, terms, counts); of the terms only those of the vocabulary, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            lengths, all_terms, all_counts = [], [], []
            for text in batch.column(1):
                found = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                counted = Counter(map(number, found))
                counted.pop(None, None)
                known = sorted(counted.items())
                lengths.append(len(found))
                all_terms.append([t for t, _ in known])
                all_counts.append([c for _, c in known])
            columns = [batch.column(0), *map(pa.array, (lengths, all_terms, all_counts), [f.type for f in _COUNTS][1:])]
            yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)

    return run


class Vectors:
    """Sparse rows: `terms` and `values` of row i stand from starts[i] to starts[i + 1]."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.ids, self.starts, self.terms, self.values = ids, starts, terms, values

    def __len__(self) -> int:
        return len(self.ids)

    def in_order(self, order: np.ndarray) -> Vectors:
        lengths = np.diff(self.starts)[order]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[:-1][order] - starts[:-1], lengths)
        return Vectors(self.ids[order], starts, self.terms[at], self.values[at])


class BallTree:
    """Nodes over runs of rows. Node i has the children 2 i + 1 and 2 i + 2; the last level is the leaves."""

    def __init__(self, vectors: Vectors, size: int, leaf: int | None = None):
        self.size, self.depth = size, max(0, math.ceil(math.log2(len(vectors) / (leaf or LEAF))))
        self.rows = vectors.in_order(self._cut(vectors))
        # Ends of the runs of each level; a level halves each run of the one above.
        self.ends = [np.array([0, len(vectors)])]
        for _ in range(self.depth):
            above = self.ends[-1]
            self.ends.append(np.sort(np.concatenate([above, (above[:-1] + above[1:] + 1) // 2])))
        #: Centroid plus radius of each node, coordinate by coordinate.
        self.reach = np.concatenate([self._measured(level) for level in range(self.depth + 1)])

    def _cut(self, vectors: Vectors) -> np.ndarray:
        """An order of the rows in which runs are close: halves along the widest of some random directions."""
        directions = np.random.default_rng(1).standard_normal((DIRECTIONS, self.size))
        scaled = np.sqrt(vectors.values.astype(np.float64))
        place = np.stack([np.add.reduceat(scaled * d[vectors.terms], vectors.starts[:-1]) for d in directions], axis=1)
        order = np.arange(len(vectors))

        def halve(low: int, high: int, depth: int) -> None:
            if not depth or low == high:
                return
            run = order[low:high]
            along = place[run, place[run].var(axis=0).argmax()]
            order[low:high] = run[np.argsort(along, kind="stable")]
            middle = (low + high + 1) // 2
            halve(low, middle, depth - 1)
            halve(middle, high, depth - 1)

        halve(0, len(vectors), self.depth)
        return order

    def _measured(self, level: int) -> np.ndarray:
        """Centroid plus radius of the nodes of a level; a row without a term has 0 there."""
        rows, lengths = self.rows, np.diff(self.ends[level])
        node_of = np.repeat(np.repeat(np.arange(len(lengths)), lengths), np.diff(rows.starts))
        at, cells, values = node_of * self.size + rows.terms, len(lengths) * self.size, rows.values.astype(np.float64)
        shape = (len(lengths), self.size)
        centroid = np.bincount(at, weights=values, minlength=cells).reshape(shape) / np.maximum(lengths, 1)[:, None]
        highest, lowest = np.zeros(cells), np.full(cells, np.inf)
        np.maximum.at(highest, at, values)
        np.minimum.at(lowest, at, values)
        lowest[np.bincount(at, minlength=cells) < np.repeat(lengths, self.size)] = 0
        lowest[np.isinf(lowest)] = 0
        return centroid + np.maximum(highest.reshape(shape) - centroid, centroid - lowest.reshape(shape))

    def bounds(self, items: np.ndarray) -> np.ndarray:
        """An upper bound of the scores in each node (row) for each item (column)."""
        return (self.reach @ items) * (1 + MARGIN) + 1

    def leaf_run(self, node: int) -> tuple[int, int] | None:
        first = 2**self.depth - 1
        return (self.ends[-1][node - first], self.ends[-1][node - first + 1]) if node >= first else None


class Search:
    """The best rows for each item of a block, over any number of trees."""

    def __init__(self, block: Block, weights: np.ndarray, top: int = TOP):
        self.size, self.top = len(block.vocabulary), top
        self.items = np.zeros((self.size, len(block.ids)))
        for i, counts in enumerate(block.counts):
            self.items[list(counts), i] = list(counts.values())
        self.exact = np.ascontiguousarray(self.items.T).astype(np.int64)
        self.weights = weights
        #: Of each item the best (score, -doc_id) so far, as a heap whose first is the worst.
        self.best: list[list[tuple[int, int]]] = [[] for _ in block.ids]
        self.opened = self.leaves = 0

    def add(self, vectors: Vectors) -> None:
        tree = BallTree(vectors, self.size)
        bounds = tree.bounds(self.items)
        least = np.array([b[0][0] if len(b) == self.top else 1 for b in self.best])
        self.leaves += 2**tree.depth * len(least)
        for item in np.flatnonzero(bounds[0] >= least):
            self._descend(tree, bounds[:, item].tolist(), item)

    def _descend(self, tree: BallTree, bound: list[float], item: int) -> None:
        best, weights, rows = self.best[item], self.exact[item], tree.rows
        waiting = [(-bound[0], 0)]
        while waiting:
            upper, node = heapq.heappop(waiting)
            if -upper < (best[0][0] if len(best) == self.top else 1):
                break
            run = tree.leaf_run(node)
            if run is None:
                for child in (2 * node + 1, 2 * node + 2):
                    heapq.heappush(waiting, (-bound[child], child))
                continue
            low, high = run
            if low == high:
                continue
            self.opened += 1
            first, last = rows.starts[low], rows.starts[high]
            scores = np.add.reduceat(weights[rows.terms[first:last]] * rows.values[first:last], rows.starts[low:high] - first)
            least = best[0][0] if len(best) == self.top else 1
            for i in np.flatnonzero(scores >= least).tolist():
                found = (int(scores[i]), -int(rows.ids[low + i]))
                if len(best) < self.top:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)


def weight(docs: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * with_term + 1)))


def values(
    weights: np.ndarray,
    lengths: np.ndarray,
    starts: np.ndarray,
    terms: np.ndarray,
    counts: np.ndarray,
    docs: int,
    words: int,
) -> np.ndarray:
    """The coordinates of documents, in 64-bit integers."""
    m = 25 + (75 * lengths * docs) // words
    return weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(m, np.diff(starts))))


_FOUND = "item int, doc_id long, score long"


def _search(block: Block, weights: np.ndarray, docs: int, words: int, top: int):
    def vectors_of(rows: pa.RecordBatch) -> Vectors:
        ids = rows.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
        lengths = rows.column(1).to_numpy(zero_copy_only=False)
        listed = rows.column(2)
        terms = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = rows.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = listed.value_lengths().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return Vectors(ids, starts, terms, values(weights, lengths, starts, terms, counts, docs, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(block, weights, top)
        for rows in _tree_rows(batches):
            search.add(vectors_of(rows))
        found = [
            (item, None if -id_ == NO_ID else -id_, score) for item, best in enumerate(search.best) for score, id_ in best
        ]
        schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
        columns = zip(*found, strict=True) if found else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows dealt anew, as many as a tree takes at a time."""

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held, rows, terms = [], 0, 0
    for batch in batches:
        upto = np.concatenate([[0], np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))])
        first = 0
        while first < len(batch):
            fit = int(np.searchsorted(upto, upto[first] + TREE_TERMS - terms, side="right")) - 1 - first
            fit = max(min(fit, TREE - rows, len(batch) - first), 0 if held else 1)
            if fit:
                held.append(batch.slice(first, fit))
                rows, terms, first = rows + fit, terms + int(upto[first + fit] - upto[first]), first + fit
            if first < len(batch):
                yield joined(held)
                held, rows, terms = [], 0, 0
    if held:
        yield joined(held)


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` highest-scoring documents of each item."""
    store = Store(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    kind = items.select("item_id").schema[0].dataType.simpleString()
    for block in blocks(items):
        one = _ranked(texts, block, kind, store, top)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return documents.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found


def _ranked(texts: DataFrame, block: Block, kind: str, store: Store, top: int) -> DataFrame:
    spark = texts.sparkSession
    kinds = "doc_id long, n long, terms array<int>, counts array<int>"
    rows = map_arrow(texts, _count(block.vocabulary), kinds).withColumn("given", F.monotonically_increasing_id())
    counted = store.keep(rows, "counts")
    docs, words = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(block.vocabulary), np.int64)
    for term, with_term in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(docs, with_term)
    by = [F.col("terms")[0], F.get("terms", F.lit(1)), F.col("doc_id"), F.col("given")]
    ranges = counted.where(F.size("terms") > 0).repartitionByRange(*by).sortWithinPartitions(*by)
    best = map_arrow(ranges, _search(block, weights, docs, words, top), _FOUND)
    highest = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ids = spark.createDataFrame([(i, id_) for i, id_ in enumerate(block.ids)], f"item int, item_id {kind}")
    return (
        best.withColumn("rank", F.row_number().over(highest))
        .where(F.col("rank") <= top)
        .join(ids, "item")
        .select("item_id", "rank", "doc_id", "score")
    )
