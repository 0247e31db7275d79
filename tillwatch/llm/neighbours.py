"""Approximate nearest neighbours by a hash-prefix forest.

A vector's hash string in a tree has one bit per random hyperplane. The hyperplanes go through the mean of
a bounded sample (`SAMPLE` vectors), which is all that is fitted; every vector is indexed. Vectors are dealt
to blocks of about `BLOCK`, and each block is a forest: per tree, its hash strings in sorted order.

A query descends every tree by binary search to its longest matching prefix, of whatever length. Then all
trees ascend together, one bit at a time, and each step adds the vectors that share the shorter
prefix in some tree. Vectors at distance d (after the mean is taken off) share a bit with probability
p = 1 - angle / pi, so a neighbour is missing from all T trees at prefix length x with probability
(1 - p^x)^T. The ascent ends when that is at most `MISS` at the distance of the k-th nearest found. So
there is no cap on candidates: crowded or distant neighbourhoods ascend further, to the root if need
be, where all vectors are candidates. Distances of candidates are exact, and the nearest of all blocks
are merged.

Queries come in blocks too, and each block of queries meets each block of vectors once; no task holds more
than one of each. Repeated rows count once. Vectors that are null or empty, zero, or hold null or
non-finite components take no part, nor do vectors without an id; vectors of different length are never
compared. An empty table gives an empty result. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import importable
from tillwatch.sources.store import Store

NEAREST = 10
QUERY_STEP = 100
TREES = 24
BITS = 32
BLOCK = 8_192
SAMPLE = 4_096
MISS = 0.02
SEED = 7


class Forest:
    """The trees of one block of vectors: all their hash strings in one sorted array, tree after tree."""

    def __init__(self, vectors: np.ndarray, mean: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        planes = np.random.default_rng((seed, vectors.shape[1])).standard_normal((vectors.shape[1], trees * bits))
        self.planes, self.mean, self.trees, self.bits = planes, mean, trees, bits
        self.vectors = vectors
        strings = self.strings(vectors)
        order = np.argsort(strings, axis=1, kind="stable")
        self.order = order.ravel()
        self.sorted = np.take_along_axis(strings, order, axis=1).ravel()
        far = np.sqrt(((vectors - mean) ** 2).sum(axis=1))
        #: The least distance from the mean of most vectors: shorter ones make larger angles.
        self.spread = float(np.quantile(far, 0.05))
        #: Vectors whose distances were taken, over all searches.
        self.compared = 0

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """One hash string per tree and vector, as an integer: the tree, then a bit per plane, the first the highest."""
        signs = ((vectors - self.mean) @ self.planes > 0).reshape(len(vectors), self.trees, self.bits)
        weight = (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)).astype(np.int64)
        tree = np.arange(self.trees, dtype=np.int64)[:, None] << self.bits
        return np.ascontiguousarray((signs @ weight).T) + tree

    def spans(self, strings: np.ndarray, length: int) -> np.ndarray:
        """Where the strings that share a prefix of this length start and end, for each tree."""
        free = self.bits - length
        low = (strings >> free) << free
        return np.searchsorted(self.sorted, [low, low + (1 << free)])

    def longest(self, strings: np.ndarray) -> int:
        """The length of the longest prefix that some string shares in some tree."""
        at = np.searchsorted(self.sorted, strings)
        near = self.sorted[[np.maximum(at - 1, 0), np.minimum(at, len(self.sorted) - 1)]]
        return max(0, self.bits - int((near ^ strings).min()).bit_length())

    def search(self, query: np.ndarray, ids: np.ndarray, own: int, nearest: int, miss: float):
        """Ids and distances of the nearest candidates, ties to the smaller id."""
        strings = self.strings(query[None])[:, 0]
        length = self.longest(strings)
        distance = np.full(len(ids), np.inf)
        seen = np.zeros(len(ids), bool)
        norm = float(np.sqrt(((query - self.mean) ** 2).sum()))
        inner = None
        while True:
            a, b = self.spans(strings, length)
            # Of a longer span only the rows on both sides of the shorter one are new.
            sides = zip(a, b) if inner is None else [s for w, x, y, z in zip(a, *inner, b) for s in ((w, x), (y, z))]
            inner = a, b
            fresh = np.zeros(len(ids), bool)
            fresh[np.concatenate([self.order[x:y] for x, y in sides])] = True
            new = np.flatnonzero(fresh & ~seen)
            if len(new):
                seen[new] = True
                distance[new] = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
                distance[new[ids[new] == own]] = np.inf
                self.compared += len(new)
            if length == 0:
                break
            radius = np.partition(distance, nearest - 1)[nearest - 1] if len(ids) >= nearest else np.inf
            if np.isfinite(radius):
                if (1 - self.shared_bit(radius, norm, self.spread) ** length) ** self.trees <= miss:
                    break
            length -= 1
        found = np.flatnonzero(np.isfinite(distance))
        order = np.lexsort((ids[found], distance[found]))[:nearest]
        return ids[found][order], distance[found][order]

    @staticmethod
    def shared_bit(radius: float, query_norm: float, other_norm: float) -> float:
        """The probability that a vector at this distance is on the query's side of a plane."""
        if query_norm == 0 or other_norm == 0:
            return 0.0
        cosine = (query_norm**2 + other_norm**2 - radius**2) / (2 * query_norm * other_norm)
        return 1 - float(np.arccos(np.clip(cosine, -1, 1))) / np.pi


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (as doubles) of the rows that take part, each once."""
    embedding = F.col("embedding").cast("array<double>")
    limits = (float("inf"), float("-inf"))
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & ~x.isin(*limits)) & F.exists(embedding, lambda x: x != 0)
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(fine)
        .select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"))
        .distinct()
    )


def nearest_neighbours(
    vectors: DataFrame,
    nearest: int = NEAREST,
    query_step: int = QUERY_STEP,
    block: int = BLOCK,
    trees: int = TREES,
    bits: int = BITS,
    miss: float = MISS,
    sample: int = SAMPLE,
) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the vectors whose id is divisible by `query_step`."""
    importable(vectors.sparkSession)
    store = Store(vectors.sparkSession)
    # The id is hashed into the block, so a block is the same however often it is computed.
    rows = store.keep(usable(vectors).withColumn("dim", F.size("embedding")), "vectors")
    is_query = F.col("vec_id") % query_step == 0
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("queries")).collect()
    means = {c.dim: np.zeros(c.dim) for c in counts}
    few = rows.orderBy(F.xxhash64("vec_id", "embedding")).limit(sample).select("dim", "embedding").toPandas()
    for dim, part in few.groupby("dim"):
        means[dim] = np.mean(np.stack(part["embedding"].to_numpy()), axis=0)
    most = max((c.n for c in counts), default=0)
    blocks = max(1, -(-most // block))
    query_blocks = max(1, -(-max((c.queries for c in counts), default=0) // block))

    def part(of: int, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), "vec_id", "embedding"), F.lit(of)).cast("int")

    def each(of: int):
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    indexed = rows.select("dim", part(blocks, 1).alias("b"), each(query_blocks).alias("q"), F.lit(False).alias("asks"), "vec_id", "embedding")
    asking = rows.where(is_query).withColumn("q", part(query_blocks, 2)).select(
        "dim", each(blocks).alias("b"), "q", F.lit(True).alias("asks"), "vec_id", "embedding"
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        out = []
        if asks.any() and not asks.all():
            stacked = np.stack(group["embedding"].to_numpy()).astype(float)
            ids = group["vec_id"].to_numpy()
            own, own_ids = stacked[~asks], ids[~asks]
            forest = Forest(own, means[int(group["dim"].iloc[0])], trees, bits)
            for query, query_id in zip(stacked[asks], ids[asks], strict=True):
                found, far = forest.search(query, own_ids, query_id, nearest, miss)
                out += [(query_id, f, d) for f, d in zip(found, far, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    met = indexed.select("dim", "b", "q", "asks", "vec_id", "embedding").union(asking)
    found = met.groupBy("dim", "b", "q").applyInPandas(search, "query_id long, vec_id long, score double")
    in_order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(in_order))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )
