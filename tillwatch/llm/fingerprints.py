"""Document fingerprints by consistent weighted sampling.

A text is a bag of terms (its lower-cased words), each weighted by its number of occurrences. For each
of `SAMPLES` draws every term has its own r, c ~ Gamma(2, 1) and b ~ U(0, 1), made from a hash of the
term and the draw alone. With weight S:

    t = floor(ln S / r + b),  y = exp(r (t - b)),  a = c / (y exp(r))

and the term with the smallest a is the sample, together with its t. Two texts draw the same (term, t)
with a probability equal to their generalised Jaccard similarity, sum(min) / sum(max) of the weights,
so the share of equal samples estimates it. A fingerprint keeps 16 bits of each sample.

Nulls: a null text is an empty one; texts without terms have the fingerprint of zeros, alike to each
other with 1 and to any other with 0. The order is by doc_id, nulls first, and a hash of the text;
wholly equal rows tie, which changes nothing. A doc_id, null included, of more rows than a partition's
share is cut by its texts' hashes, and its equal rows are compared once and unfold at the end. A single
row is its own next one. An empty table gives an empty result. Columns other than doc_id and text are
not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import importable, map_arrow, numbered_copies, text_of

SAMPLES = 64
#: Terms of this many documents at a time share their draws; more text than that closes a batch too.
BATCH, BATCH_CHARS = 192, 1 << 20
TERMS = 4_096
BUCKET_ROWS = 512


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_DRAWS = _mix((np.arange(1, 4096, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15))


def draws(hashes: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of each term and sample, from the terms' hashes."""
    base = _mix(hashes[:, None] ^ _DRAWS[None, :samples])
    more = _mix(base + np.uint64(0x9E3779B97F4A7C15))
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    scale = np.float32(2.0**-32)

    def uniform(x: np.ndarray) -> np.ndarray:
        return np.maximum(x.astype(np.float32) * scale, np.float32(2.0**-33))

    # -ln of a product of two uniforms is Gamma(2, 1).
    r = -np.log(uniform(base >> half) * uniform(base & low))
    c = -np.log(uniform(more >> half) * uniform(more & low))
    b = uniform((base * np.uint64(0xD6E8FEB86659FD93)) >> half)
    tiny = np.float32(1e-12)
    return np.maximum(r, tiny), np.log(np.maximum(c, tiny)), b


def signatures(bags: list[Counter], samples: int = SAMPLES) -> np.ndarray:
    """One row of 16-bit samples per bag; zeros for an empty one."""
    out = np.zeros((len(bags), samples), np.uint16)
    number: dict[str, int] = {}
    for bag in bags:
        for term in bag:
            number.setdefault(term, len(number))
    if not number:
        return out
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in number), np.uint64, len(number))
    r, log_c, b = (np.empty((len(number), samples), np.float32) for _ in range(3))
    for i in range(0, len(number), TERMS):
        r[i : i + TERMS], log_c[i : i + TERMS], b[i : i + TERMS] = draws(hashes[i : i + TERMS], samples)
    once = log_c + r * b - r  # ln a where the weight is 1, so that t is 0
    for row, bag in enumerate(bags):
        if not bag:
            continue
        terms = np.fromiter((number[t] for t in bag), np.int64, len(bag))
        weight = np.fromiter(bag.values(), np.float32, len(bag))
        best, chosen, step = np.full(samples, np.inf, np.float32), np.zeros(samples, np.int64), np.zeros(samples)
        for i in range(0, len(terms), TERMS):
            part, log_s = terms[i : i + TERMS], np.log(weight[i : i + TERMS])
            log_a = once[part]
            heavy = np.flatnonzero(log_s)
            t = np.zeros((0, samples), np.float32)
            if len(heavy):
                own = part[heavy]
                t = np.floor(log_s[heavy, None] / r[own] + b[own])
                log_a[heavy] = log_c[own] - r[own] * (t - b[own]) - r[own]
            at = log_a.argmin(axis=0)
            value = log_a[at, np.arange(samples)]
            steps = np.zeros((len(part), samples), np.float32)
            steps[heavy] = t
            better = value < best
            best = np.where(better, value, best)
            chosen = np.where(better, part[at], chosen)
            step = np.where(better, steps[at, np.arange(samples)], step)
        mixed = _mix(hashes[chosen] + step.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[row] = np.maximum(mixed & np.uint64(0xFFFF), 1)
    return out


def bag(text: str) -> Counter:
    return Counter(text.lower().split())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) characters replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


_ROWS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("copies", pa.int64()),
    ]
)
_KINDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, copies long"
)


def _compare(samples: int):
    """Over rows sorted by bucket and order, each bucket followed by the first row of the next one.

    A row that stands for several copies is followed by one more copy, so its text is its own next one.
    """

    def rows_of(held: list[tuple]) -> pa.RecordBatch:
        """All but the last of the held rows, and those that only end a bucket."""
        bags, changed = [bag(t) for _, _, t, _, _ in held], []
        for (b, _, text, _, _), (b_next, _, following, _, _) in zip(held, held[1:], strict=False):
            changed.append(edited(text, following) if b == b_next else "")
        own = signatures([*bags, *map(bag, changed)], samples)
        out = []
        for i, (b, doc_id, text, ends, copies) in enumerate(held[:-1]):
            if ends or held[i + 1][0] != b:
                continue
            a, e = own[i], own[len(held) + i]
            out.append(
                (
                    doc_id,
                    len(text),
                    hashlib.sha256(changed[i].encode()).hexdigest(),
                    _hex(a),
                    _hex(e),
                    likeness(a, e),
                    likeness(a, own[i + 1]),
                    copies,
                )
            )
        columns = zip(*out, strict=True) if out else [[] for _ in _ROWS]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, _ROWS, strict=True)], schema=_ROWS
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                held.append(tuple(value.as_py() for value in row))
                chars += len(held[-1][2])
                if len(held) > BATCH or chars > BATCH_CHARS:
                    yield rows_of(held)
                    held, chars = held[-1:], 0
        if len(held) > 1:
            yield rows_of(held)

    return run


def crowded_ids(ids: DataFrame, share: int) -> dict[int | None, int]:
    """The doc_ids, null included, of more than `share` rows, with their rows: at most one per share."""
    crowds = ids.groupBy("doc_id").count().where(F.col("count") > share)
    return {r.doc_id: r["count"] for r in crowds.collect()}


def buckets_of(ids: DataFrame, partitions: int, share: int, crowds: dict[int | None, int]):
    """The bucket of a doc_id and its text's hash: ranges of doc_id; a crowded doc_id is cut by the hash."""
    plain = ids.where(F.col("doc_id").isNotNull() & ~F.col("doc_id").isin([i for i in crowds if i is not None]))
    buckets = min(-(-plain.count() // share), partitions)
    cuts = [i / buckets for i in range(1, buckets)]
    edges = {int(e) for e in plain.approxQuantile("doc_id", cuts, 0.1 / buckets)} if cuts else set()
    alone = {i: -(-n // share) for i, n in crowds.items()}
    edges |= {i for i in alone if i is not None} | {i + 1 for i in alone if i is not None and i < 2**63 - 1}
    starts = np.array(sorted(edges), np.int64)
    parts = np.array([1, *(alone.get(int(i), 1) for i in starts)])
    before = np.concatenate([[0], np.cumsum(parts)[:-1]])

    @F.pandas_udf("long")
    def of_id(doc_id: pd.Series, text_hash: pd.Series) -> pd.Series:
        at = np.searchsorted(starts, doc_id.to_numpy(), side="right")
        part = np.floor((text_hash.to_numpy() / 2.0**64 + 0.5) * parts[at]).astype(np.int64)
        return pd.Series(before[at] + np.minimum(part, parts[at] - 1))

    nulls = alone.get(None, 1)
    of_null = F.least(F.floor((F.col("text_hash") / F.lit(2.0**64) + 0.5) * nulls), F.lit(nulls - 1)) - nulls
    known = of_id(F.coalesce("doc_id", F.lit(0).cast("long")), "text_hash")
    return F.when(F.col("doc_id").isNull(), of_null.cast("long")).otherwise(known)


def fingerprint_with_next(documents: DataFrame, samples: int = SAMPLES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness (the columns of _ROWS but copies).

    Rows are dealt into buckets, ranges of doc_id, about one for each shuffle partition. The first row of
    a bucket is dealt to the one before it too, where it ends the row of texts, so one shuffle brings every
    text beside its next one. The driver sees a range and a first id per bucket.
    """
    spark = documents.sparkSession
    importable(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    share = max(bucket_rows, -(-ids.count() // partitions))
    crowds = crowded_ids(ids, share)
    one = rows.withColumn("copies", F.lit(1).cast("long")).withColumn("last", F.lit(False))
    if crowds:
        known = F.col("doc_id").isin([i for i in crowds if i is not None])
        among = F.when(F.col("doc_id").isNull(), F.lit(None in crowds)).otherwise(known)
        counted = rows.where(among).groupBy("doc_id", "text").agg(F.count("*").alias("n"))
        single = F.struct(F.lit(1).cast("long").alias("copies"), (F.col("n") > 1).alias("last"))
        others = F.struct((F.col("n") - 1).alias("copies"), F.lit(False).alias("last"))
        folded = counted.withColumn("as", F.explode(F.when(F.col("n") > 1, F.array(others, single)).otherwise(F.array(single))))
        one = one.where(~among).union(folded.select("doc_id", "text", "as.copies", "as.last"))
    placed = (
        one.withColumn("text_hash", F.xxhash64("text"))
        .withColumn("bucket", buckets_of(ids, partitions, share, crowds))
        .withColumn("at", F.struct("doc_id", "text_hash", "last"))
    )
    firsts = sorted(placed.groupBy("bucket").agg(F.min("at").alias("at")).collect(), key=lambda r: r.bucket)
    pairs = [(*this.at, before.bucket) for before, this in zip([firsts[-1], *firsts], firsts)] if firsts else []
    ends = spark.createDataFrame(pairs, "first_id long, first_hash long, first_last boolean, before long")
    is_first = (
        F.col("at.doc_id").eqNullSafe(F.col("first_id"))
        & (F.col("at.text_hash") == F.col("first_hash"))
        & (F.col("at.last") == F.col("first_last"))
    )
    own = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("ends")))
    too = F.array(F.struct(F.col("before").alias("bucket"), F.lit(True).alias("ends")))
    dealt = (
        placed.join(F.broadcast(ends), is_first, "left")
        .withColumn("to", F.explode(F.when(F.col("before").isNull(), own).otherwise(F.concat(own, too))))
        .select("to.bucket", "to.ends", "at", "text", "copies")
        .repartitionById(partitions, F.pmod("bucket", F.lit(partitions)).cast("int"))
        .sortWithinPartitions("bucket", "ends", "at")
        .select("bucket", F.col("at.doc_id").alias("doc_id"), "text", "ends", "copies")
    )
    out = map_arrow(dealt, _compare(samples), _KINDS)
    return numbered_copies(out, "copies", "number").drop("number") if crowds else out.drop("copies")
