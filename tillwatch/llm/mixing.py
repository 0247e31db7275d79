"""Mixing sources to target weights by pivotal rounding.

A source's rate is its target over its size, both in words. A document gets the rate's whole copies,
and the rest of the rate is the probability of one more. Those fractions are settled by dependent
rounding: two documents of a source meet, and a random transfer of mass between them, which keeps the
sum of size x probability, makes one of them 0 or 1. So the words that a source contributes miss its
target by less than one document, and each document keeps its expected number of copies.

The pairs form a reduction tree. Documents are dealt to blocks of about `FAN_IN` by a hash, a block
settles all but at most one of its documents, and the residuals of `FAN_IN` blocks make a block of the
next level, which is written to the shared folder before the level after it. A block starts with its longest
documents: a long one that meets many short ones is settled on the way, so what remains is short. What
remains at the root is settled by its own draw. Every draw is a hash of the documents that meet, so reruns agree.

Only DataFrame functions run. Nulls: a null text has no words; a null source is a source of its own,
after all others; a null doc_id is an id like any other. Repeated rows are told apart by a number, so
that they are drawn separately. Documents without words take their extra copy by their own draw. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import BLOCK, numbered_copies, text_of, unused
from tillwatch.sources.store import Store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
FAN_IN = 32
SEED = 20_240_601
#: Probabilities this near to 0 or 1 count as settled.
EDGE = 1e-9

KEY = ("doc_id", "source", "size", "text_hash", "copy")


def sizes(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size in words, hash of the text, number among equal rows."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text_of()).alias("text_hash"),
    )
    counted = rows.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("n"))
    return numbered_copies(counted, "n", "copy").select(*KEY)


def targets(
    rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, n, source_size, target: `share` of all words by weight, at most `most` times a source's own.

    What exceeds a source's limit goes to the others by weight until none is above. A source is full
    if even the final share per weight exceeds its limit, so sources fill in the order of
    limit / weight, and one running sum over the sources finds them all. There is one row per source.
    """
    by = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weighted = by.withColumn("rank", F.row_number().over(in_order) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    )
    limit = F.col("source_size") * F.lit(float(most))
    filling = Window.orderBy("fill", "rank")
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    full = F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - full) / weight_left
    return (
        weighted.withColumn("fill", limit / F.col("weight"))
        .withColumn("level", level)
        # The first source that does not fill sets the level of all after it.
        .withColumn(
            "final",
            F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "rank", "level"))).over(everything)["level"],
        )
        .select(
            "source",
            "n",
            "source_size",
            F.least(limit, F.coalesce(F.col("final") * F.col("weight"), limit)).alias("target"),
        )
    )


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a hash."""
    return (F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _let(value: Column, then) -> Column:
    """`then(value)`, evaluating the value once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _with_p(item: Column, p: Column) -> Column:
    return F.struct(*[item[k].alias(k) for k in KEY], p.alias("p"))


def _settle(items: Column) -> Column:
    """Fold a block: `carry` is the document still open (null at first), `done` those settled."""
    item = "struct<doc_id:bigint,source:string,size:bigint,text_hash:bigint,copy:bigint,p:double>"
    none, nothing = F.lit(None).cast(item), F.array().cast(f"array<{item}>")

    def snapped(p: Column) -> Column:
        return F.when(p < EDGE, F.lit(0.0)).when(p > 1 - EDGE, F.lit(1.0)).otherwise(p)

    def meet(state: Column, x: Column) -> Column:
        c, done = state["carry"], state["done"]

        def transfer(t: Column) -> Column:
            # up: what c can take from x; down: what c can give to x.
            draw = _uniform(*[c[k] for k in KEY], *[x[k] for k in KEY])
            rises = draw * (t["up"] + t["down"]) < t["down"]
            pc = snapped(F.when(rises, c["p"] + t["up"]).otherwise(c["p"] - t["down"]))
            px = snapped(F.when(rises, x["p"] - t["up"] / t["ratio"]).otherwise(x["p"] + t["down"] / t["ratio"]))
            return F.struct(_with_p(c, pc).alias("c"), _with_p(x, px).alias("x"))

        def moved(m: Column) -> Column:
            def is_open(i: Column) -> Column:
                return (i["p"] > 0) & (i["p"] < 1)

            settled = F.filter(F.array(m["c"], m["x"]), lambda i: ~is_open(i))
            still = F.when(is_open(m["c"]), m["c"]).when(is_open(m["x"]), m["x"])
            return F.struct(still.alias("carry"), F.concat(done, settled).alias("done"))

        ratio = x["size"].cast("double") / c["size"]
        amounts = F.struct(
            F.least(1 - c["p"], x["p"] * ratio).alias("up"),
            F.least(c["p"], (1 - x["p"]) * ratio).alias("down"),
            ratio.alias("ratio"),
        )
        return F.when(c.isNull(), F.struct(_with_p(x, x["p"]).alias("carry"), done.alias("done"))).otherwise(
            _let(_let(amounts, transfer), moved)
        )

    return F.aggregate(items, F.struct(none.alias("carry"), nothing.alias("done")), meet)


def _level(items: DataFrame) -> DataFrame:
    """One row per block, settled but for its carry."""
    item = F.struct("size", *[k for k in KEY if k != "size"], "p").alias("item")
    blocks = items.select("source", "block", item).groupBy("source", "block")
    return blocks.agg(F.sort_array(F.collect_list("item"), asc=False).alias("items")).select(
        "source", "block", _settle(F.col("items")).alias("state")
    )


def copies(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """The columns of KEY, source_size, target, and how many copies the mix takes of each document."""
    store = Store(documents.sparkSession)
    rows = store.keep(sizes(documents), "sizes")
    goal = store.keep(targets(rows, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(F.col("rate") + EDGE), F.lit(int(most)))
    planned = (
        _by_source(rows, goal, "source_size", "target", "n")
        .withColumn("rate", rate)
        .withColumn("whole", whole.cast("long"))
        .withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    )
    settled = (F.col("p") < EDGE) | (F.col("size") == 0)
    single = planned.where(settled).select(
        *KEY, (F.lit(1) * (_uniform(*KEY) < F.col("p")).cast("long")).alias("extra")
    )
    number = F.ceil(F.col("n") / fan_in).cast("long")
    items = planned.where(~settled).select(
        *KEY, "p", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text_hash", "copy"), number).alias("block")
    )
    levels, most_blocks = [], goal.agg(F.max(number)).first()[0] or 0
    while True:
        levels.append(store.keep(_level(items), "level"))
        rest = levels[-1].where("state.carry is not null").select("state.carry.*", "block")
        if most_blocks <= 1:
            break
        most_blocks = -(-most_blocks // fan_in)
        items = rest.withColumn("block", F.expr(f"block div {fan_in}"))
    done = [x.select(F.explode("state.done").alias("item")).select("item.*") for x in levels]
    extra = single.union(rest.select(*KEY, (_uniform(*KEY) < F.col("p")).cast("long")))
    for x in done:
        extra = extra.union(x.select(*KEY, F.col("p").cast("long")))
    return (
        _by_source(extra, goal, "source_size", "target")
        .withColumn("whole", F.least(F.floor(rate + EDGE), F.lit(int(most))).cast("long"))
        .select(*KEY, "source_size", "target", (F.col("whole") + F.col("extra")).alias("copies"))
    )


def _by_source(rows: DataFrame, goal: DataFrame, *columns: str) -> DataFrame:
    found = goal.select(F.col("source").alias("_source"), *columns)
    return rows.join(found, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def mix(documents: DataFrame, **settings) -> DataFrame:
    """The documents with the columns they had, each as often as the mix takes it.

    Rows that agree in doc_id, text and source share the copies that are taken of them all: as even as whole
    numbers can be, and the first by a hash of all columns get one more. Wholly equal rows are one row with a
    count until they unfold, in blocks if there are very many; so no order of the input matters, and no
    group of copies meets in one task.
    """
    key, row, n, before, taken, first = (
        unused(f"_{k}", documents.columns) for k in ("key", "row", "n", "before", "taken", "first")
    )

    def keyed(doc_id: str, source: str, text_hash: Column) -> Column:
        none = F.lit("")
        return F.concat_ws(
            ":",
            F.coalesce(F.col(doc_id).cast("string"), none),
            text_hash.cast("string"),
            F.col(source).isNull().cast("string"),
            F.coalesce(F.col(source).cast("string"), none),
        )

    store = Store(documents.sparkSession)
    per_key = (
        copies(documents, **settings)
        .groupBy(keyed("doc_id", "source", F.col("text_hash")).alias(key))
        .agg(F.sum("copies").alias("all"), F.count("*").alias("rows"))
        .where(F.col("all") > 0)
    )
    rows = documents.select(
        "*", keyed("doc_id", "source", F.xxhash64(text_of())).alias(key), F.xxhash64(*documents.columns).alias(row)
    )
    in_key = Window.partitionBy(key).orderBy(row).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    distinct = rows.groupBy(key, row).agg(F.count("*").alias(n)).withColumn(before, F.sum(n).over(in_key) - F.col(n))
    extra = F.greatest(F.lit(0), F.least(F.col(n), F.col("all") % F.col("rows") - F.col(before)))
    share = store.keep(
        distinct.join(per_key, key)
        .select(key, row, (F.expr("`all` div `rows`") * F.col(n) + extra).alias(taken))
        .where(F.col(taken) > 0),
        "taken",
    )
    few, many = share.where(F.col(taken) <= BLOCK), share.where(F.col(taken) > BLOCK)

    def once(df: DataFrame) -> DataFrame:
        same = Window.partitionBy(key, row).orderBy(F.lit(0))  # equal in all columns
        return df.withColumn(first, F.row_number().over(same)).where(F.col(first) == 1).drop(first)

    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(taken))).alias(first)
    unfolded = once(rows).join(few, [key, row]).select(*documents.columns, each).drop(first)
    heavy = once(rows.join(many, [key, row])).select(*documents.columns, taken)
    return unfolded.unionByName(numbered_copies(heavy, taken, first).select(*documents.columns))
