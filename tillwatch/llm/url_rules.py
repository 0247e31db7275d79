"""URL filters: a list of rules, and rules mined from what the list decides.

A listed rule names a host and the beginning of a path; it fits that host and all its subdomains, and the
longest one that fits decides. URLs that no rule fits are judged by association rules. Each distinct URL
that the list decides is a transaction: its tokens and its verdict. Spark's FP-growth finds the token
combinations that occur in at least `MIN_SUPPORT` of the transactions together with a verdict; those that
have it in at least `MIN_CONFIDENCE` of their transactions become rules. A rule goes when a rule with
one token less says the same with no less confidence: it could never decide. The others are posted in an
inverted index under their rarest token, so a URL meets the rules of its own tokens alone. Of the rules whose
tokens it all has, the most confident decides; ties go to more support, fewer tokens, then by text. With none
the verdict is `DEFAULT`.

Tokens are the words of the host (`h:`, between dots, hyphens, underscores and colons), the segments of the
path (`p:`) and the last segment's extension (`x:`). Mining and matching take all of them.

FP-growth writes out every frequent combination, up to 2 ** tokens of them for one transaction. So where a
transaction has more than `BASKET` tokens, the transactions are first projected, as often as it takes: a base
holds those that share some tokens (its prefix), each with its other tokens, the rarer ones left out as they have
bases of their own. From a base go the tokens that cannot give a deciding rule: those that are too rare in it with
either verdict, and those that all of it has, as the rule without them says the same. A base of one verdict goes
as a whole, as no longer rule is surer. FP-growth then mines all bases at once. So a long path that many URLs
share, or its beginnings, cost no more than their tokens; what is left to grow with 2 ** tokens are frequent
combinations of which each tells its transactions apart from those of all its parts.

Nulls: a null URL, or one without `://`, has an empty host and path, no tokens and the default verdict. Pages
keep their rows however often they repeat; URLs count once in mining. Nothing to learn from (an empty table,
or no URL that the list decides) means no mined rules. Columns other than page_id and url are not read.

All of it is DataFrame code; the mining is Spark ML's, in the JVM.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators.copies import COPIES, repeat_rows
from tillwatch.sources.store import Store


@dataclass(frozen=True)
class Listed:
    host: str
    path: str
    verdict: str


#: The list of the contract.
LIST = (
    Listed("com", "/", "allow"),
    Listed("example.com", "/en/", "block"),
    Listed("www.example.com", "/en/", "allow"),
    Listed("net", "/es/", "block"),
    Listed("net", "/fr/", "block"),
)
MIN_SUPPORT, MIN_CONFIDENCE, BASKET, DEFAULT = 0.02, 0.8, 12, "allow"
URL = ["host", "path"]
_VERDICT = "verdict:"


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(url, F.lit(""))
    after = F.when(F.locate("://", known) > 0, F.substring(known, F.locate("://", known) + 3, F.length(known)))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def tokens(host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, those of the host first."""
    words = F.transform(F.split(host, r"[.\-_:]+"), lambda w: F.concat(F.lit("h:"), w))
    segments = F.transform(F.split(path, "/+"), lambda s: F.concat(F.lit("p:"), s))
    extension = F.array(F.concat(F.lit("x:"), F.regexp_extract(path, r"\.([^./]*)$", 1)))
    return F.array_distinct(F.filter(F.concat(words, segments, extension), lambda t: F.length(t) > 2))


def listed(urls: DataFrame, rules: Sequence[Listed] = LIST) -> DataFrame:
    """Distinct (host, path) that a rule fits, with `rule` and `verdict` of the longest one.

    Each host meets the rules of itself and of the domains above it.
    """
    table = urls.sparkSession.createDataFrame(
        [(r.host, r.path, r.verdict) for r in rules], "of string, begins string, verdict string"
    )
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fits = (
        urls.select(*URL, F.explode(domains).alias("of"))
        .join(table, "of")
        .where(F.startswith("path", "begins"))
        .withColumn("rule", F.concat("of", "begins"))
    )
    longest = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule"))
    return fits.groupBy(*URL).agg(longest.alias("best")).select(*URL, "best.*")


def _prefix_rules(bases: DataFrame, least: int, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """What the prefixes of the bases say (antecedent, verdict, confidence, n), and which of them may grow (prefix, total)."""
    said = bases.groupBy("prefix", "verdict").agg(F.sum(COPIES).alias("n"))
    total = said.groupBy("prefix").agg(F.sum("n").alias("total"), F.max("n").alias("most"))
    rules = (
        said.join(total, "prefix")
        .withColumn("confidence", F.col("n") / F.col("total"))
        .where((F.col("n") >= least) & (F.col("confidence") >= min_confidence))
    )
    growing = total.where((F.col("most") >= least) & (F.col("most") < F.col("total")))
    return rules.select(F.array_sort("prefix").alias("antecedent"), "verdict", "confidence", "n"), growing.drop("most")


def _tokens_that_count(bases: DataFrame, growing: DataFrame, least: int) -> DataFrame:
    """The tokens (`kept`) of each growing base that are frequent in it with a verdict and not in all of it."""
    return (
        bases.select("prefix", "verdict", COPIES, F.explode("items").alias("token"))
        .groupBy("prefix", "token", "verdict")
        .agg(F.sum(COPIES).alias("n"))
        .groupBy("prefix", "token")
        .agg(F.sum("n").alias("having"), F.max("n").alias("most"))
        .join(growing, "prefix")
        .where((F.col("most") >= least) & (F.col("having") < F.col("total")))
        .groupBy("prefix")
        .agg(F.collect_set("token").alias("kept"))
    )


def _rarest_first(labelled: DataFrame, least: int) -> DataFrame:
    """One base (prefix, items, verdict, copies) of all transactions, with their frequent tokens by rising count."""
    alike = labelled.groupBy("tokens", "verdict").agg(F.count("*").alias(COPIES))
    each = alike.withColumn("token", F.explode("tokens"))
    counts = (
        each.groupBy("token", "verdict")
        .agg(F.sum(COPIES).alias("n"))
        .groupBy("token")
        .agg(F.sum("n").alias("having"), F.max("n").alias("most"))
        .where(F.col("most") >= least)
    )
    items = F.transform(F.array_sort(F.collect_list(F.struct("having", "token"))), lambda i: i["token"])
    ranked = each.join(counts, "token").groupBy("tokens", "verdict", COPIES).agg(items.alias("items"))
    nothing = F.array().cast("array<string>").alias("prefix")
    return ranked.groupBy("items", "verdict").agg(F.sum(COPIES).alias(COPIES)).select(nothing, "items", "verdict", COPIES)


def projected(labelled: DataFrame, least: int, min_confidence: float, store: Store) -> tuple[DataFrame, DataFrame]:
    """Bases with at most `BASKET` items a transaction, and the rules (as in `_prefix_rules`) of all prefixes on the way."""
    bases, rules = store.keep(_rarest_first(labelled, least), "bases"), []
    while not bases.where(F.size("items") > BASKET).isEmpty():
        longer = bases.select("prefix", "items", "verdict", COPIES, F.posexplode("items").alias("at", "token")).select(
            F.concat("prefix", F.array("token")).alias("prefix"),
            F.expr("slice(items, at + 2, size(items))").alias("items"),
            "verdict",
            COPIES,
        )
        longer = store.keep(longer, "longer")
        said, growing = _prefix_rules(longer, least, min_confidence)
        rules.append(store.keep(said, "prefix_rules"))
        narrowed = longer.join(_tokens_that_count(longer, growing, least), "prefix").select(
            "prefix", F.array_intersect("items", "kept").alias("items"), "verdict", COPIES
        )
        alike = narrowed.where(F.size("items") > 0).groupBy("prefix", "items", "verdict")
        bases = store.keep(alike.agg(F.sum(COPIES).alias(COPIES)), "bases")
        store.drop("longer")
        store.drop("bases", but=1)
    return bases, reduce(DataFrame.unionByName, rules) if rules else _prefix_rules(bases.limit(0), least, min_confidence)[0]


def _grown(baskets: DataFrame, rows: int, least: int, min_confidence: float) -> DataFrame:
    """Spark's FP-growth: the rules (antecedent, verdict, confidence, n) of `tokens` and `verdict`, each base by itself.

    Tokens and verdicts carry the number of their base, so what is frequent together is of one base.
    """

    def of_base(name: Column) -> Column:
        return F.concat(F.col("base").cast("string"), F.lit(":"), name)

    items = F.concat(F.transform("tokens", of_base), F.array(of_base(F.concat(F.lit(_VERDICT), "verdict"))))
    # Halfway to the count before, as the product of a rounded quotient may come out above the count.
    support = min(1.0, (least - 0.5) / max(rows, 1))
    model = FPGrowth(minSupport=support, minConfidence=min_confidence).fit(baskets.select(items.alias("items")))

    def name(item: Column) -> Column:
        return F.substring(item, F.locate(":", item) + 1, F.length(item))

    return (
        model.associationRules.withColumn("says", F.element_at("consequent", 1))
        .withColumn("base", F.substring_index("says", ":", 1).cast("long"))
        .withColumn("says", name(F.col("says")))
        .where(F.startswith("says", F.lit(_VERDICT)))
        .select(
            "base",
            F.transform("antecedent", name).alias("antecedent"),
            F.expr(f"substring(says, {len(_VERDICT) + 1})").alias("verdict"),
            "confidence",
            F.round(F.col("support") * rows).cast("long").alias("n"),
        )
        .where(F.col("n") >= least)
    )


def mined(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    store: Store | None = None,
) -> DataFrame:
    """Association rules (antecedent, rarest, verdict, confidence, support) from `tokens` and `verdict`."""
    store = store or Store(labelled.sparkSession)
    transactions = labelled.count()
    least = max(1, math.ceil(min_support * transactions))
    if labelled.where(F.size("tokens") > BASKET).isEmpty():
        found = _grown(labelled.withColumn("base", F.lit(0)), transactions, least, min_confidence)
        rules = found.select(F.array_sort("antecedent").alias("antecedent"), "verdict", "confidence", "n")
    else:
        bases, rules = projected(labelled, least, min_confidence, store)
        numbers = store.keep(
            bases.select("prefix").distinct().withColumn("base", F.monotonically_increasing_id()), "numbers"
        )
        baskets = bases.join(numbers, "prefix").select("base", F.col("items").alias("tokens"), "verdict", COPIES)
        rows = bases.agg(F.coalesce(F.sum(COPIES), F.lit(0))).first()[0]
        found = _grown(repeat_rows(store.keep(baskets, "baskets")), rows, least, min_confidence).join(numbers, "base")
        whole = F.array_sort(F.concat("prefix", "antecedent")).alias("antecedent")
        rules = rules.unionByName(found.select(whole, "verdict", "confidence", "n"))
    rules = store.keep(rules.withColumn("support", F.col("n") / F.lit(transactions)).drop("n"), "rules")
    single = labelled.select(F.explode("tokens").alias("rarest")).groupBy("rarest").agg(F.count("*").alias("freq"))
    rarest = (
        rules.withColumn("rarest", F.explode("antecedent"))
        .join(single, "rarest")
        .groupBy("antecedent", "verdict", "confidence", "support")
        .agg(F.min_by("rarest", F.struct("freq", "rarest")).alias("rarest"))
    )
    shorter = rules.select(
        F.col("antecedent").alias("less"), "verdict", F.col("confidence").alias("as_sure"), F.lit(True).alias("decides")
    )
    without_one = F.transform(F.col("antecedent"), lambda t: F.array_remove("antecedent", t))
    beaten = (
        rules.select("antecedent", "verdict", "confidence", F.explode(without_one).alias("less"))
        .join(shorter, ["less", "verdict"])
        .where("as_sure >= confidence")
    )
    return rarest.join(beaten, ["antecedent", "verdict"], "left_anti")


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The (host, path, tokens) that a mined rule matches, with its verdict, text and confidence."""
    met = (
        urls.withColumn("rarest", F.explode("tokens"))
        .join(rules, "rarest")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
        .select(*URL, "verdict", "confidence", "support", "antecedent", F.array_join("antecedent", " ").alias("mined"))
    )
    order = F.struct(-F.col("confidence"), -F.col("support"), F.size("antecedent"), "mined")
    first = F.min_by(F.struct("verdict", "mined", "confidence"), order)
    return met.groupBy(*URL).agg(first.alias("best")).select(*URL, "best.*")


def judge(
    pages: DataFrame,
    rules: Sequence[Listed] = LIST,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (the tokens that decided), confidence; a row for each page."""
    spark: SparkSession = pages.sparkSession
    store = Store(spark)
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = store.keep(
        rows.groupBy(*URL).agg(F.count("*").alias("pages")).withColumn("tokens", tokens(F.col("host"), F.col("path"))),
        "urls",
    )
    by_list = store.keep(listed(urls, rules), "listed")
    labelled = store.keep(urls.join(by_list, URL).select("tokens", "verdict"), "labelled")
    found = store.keep(mined(labelled, min_support, min_confidence, store), "mined")
    by_rule = judged(urls.join(by_list, URL, "left_anti"), found)
    nothing = F.lit(None)
    decided = store.keep(
        by_list.select(*URL, "rule", "verdict", nothing.cast("string").alias("mined"), nothing.cast("double").alias("confidence"))
        .unionByName(by_rule.withColumn("rule", nothing.cast("string"))),
        "decided",
    )
    return rows.join(decided, URL, "left").select(
        "page_id", *URL, "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"), "mined", "confidence"
    )
