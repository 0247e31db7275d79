"""License scans by diagonal voting.

A template is a sequence of words. Each pair of neighbouring words of a text (a rolling 2-gram, as the
shortest phrases have two words) is joined by hash with the places where that pair stands in the
templates. A hit at word p of the text and word t of a template votes for the diagonal p - t. All
pairs of a template on one diagonal mean that the whole phrase stands there. Diagonals at most `GAP`
apart are merged, so that a span with words added or left out still gathers its votes; a merged span
is verified by the share of the template's pairs it holds and by its length. Licenses of a family differ in a word
or in the version, so a license's name must stand word for word (on one diagonal), and a span must also hold
one of the pairs that tell its template from each sibling that shares most of its pairs.

Base templates count only where they stand word for word. The other templates give labels of their own
where a span holds at least `COVERAGE` of them. The score is the largest share of any template, a base
phrase that stands word for word counting 1; it is 0 without a hit.

Templates are a fixed list, so their positions are broadcast; hits carry the words, which are compared
after the join by hash. Only DataFrame functions run.

Nulls: a null text is an empty one. Documents without words or hits have zero counts, null positions, empty
labels and score 0. Repeated rows give repeated rows; an empty table gives an empty result. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import text_of
from tillwatch.sources.store import Store

#: Words are runs of ASCII digits and letters, and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 2
GAP = 3
COVERAGE = 0.8

#: Phrase and label.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Phrase and label of the templates that are found with words added or left out; what stands in brackets is the
#: name of the license, which must stand word for word.
TEMPLATES = {
    "licensed under the [apache license version 2 0]": "apache-2.0",
    "licensed under the [apache license 2 0]": "apache-2.0",
    "released under the [mit license]": "mit-notice",
    "licensed under the [boost software license version 1 0]": "bsl-1.0",
    "accompanying materials are made available under the terms of the [eclipse public license v 2 0]": "epl-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit-text",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "mit-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd-3-clause",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this source code form is subject to the terms of the [mozilla public license v 2 0]": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: The same sentences hold for several licenses of a family: name, short name and versions; name and short name.
GNU = (
    ("gnu general public license", "gpl", ("2", "3")),
    ("gnu lesser general public license", "lgpl", ("2 1", "3")),
    ("gnu affero general public license", "agpl", ("3",)),
)
CREATIVE = {
    "attribution": "by",
    "attribution sharealike": "by sa",
    "attribution noderivatives": "by nd",
    "attribution noncommercial": "by nc",
    "attribution noncommercial sharealike": "by nc sa",
    "attribution noncommercial noderivatives": "by nc nd",
}
for _name, _short, _versions in GNU:
    for _version in _versions:
        _label = f"{_short}-{_version.replace(' ', '.') if ' ' in _version else _version + '.0'}"
        TEMPLATES[f"licensed under the [{_name} version {_version}]"] = _label
        TEMPLATES[
            f"you can redistribute it and or modify it under the terms of the [{_name} as published by the free software "
            f"foundation either version {_version} of the license] or at your option any later version"
        ] = f"{_label}-or-later"
for _name, _short in CREATIVE.items():
    for _version in ("3 0", "4 0"):
        _label = f"cc-{_short.replace(' ', '-')}-{_version.replace(' ', '.')}"
        TEMPLATES[f"licensed under [cc {_short} {_version}]"] = _label
        _law = "international" if _version == "4 0" else "unported"
        TEMPLATES[f"licensed under a [creative commons {_name} {_version}] {_law} license"] = _label


def name_of(template: str) -> tuple[str, int, int]:
    """A template's words without the brackets, and the first and last place of the pairs in them (1, 0: none)."""
    before, bracket, rest = template.partition("[")
    name, _, after = rest.partition("]")
    phrase = " ".join(f"{before} {name} {after}".split())
    if not bracket:
        return phrase, 1, 0
    first = len(before.split())
    return phrase, first, first + len(name.split()) - K


def lowered(text: Column) -> Column:
    """A-Z lower-cased as far as ASCII words can tell.

    `lower` also changes letters beyond ASCII, which no template holds; of those only the Kelvin sign
    would become an ASCII letter.
    """
    return F.lower(F.replace(text, F.lit("K"), F.lit("Å")))


def words(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def telling_pairs(templates: dict[str, str], coverage: float = COVERAGE) -> dict[str, list[list[int]]]:
    """For each phrase and each sibling, the places of the phrase's pairs that the sibling lacks.

    Siblings are templates with another label that hold enough of the phrase's pairs to be taken for it.
    """
    templates = {name_of(t)[0]: label for t, label in templates.items()}
    pairs = {phrase: list(zip(phrase.split(), phrase.split()[1:], strict=False)) for phrase in templates}
    out: dict[str, list[list[int]]] = {}
    for phrase, own in pairs.items():
        out[phrase] = []
        for other, others in pairs.items():
            lacking = [at for at, pair in enumerate(own) if pair not in others]
            if templates[other] != templates[phrase] and lacking and len(own) - len(lacking) >= coverage * len(own):
                out[phrase].append(lacking)
    return out


def template_table(spark: SparkSession, base: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """One row per template: its number, what it is, and its pairs as (at, a, b)."""
    rows = []
    for kind, phrases in (("base", base), ("own", templates)):
        for template, label in phrases.items():
            phrase, first, last = name_of(template)
            split = phrase.split()
            if len(split) < K:
                raise ValueError(f"a phrase needs {K} words: {phrase!r}")
            pairs = [(at, a, b) for at, (a, b) in enumerate(zip(split, split[1:], strict=False))]
            rows.append((len(rows), kind, f"{kind}:{phrase}", label, len(pairs), first, last, pairs))
    kinds = (
        "number int, kind string, template string, label string, pairs int, name_first int, name_last int, "
        "places array<struct<at: int, ta: string, tb: string>>"
    )
    return spark.createDataFrame(rows, kinds)


def hits(documents: DataFrame, table: DataFrame) -> DataFrame:
    """Distinct (doc_id, text_hash, number of the template, place in the text, place in the template)."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), words(text_of()).alias("words")
    )
    pair = F.zip_with(
        "words",
        F.slice("words", F.lit(K), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.struct(F.xxhash64(a, b).alias("hash"), a.alias("a"), b.alias("b")),
    )
    pairs = rows.select("doc_id", "text_hash", F.posexplode(pair).alias("pos", "pair")).select(
        "doc_id", "text_hash", "pos", "pair.*"
    )
    places = table.select("number", F.explode("places").alias("place")).select("number", "place.*")
    places = places.withColumn("hash", F.xxhash64("ta", "tb"))
    return (
        pairs.join(F.broadcast(places), "hash")
        .where("a = ta and b = tb")
        .select("doc_id", "text_hash", "number", "pos", "at")
        .distinct()
    )


def scan(
    documents: DataFrame,
    base: dict[str, str] = BASE,
    templates: dict[str, str] = TEMPLATES,
    gap: int = GAP,
    coverage: float = COVERAGE,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    store = Store(documents.sparkSession)
    table = template_table(documents.sparkSession, base, templates)
    found = store.keep(hits(documents, table), "license_hits").join(F.broadcast(table.drop("places")), "number")
    text = ["doc_id", "text_hash"]

    exact = (
        found.where("kind = 'base'")
        .groupBy(*text, "template", "label", "pairs", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.count("*").alias("votes"))
        .where("votes = pairs")
        .select(*text, "label", F.lit("base").alias("kind"), "diagonal", F.lit(1.0).alias("share"))
    )
    spans = _spans(found.where("kind = 'own'"), gap, coverage, telling_pairs(templates, coverage))
    per_text = (
        exact.unionByName(spans)
        .groupBy(*text)
        .agg(
            F.count(F.when(F.col("kind") == "base", 1)).alias("n_base"),
            F.min(F.when(F.col("kind") == "base", F.col("diagonal"))).alias("first_word"),
            F.max(F.when(F.col("kind") == "base", F.col("diagonal"))).alias("last_word"),
            _listed(F.when(F.col("kind") == "base", F.col("label"))).alias("base_labels"),
            _listed(F.when((F.col("kind") == "base") | (F.col("share") >= coverage), F.col("label"))).alias("labels"),
            F.max("share").alias("score"),
        )
    )
    per_text = store.keep(per_text, "licenses").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    counted = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("text_hash"),
        F.regexp_count(text_of(), F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return counted.join(per_text, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _listed(label: Column) -> Column:
    return F.concat_ws(",", F.sort_array(F.collect_set(label)))


def _spans(found: DataFrame, gap: int, coverage: float, telling: dict[str, list[list[int]]]) -> DataFrame:
    """Merged diagonals of the templates that may be inexact, with their share of the template's pairs.

    A span counts in full only if it holds the license's name on one diagonal, and a pair that tells its template
    from each sibling; else it has less than `coverage`. A span of the right words is about as long as the
    template; of a longer one the best single diagonal counts.
    """
    text = ["doc_id", "text_hash", "template", "label", "pairs"]
    in_name = F.col("at").between(F.col("name_first"), F.col("name_last"))
    by_diagonal = (
        found.groupBy(*text, "name_first", "name_last", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(
            F.collect_set("at").alias("places"),
            F.count_if(in_name).alias("of_name"),
            F.min("pos").alias("first"),
            F.max("pos").alias("last"),
        )
        .withColumn("named", F.col("of_name") == F.greatest(F.col("name_last") - F.col("name_first") + 1, F.lit(0)))
    )
    in_order = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order) > gap
    merged = by_diagonal.withColumn("starts", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "span", F.sum("starts").over(in_order)
    )

    def full(places: str, named: str) -> Column:
        told = F.col(named)
        for phrase, siblings in telling.items():
            for lacking in siblings:
                holds = F.arrays_overlap(places, F.array(*[F.lit(at).cast("int") for at in lacking]))
                told = told & ((F.col("template") != f"own:{phrase}") | holds)
        return told

    alone = F.when(full("places", "named"), F.size("places") / F.col("pairs"))
    spans = (
        merged.withColumn("alone", alone)
        .groupBy(*text, "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"),
            F.max("named").alias("named"),
            F.max("alone").alias("alone"),
            F.min("diagonal").alias("diagonal"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .withColumn("votes", F.size("places") / F.col("pairs"))
    )
    fits = F.col("last") - F.col("first") < F.col("pairs") * 2 + gap
    together = F.when(fits & full("places", "named"), F.col("votes")).otherwise(F.least(F.col("votes"), F.lit(coverage / 2)))
    share = F.greatest(together, F.coalesce("alone", F.lit(0.0)))
    return spans.select("doc_id", "text_hash", "label", F.lit("own").alias("kind"), "diagonal", share.alias("share"))
