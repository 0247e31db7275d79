"""Labels and scores of the license scan against brute force, and notices of one family told apart."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tillwatch.llm import licenses

DOCS = "doc_id long, text string, label string, pos int, template string"


def scan(spark, texts, **settings):
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], DOCS)
    return {r.doc_id: r for r in licenses.scan(frame, **settings).collect()}


def words(text):
    return re.findall(licenses.WORD_ANY_CASE, "".join(c.lower() if c.isascii() else c for c in text or ""))


def expected(text, templates=licenses.TEMPLATES, gap=licenses.GAP, coverage=licenses.COVERAGE):
    """(labels, score) by comparing every pair of the text with every pair of every template."""
    found = words(text)
    labels, score = set(), 0.0
    for phrase, label in licenses.BASE.items():
        split = phrase.split()
        if any(found[i : i + len(split)] == split for i in range(len(found))):
            labels.add(label)
            score = 1.0
    telling = licenses.telling_pairs(templates, coverage)
    for template, label in templates.items():
        phrase, first, last = licenses.name_of(template)
        split = phrase.split()
        pairs = len(split) - 1
        diagonals = {}
        for p in range(len(found) - 1):
            for t in range(pairs):
                if found[p : p + 2] == split[t : t + 2]:
                    diagonals.setdefault(p - t, []).append((p, t))
        name = set(range(first, last + 1))

        def counts(places, diagonal_sets):
            told = all(places & set(lacking) for lacking in telling[phrase])
            return told and any(name <= d for d in diagonal_sets)

        spans, before = [], None
        for d in sorted(diagonals):
            if before is None or d - before > gap:
                spans.append([])
            spans[-1].append(diagonals[d])
            before = d
        for span in spans:
            sets = [{t for _, t in hits} for hits in span]
            places, at = set().union(*sets), [p for hits in span for p, _ in hits]
            votes = len(places) / pairs
            fits = max(at) - min(at) < 2 * pairs + gap
            share = votes if fits and counts(places, sets) else min(votes, coverage / 2)
            share = max([share, *[len(s) / pairs for s in sets if counts(s, [s])]])
            score = max(score, share)
            if share >= coverage:
                labels.add(label)
    return ",".join(sorted(labels)), score


NOTICE = "This work is licensed under the"
FAMILY = [
    (f"{NOTICE} GNU General Public License, version 3", "gpl,gpl-3.0"),
    (f"{NOTICE} GNU General Public License, version 2", "gpl,gpl-2.0"),
    (f"{NOTICE} GNU Affero General Public License version 3", "agpl-3.0"),
    (f"{NOTICE} GNU Lesser General Public License version 3", "lgpl-3.0"),
    (f"{NOTICE} GNU Lesser General Public License, version 2.1", "lgpl-2.1"),
    (f"{NOTICE} GNU General Public License version 1", "gpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc-4.0"),
    ("Licensed under CC BY-NC 4.0" + " 4.0" * 10, "cc-by,cc-by-nc-4.0"),
    ("Licensed under CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa-4.0"),
    ("Licensed under CC BY-NC-ND 4.0", "cc-by,cc-by-nc-nd-4.0"),
    ("Licensed under CC BY 4.0", "cc-by,cc-by-4.0"),
    ("Licensed under CC BY-NC 2.0", "cc-by"),
    ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0"),
    ("Licensed under the Apache License, Version 2.1", "apache"),
    ("Licensed under the Apache License, Version 1.1", "apache"),
    ("Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc-4.0"),
    ("Licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("Licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License", "cc-by-sa-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
     "gpl,gpl-3.0-or-later"),
    ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
     "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "lgpl-2.1-or-later"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl,mpl-2.0"),
    ("licensed under nothing at all", ""),
]


def test_families(spark):
    found = scan(spark, [t for t, _ in FAMILY])
    assert {t: found[i].labels for i, (t, _) in enumerate(FAMILY)} == dict(FAMILY)
    for i, (text, _) in enumerate(FAMILY):
        assert (found[i].labels, pytest.approx(found[i].score)) == expected(text)


def test_labels_and_scores_as_by_brute_force(spark):
    rng = random.Random(12)
    pool = [w for t in licenses.TEMPLATES for w in licenses.name_of(t)[0].split()]
    notices = [licenses.name_of(t)[0] for t in licenses.TEMPLATES] + [t for t, _ in FAMILY]
    texts = [None, "", "cc", "4.0 " * 300]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            notice = rng.choice(notices).split()
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(notice))
                change = rng.randint(0, 2)
                notice[at : at + (change != 0)] = [] if change == 1 else [rng.choice(pool)]
                notice = notice or ["x"]
            parts += [*notice, *rng.choices(pool, k=rng.randint(0, 6))]
        texts.append(" ".join(parts))
    found = scan(spark, texts)
    for i, text in enumerate(texts):
        labels, score = expected(text)
        assert (found[i].labels, round(found[i].score, 9)) == (labels, round(score, 9)), text


def test_on_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: (r.labels, round(r.score, 9)) for r in licenses.scan(docs).collect()}
    telling = [(r.doc_id, r.text) for r in docs.where(F.lower("text").rlike("licen[sc]e|permission|cc by")).collect()]
    assert len(telling) > 20
    for doc_id, text in telling:
        labels, score = expected(text)
        assert found[doc_id] == (labels, round(score, 9))
