"""The URL filter against brute force: every subset of every basket is counted."""

from __future__ import annotations

import itertools
import math
import random
from collections import Counter
from urllib.parse import urlsplit

import pytest

from tillwatch.llm import url_rules

PAGES = "page_id long, url string, html string, host string, rule string, tokens string, verdict int"


def pages(spark, urls):
    rows = [(i if i % 7 else None, u, "x", "y", "z", "t", 3) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, PAGES)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "#?":
        rest = rest.split(mark, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if c.isascii() else c for c in host), slash + path


def tokens(host, path):
    for mark in "-_:":
        host = host.replace(mark, ".")
    extension = path.rsplit("/", 1)[-1].rpartition(".")
    found = ["h:" + w for w in host.split(".")] + ["p:" + w for w in path.split("/")]
    found += ["x:" + extension[2]] if extension[1] else []
    return tuple(dict.fromkeys(t for t in found if len(t) > 2))


def from_list(host, path):
    fits = [
        r for r in url_rules.LIST if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else None


def expected(urls, min_support, min_confidence):
    distinct = {split(u) for u in urls}
    listed = {k: v for k in distinct if (v := from_list(*k))}
    counts, by_verdict = Counter(), Counter()
    for key, (_, verdict) in listed.items():
        basket = sorted(tokens(*key)[: url_rules.BASKET])
        for n in range(1, len(basket) + 1):
            for subset in itertools.combinations(basket, n):
                counts[subset] += 1
                by_verdict[subset, verdict] += 1
    least = math.ceil(min_support * len(listed))
    rules = [
        (-n / counts[s], -n, len(s), " ".join(s), v, s)
        for (s, v), n in by_verdict.items()
        if n >= least and n / counts[s] >= min_confidence
    ]
    out = []
    for i, url in enumerate(urls):
        key = split(url)
        own = set(tokens(*key))
        if key in listed:
            last = (*listed[key], None, None)
        else:
            best = min((r for r in rules if own.issuperset(r[5])), default=None)
            last = (None, best[4], best[3], -best[0]) if best else (None, url_rules.DEFAULT, None, None)
        out.append((i if i % 7 else None, *key, *last))
    return sorted(out, key=repr)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def urls(n, rng):
    hosts = ["a.com", "EXAMPLE.com", "www.example.com", "m.www.example.com", "x-y.example.org", "b.net", "c_d.net", "xcom", "é.org", "a.b.c.org:80"]
    paths = ["", "/", "/en/", "/en/a.html", "/fr/x", "/es/", "/es/b/c.d.pdf", "/de", "//de//q", "/en", "/日本/"]
    tails = ["", "?a=/es/", "#/fr/", "?x://net/fr/", "#top?x"]
    return [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for _ in range(n)]


AWKWARD = [None, "", "no scheme", "://", "x://", "http://", "HTTP://A.COM/", "http://com/", "http://.com/x", "http://é.NET/es/" + "long/" * 4_000, "http://a.net\n/fr/x"]


@pytest.mark.parametrize(("support", "confidence"), [(0.02, 0.8), (0.1, 0.51), (0.02, 1.0)])
def test_judge(spark, support, confidence):
    rng = random.Random(5)
    given = urls(400, rng) + ["http://b.net/fr/x"] * 200
    assert tuples(url_rules.judge(pages(spark, given), min_support=support, min_confidence=confidence)) == expected(given, support, confidence)


def test_awkward_urls(spark):
    given = AWKWARD * 2 + urls(30, random.Random(2))
    assert tuples(url_rules.judge(pages(spark, given))) == expected(given, url_rules.MIN_SUPPORT, url_rules.MIN_CONFIDENCE)


@pytest.mark.parametrize(("basket", "support", "confidence"), [(1, 0.02, 0.8), (2, 0.1, 0.51), (3, 0.05, 1.0)])
def test_all_tokens_are_mined_however_few_fp_growth_takes_at_once(spark, monkeypatch, basket, support, confidence):
    rng = random.Random(basket)
    paths = ["/" + "/".join(rng.sample(["en", "es", "fr", "a", "b", "c", "d", "e"], 5)) for _ in range(60)]
    given = urls(200, rng) + [f"http://{rng.choice(['x.com', 'b.net', 'example.com', 'c.org'])}{p}{rng.choice(['', '.html'])}" for p in paths * 2]
    monkeypatch.setattr(url_rules, "BASKET", 100)
    whole = expected(given, support, confidence)
    monkeypatch.setattr(url_rules, "BASKET", basket)
    assert tuples(url_rules.judge(pages(spark, given), min_support=support, min_confidence=confidence)) == whole


def test_words_behind_the_twelfth_decide(spark):
    """All 13 words before it are in every listed URL, so only the last segment tells the verdicts apart."""
    long = "/".join(f"s{i}" for i in range(10))
    given = [f"http://www.a.b.net/{k}/{long}/{w}/q{i}" for i in range(8) for k, w in (("es", "bad"), ("de", "good"))]
    given = [u.replace("net/de", "com/de") for u in given] + [f"http://u.org/{w}" for w in ("bad", "good")]
    found = {r["path"]: r for r in url_rules.judge(pages(spark, given), min_support=0.2).collect()}
    assert (found["/bad"]["verdict"], found["/bad"]["mined"], found["/bad"]["confidence"]) == ("block", "p:bad", 1.0)
    assert (found["/good"]["verdict"], found["/good"]["mined"]) == ("allow", "p:good")


def test_long_paths_that_urls_share(spark):
    """Forty words in both verdicts, and the beginnings of another forty: their subsets are never written out."""
    shared, steps = [f"s{i}" for i in range(40)], [f"t{i}" for i in range(40)]
    paths = ["/".join(shared), *("/".join(steps[:n]) for n in range(1, 41))]
    given = [f"http://{host}/{p}" for p in paths for host in ("a.com", "b.com", "c.com", "a.net/es")]
    given += ["http://u.org/es/s3/t9", "http://u.org/s3/t9", "http://u.org/x"]
    found = {r["path"]: r for r in url_rules.judge(pages(spark, given), min_support=0.01, min_confidence=0.7).collect()}
    assert (found["/es/s3/t9"]["verdict"], found["/es/s3/t9"]["mined"]) == ("block", "p:es")
    # Three of four say allow, of all beginnings alike: the one of the most URLs decides.
    assert (found["/s3/t9"]["verdict"], found["/s3/t9"]["mined"], found["/s3/t9"]["confidence"]) == ("allow", "p:t9", 0.75)
    assert (found["/x"]["verdict"], found["/x"]["mined"]) == ("allow", None)


def test_nothing_to_learn_from(spark):
    assert url_rules.judge(pages(spark, [])).collect() == []
    given = ["http://a.org/x", None]
    assert tuples(url_rules.judge(pages(spark, given))) == expected(given, url_rules.MIN_SUPPORT, url_rules.MIN_CONFIDENCE)


def test_urls_parse_as_usual():
    for url in urls(300, random.Random(9)):
        parts = urlsplit(url)
        assert split(url) == (parts.netloc.lower(), parts.path)


def test_no_python_in_the_plan(spark):
    df = url_rules.judge(pages(spark, urls(50, random.Random(1))))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
