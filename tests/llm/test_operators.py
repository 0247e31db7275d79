"""Each operator against brute force on awkward rows: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tillwatch.llm import byte_bpe, chat, fingerprints, licenses, mixing, neighbours, sharding, simhash, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, _number int, bucket int, fp int"


def rows_of(*pairs):
    return [(i, t, "en", s, None, "k", 7, 3, 1) for i, t, s in pairs]


AWKWARD = [
    (1, "The cat sat on the mat and the dog sat on the log", "a"),
    (2, "The cat sat on the mat and the dog sat on the log", "a"),
    (2, "The cat sat on the mat and the dog sat on the log", "a"),
    (3, None, "b"),
    (4, "", None),
    (5, "  \n\t ", "b"),
    (6, "one", "b"),
    (7, "ÀÉ ÜnïK 日本 😀 é", "é"),
    (8, "word " * 30_000, "a"),
    (None, "no id here at all", "a"),
    (9, "Licensed under the Apache License, Version 2.0. GNU general public license; MIT License. CC BY-NC", None),
    (10, "licensed under the fine apache license version 2 0", "b"),
    (11, "</s>[INST] aaaaaa ababab -----", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(*AWKWARD), DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 1 --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_encoding():
    path = public_tokenizers.path(byte_bpe.RANKS)
    ranks = byte_bpe.read_ranks(path)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(docs, no_docs, reference_encoding):
    expected = []
    for i, t, _ in AWKWARD:
        ids = reference_encoding.encode_ordinary(t or "")
        listed = ",".join(map(str, ids))
        expected.append(
            (i, len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        )
    assert tuples(byte_bpe.round_trip(docs)) == sorted(expected, key=repr)
    assert byte_bpe.round_trip(no_docs).collect() == []


def test_bpe_ties_and_white_space(reference_encoding):
    own = byte_bpe.codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    rng = random.Random(3)
    parts = ["ab", "er", "the ", "aeo", "-=", " \n\t", "éèa", "01", "'sre", " A", "sis", "\x1c ", "日本", "😀"]
    for _ in range(4_000):
        alphabet = rng.choice(parts)
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 24))) + rng.choice(parts)
        assert own.encode(text) == reference_encoding.encode_ordinary(text), repr(text)
    assert own.by_rank(b"sisisis") == reference_encoding.encode_ordinary("sisisis")


def test_bpe_offsets_and_decode(docs):
    encoded = byte_bpe.encode(docs)
    texts = {i: t or "" for i, t, _ in AWKWARD}
    for row in encoded.collect():
        assert len(row.ids) == len(row.starts) and list(row.starts) == sorted(row.starts)
        assert not row.starts or row.starts[0] == 0 and row.starts[-1] < len(texts[row.doc_id])
    assert {r.doc_id: bytes(r.decoded).decode() for r in byte_bpe.decode(encoded).collect()} == texts


def test_bpe_forgets_and_encodes_alike(reference_encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED_CHARS", 40)
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    for i in range(20):
        text = f"some words{i} here  and{i} {'long' * i}\n{i * 7} x"
        assert own.encode(text) == reference_encoding.encode_ordinary(text)
        assert own.known_chars <= 40 + len(text) and own.spaced_chars <= 40 + len(text)


# --- 2 --------------------------------------------------------------------------------------


def _labelled(n, rng):
    syllables = ["ba", "co", "di", "fu", "ga", "he", "lu", "mi", "no", "pe"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(8, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["scroundel", "wretch"])
        texts.append(". ".join(" ".join(words[j : j + 9]) for j in range(0, len(words), 9)))
        labels.append(int(toxic))
    return texts, labels


def test_toxicity_is_learnt_and_tolerates_gaps():
    rng = random.Random(5)
    model = toxicity.train(*_labelled(400, rng))
    texts, labels = _labelled(200, rng)
    found = model.score(toxicity.values_by_text([toxicity.sentences(t) for t in texts], model.table()))
    assert np.mean((found >= 0.3) == np.array(labels, bool)) > 0.97
    close, clean = model.score(
        toxicity.values_by_text([toxicity.sentences(t) for t in ("mi scroxundel no", "mi cobafu no")], model.table())
    )
    assert close > 0.3 > clean
    for insult in ("s.c.r.o.u.n.d.e.l", "s c r o u n d e l", "S-C-R-O-U-N-D-E-L", "w_r_e_t_c_h"):
        found = model.score(toxicity.values_by_text([toxicity.sentences(f"mi cobafu {insult} no")], model.table()))
        assert found[0] > 0.3, insult


def test_letters_set_apart_are_closed_up():
    assert toxicity.sentences("mi w.r.e.t.c.h no") == [" mi wretch no"]
    assert toxicity.sentences("a b c") == [" a b c"]  # too few to be a word
    assert toxicity.sentences("1 2 3 4 5") == [" 1 2 3 4 5"]
    assert toxicity.sentences("x a.b c.d y") == [" x a.b c.d y"]  # different signs
    assert toxicity.sentences("a " * 25) == [" " + "a" * 25]
    long = toxicity.sentences("a " * 5_000)
    assert max(map(len, long)) <= 2 * toxicity.SENTENCE_CHARS and sum(map(len, long)) >= 5_000
    assert toxicity.sentences("w\nr\ne\nt") == [" w", " r", " e", " t"]


def test_every_word_of_a_sentence_is_scored():
    assert toxicity.sentences("i saw that you are an i diot") == [" i saw that you are an i diot"]
    assert toxicity.sentences("i  d  i  o  t") == [" i d i o t"]
    letters = "abcdefghij" * 60
    parts = toxicity.sentences(" ".join(letters))  # closed up, however long
    assert len(parts) > 1 and {x[i : i + toxicity.SPAN] for x in parts for i in range(len(x))} >= {
        letters[i : i + toxicity.SPAN] for i in range(len(letters) - toxicity.SPAN + 1)
    }
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.choice([2, 3, 5, 8, 400]))) for _ in range(2_000)]
    parts = toxicity.sentences(" ".join(words))
    whole = f" {' '.join(words)}"
    at = 0
    for part in parts:  # the parts stand in the text one after the other and overlap by all that a span may need
        found = whole.find(part)
        assert 0 <= found <= max(0, at - toxicity.SPAN + 1) and len(part) <= 2 * toxicity.SENTENCE_CHARS
        at = found + len(part)
    assert at == len(whole)


def test_repeated_words_count_once():
    table = np.random.default_rng(3).random(toxicity.TABLE).astype(np.float32)

    def own(text):
        return toxicity.sentence_values([text], table)[0]

    [bag] = toxicity.features([" wretch no wretch"])
    once, crossing = toxicity.features([" wretch", " wretch no wretc"])
    assert sum(bag.values()) < sum(crossing.values()) + 1e-9
    assert all(bag.get(k, 0) >= v - 1e-9 for k, v in once.items())
    assert own(" wretch no") > 0 and toxicity.sentence_values([" no", " wretch wretch", " wretch"], table)[1] == pytest.approx(
        own(" wretch wretch"), rel=1e-5
    )
    _, _, again = toxicity._codes([" i d i", " wretch a wretch", "wretch a wretch b wretch"])
    assert np.flatnonzero(again).tolist() == [*range(15, 22), *range(39, 46)]  # not where the space is new
    few, many = (int((toxicity._codes([" no" * n])[2] == 0).sum()) for n in (4, 300))
    assert few == many  # a longer row of the same adds nothing


def test_insults_count_wherever_they_stand():
    rng = random.Random(5)
    model = toxicity.train(*_labelled(400, rng))
    plain = " ".join(["mi cobafu no", "hegalu dico", "peno"] * 900)
    texts = [f"{plain} s.c.r.o.u.n.d.e.l {plain}", f"{plain} {'o ' * 30}{' '.join('scroundel' * 4)} {plain}", plain]
    found = model.score(toxicity.values_by_text([toxicity.sentences(t) for t in texts], model.table()))
    assert found[0] > 0.3 and found[1] > 0.3 > found[2]


def test_table_scores_as_the_kernel_does():
    """The collapsed weights against subsequences counted one by one."""
    words = [" wretch", " scroundel"]
    bags = toxicity.features(words)
    table = np.zeros(toxicity.TABLE, np.float32)
    for bag in bags:
        for at, weight in bag.items():
            table[at] += weight
    text = " mi wrxetch no"
    total = 0.0
    for first in range(len(text)):
        for rest in itertools.combinations(range(first + 1, min(len(text), first + toxicity.SPAN)), toxicity.LENGTH - 1):
            picked = (first, *rest)
            sub, weight = "".join(text[i] for i in picked), toxicity.DECAY ** (picked[-1] - first + 1)
            for word in words:
                for at in itertools.combinations(range(len(word)), toxicity.LENGTH):
                    if at[-1] - at[0] < toxicity.SPAN and "".join(word[i] for i in at) == sub:
                        total += weight * toxicity.DECAY ** (at[-1] - at[0] + 1)
    expected = total / np.sqrt(1 + len(text) / toxicity.PLAIN_CHARS)
    assert toxicity.sentence_values([text], table)[0] == pytest.approx(expected, rel=1e-4)


def test_toxicity_operator(spark, docs, no_docs):
    texts, labels = _labelled(200, random.Random(6))
    corpus = spark.createDataFrame(rows_of(*[(100 + i, t, "a") for i, t in enumerate(texts)]), DOCS).union(docs)
    marks = spark.createDataFrame(
        [(100 + i, 1, x) for i, x in enumerate(labels)] + [(1, 1, None), (999_999, 0, 1), (None, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = toxicity.fit(corpus, marks)
    out = toxicity.score(corpus, model).collect()
    assert len(out) == corpus.count()
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    flagged = {r.doc_id for r in out if r.predicted}
    toxic = {100 + i for i, x in enumerate(labels) if x}
    assert len(flagged ^ toxic) <= 6
    kept = toxicity.clean(corpus, model)
    assert kept.columns == corpus.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out} - flagged
    assert toxicity.score(no_docs, model).collect() == []
    assert toxicity.fit(docs, marks.where("toxic = 0")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


# --- 3 --------------------------------------------------------------------------------------


def test_sharding(spark, docs, no_docs):
    rng = random.Random(1)
    many = rows_of(*[(i, "x" * rng.randint(0, 300), "a") for i in range(3_000)], *[(5_000, "copy", "a")] * 2_000)
    frame = spark.createDataFrame(many, DOCS)
    found, slot_map = sharding.shard(frame, 6, 512)
    rows = found.collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r["size"]
        assert 0 <= r.virtual_slot < 512
    assert len(rows) == 5_000 and set(load) == set(range(6))
    assert max(load.values()) / (sum(load.values()) / 6) < 1.01
    for shard in range(6):
        assert sorted(r.place for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert slot_map.version == 1 and slot_map.read(0).count() == slot_map.read().count() == 512
    out, _ = sharding.shard(docs, 3, 64)
    expected = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in AWKWARD]
    assert tuples(out.select("doc_id", "size", "text_crc32")) == sorted(expected, key=repr)
    assert sharding.shard(no_docs, 3, 64)[0].collect() == []


def test_slot_map_is_opened_again(spark):
    path = spark.conf.get("spark.checkpoint.dir") + "/slot_map_again"
    first = sharding.SlotMap(spark, path)
    assert first.version == -1 and first.shard == []
    first.publish([0, 1])
    again = sharding.SlotMap(spark, path)
    assert (again.version, again.shard, again.read().count()) == (0, [0, 1], 2)
    again.publish([1, 1])
    with pytest.raises(ValueError, match="slots"):
        again.publish([1, 1, 1])
    last = sharding.SlotMap(spark, path)
    assert (last.version, last.shard) == (1, [1, 1])
    assert [tuple(r) for r in last.read(0).orderBy("slot").collect()] == [(0, 0), (1, 1)]


def test_a_later_run_moves_few_slots(spark):
    rng = random.Random(6)
    path = spark.conf.get("spark.checkpoint.dir") + "/slot_map_later"
    many = spark.createDataFrame(rows_of(*[(i, "x" * rng.randint(0, 300), "a") for i in range(4_000)]), DOCS)
    _, first = sharding.shard(many.where("doc_id < 3600"), 6, 512, sharding.SlotMap(spark, path))
    found, second = sharding.shard(many, 6, 512, sharding.SlotMap(spark, path))
    assert (first.version, second.version) == (1, 2)
    assert sum(a != b for a, b in zip(first.shard, second.shard, strict=True)) < 512 / 8
    load = Counter()
    for r in found.collect():
        load[r.shard] += r["size"]
    assert max(load.values()) / (sum(load.values()) / 6) < 1.01
    with pytest.raises(ValueError, match="slots"):
        sharding.shard(many, 6, 256, sharding.SlotMap(spark, path))


def test_slot_map_edits():
    rng = random.Random(2)
    load = [rng.randint(0, 100) for _ in range(600)]
    even = [s % 5 for s in range(600)]
    new = sharding.rebalanced(even, load, 5)
    sums = [sum(w for w, s in zip(load, new) if s == k) for k in range(5)]
    assert max(sums) - min(sums) <= 0.002 * sum(load) / 5 + 1
    assert sum(a != b for a, b in zip(even, new)) < 200
    more = sharding.grown(new, load, 5)
    assert all(b in (a, 5) for a, b in zip(new, more))
    assert 0.8 < sum(w for w, s in zip(load, more) if s == 5) / (sum(load) / 6) <= 1


# --- 4 --------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, sha1 string, n int"


def test_warc(spark):
    html = "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>"
    data = [
        (1, "http://a/ü?q=%20 x", html, "s", 1),
        (2, None, html, "s", 1),
        (3, "u\r\nWARC-Type: request", html, "s", 1),
        (3, "again", html, "s", 1),
        (4, "", None, "s", 1),
        (5, "e", "", "s", 1),
        (6, "long", "y" * 300_000, "s", 1),
        (None, "n", "only", "s", 1),
        (-7, "neg", "neg", "s", 1),
    ]
    pages = spark.createDataFrame(data, PAGES)
    rows = warc.archived(pages).collect()
    largest = {}
    for i, _, h, *_ in data:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", i))
    for i, url, h, *_ in data:
        raw = (h or "").encode()
        refers = None if i is None or largest[h or ""] == i else largest[h or ""]
        match = [r for r in rows if r.page_id == i and r.target_uri == url]
        assert [(r.payload_length, r.payload_digest, r.record_type, r.refers_to) for r in match] == [
            (len(raw), warc.digest(raw), "revisit" if refers else "response", refers)
        ]
    assert warc.archived(pages.limit(0)).collect() == []
    few = warc.archived(pages, min_bytes=10_000)
    assert {r.record_type for r in few.collect()} == {"response"}


def test_warc_filters_reach_the_reader(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"p{i // 2}", "s", 1) for i in range(20)], PAGES)
    folder = "file://" + spark.conf.get("spark.checkpoint.dir") + "/warc_filters"
    warc.write(pages, folder)
    whole = warc.read(spark, folder)
    revisits = whole.where("record_type = 'revisit' and page_id >= 4")
    assert sorted(r.page_id for r in revisits.collect()) == [4, 6, 8, 10, 12, 14, 16, 18]
    assert {bytes(r.payload).decode() for r in whole.where("record_type = 'response'").collect()} == {f"p{i}" for i in range(10)}


def test_warc_reader_tests_what_is_pushed():
    from pyspark.sql.datasource import EqualTo, In, IsNotNull, StringContains
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("page_id", LongType()), StructField("record_type", StringType())])
    reader = warc.WarcReader(schema, {"path": "file:///x"})
    given = [
        EqualTo(("record_type",), "revisit"), In(("page_id",), (1, 2)), IsNotNull(("payload",)),
        StringContains(("record_type",), "r"), EqualTo(("target_uri",), "u"),
    ]
    assert list(reader.pushFilters(given)) == given[2:]  # Spark tests these itself
    assert reader.filters == given[:2]


def test_warc_skips_rejected_records(spark, monkeypatch):
    """Of rejected records, and where no payload is asked for, the payloads are not unpacked."""
    rng = random.Random(8)
    noise = "".join(chr(rng.randint(33, 1_000)) for _ in range(300_000))
    pages = spark.createDataFrame([(i, "u", f"{i}{noise}", "s", 1) for i in range(6)], PAGES).coalesce(1)
    folder = "file://" + spark.conf.get("spark.checkpoint.dir") + "/warc_skips"
    warc.write(pages, folder)
    archives = warc.WarcReader(warc.StructType([]), {"path": folder}).partitions()
    unpacked = []

    class Counting(warc._Packed):
        def _more(self):
            before = len(self.content)
            super()._more()
            unpacked.append(len(self.content) - before)

    monkeypatch.setattr(warc, "_Packed", Counting)

    def bytes_unpacked(schema, *filters):
        unpacked.clear()
        reader = warc.WarcReader(warc.StructType.fromDDL(schema), {"path": folder})
        assert list(reader.pushFilters(list(filters))) == []
        rows = [row for archive in archives for row in reader.read(archive)]
        return rows, sum(unpacked)

    whole, most = bytes_unpacked("page_id long, payload binary")
    assert len(whole) == 6 and len(whole[0][1]) > 300_000
    rows, some = bytes_unpacked("page_id long, payload_length long")
    assert len(rows) == 6 and some < most / 20
    rows, some = bytes_unpacked("page_id long, payload binary", warc.EqualTo(("page_id",), 3))
    assert [r[0] for r in rows] == [3] and some < most / 4


def test_warc_appends_and_overwrites(spark):
    folder = "file://" + spark.conf.get("spark.checkpoint.dir") + "/warc_appends"
    pages = spark.createDataFrame([(i, f"u{i}", f"p{i}", "s", 1) for i in range(8)], PAGES)
    warc.write(pages.where("page_id < 5"), folder)
    warc.write(pages.where("page_id >= 5"), folder)
    assert sorted(r.page_id for r in warc.read(spark, folder).collect()) == list(range(8))
    warc.write(pages.limit(0), folder)
    assert warc.read(spark, folder).count() == 8
    warc.write(pages.where("page_id = 2"), folder, mode="overwrite")
    assert [r.page_id for r in warc.read(spark, folder).collect()] == [2]


def test_warc_reads_archives_of_others(spark, tmp_path):
    import gzip

    def foreign(kind, block, content_type="application/http; msgtype=response", more=""):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:1>\r\n{more}"
        return f"{head}Content-Type: {content_type}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    body = b"<p>\r\n\r\nWARC/1.0</p>" * 3_000
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: identity\r\n\r\n" + body
    records = [
        foreign("warcinfo", b"software: x\r\n\r\n", "application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", more="WARC-Target-URI: http://a/\r\n"),
        foreign("response", http, more="WARC-Target-URI: http://a/\r\nWARC-Payload-Digest: md5:0\r\n"),
        foreign("response", b"no end of headers"),
        foreign("resource", b"", "text/plain"),
    ]
    (tmp_path / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "other.txt").write_text("no archive")
    (tmp_path / "none.warc").write_bytes(b"")
    found = warc.read(spark, f"file://{tmp_path}", verify=True).collect()
    expected = [
        ("warcinfo", None, 15, b"software: x\r\n\r\n"), ("request", "http://a/", 0, b""), ("response", "http://a/", len(body), body),
        ("response", None, None, None), ("resource", None, 0, b""),
    ] * 3
    shown = [(r.record_type, r.target_uri, r.payload_length, r.payload and bytes(r.payload) if r.payload is not None else None) for r in found]
    assert sorted(shown, key=repr) == sorted(expected, key=repr)
    heads = warc.read(spark, f"file://{tmp_path}", "record_type string, payload_length long").where("payload_length > 15").collect()
    assert [tuple(r) for r in heads] == [("response", len(body))] * 3


def test_warc_member_is_plain_gzip():
    import gzip

    raw = warc.record(1, "u", b"body", 4, warc.digest(b"body"), None, "n")
    assert gzip.decompress(warc.member(raw) + warc.member(raw)) == raw + raw


# --- 5 --------------------------------------------------------------------------------------


def test_samples_estimate_generalised_jaccard():
    rng = random.Random(4)
    for _ in range(5):
        a = Counter({f"w{i}": rng.randint(1, 6) for i in range(60)})
        b = Counter({f"w{i}": rng.randint(1, 6) for i in range(rng.randint(0, 40), 70)})
        both, either = sum((a & b).values()), sum((a | b).values())
        sa, sb = fingerprints.signatures([a, b], 2_000)
        assert fingerprints.likeness(sa, sb) == pytest.approx(both / either, abs=0.05)


def test_fingerprints(docs, no_docs):
    out = fingerprints.fingerprint_with_next(docs, bucket_rows=3).collect()
    assert len(out) == len(AWKWARD)
    order = sorted(((i is not None, i or 0), t or "") for i, t, _ in AWKWARD)
    for r in out:
        ways = set()
        for k, ((_, i), t) in enumerate(order):
            if (i if order[k][0][0] else None) == r.doc_id:
                ways.add(fingerprints.edited(t, order[(k + 1) % len(order)][1]))
        assert r.edited_sha256 in {hashlib.sha256(w.encode()).hexdigest() for w in ways}
        own = fingerprints.signatures([fingerprints.bag(dict((i, t or "") for i, t, _ in AWKWARD)[r.doc_id])])[0]
        assert r.fingerprint == fingerprints._hex(own)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert fingerprints.fingerprint_with_next(no_docs).collect() == []
    whole = fingerprints.fingerprint_with_next(docs, bucket_rows=100).collect()
    assert sorted(map(str, whole)) == sorted(map(str, out))  # however many buckets
    assert fingerprints.fingerprint_with_next(docs.where("doc_id = 6")).collect()[0].near_next == 1.0


def _exact_likeness(a, b):
    a, b = fingerprints.bag(a), fingerprints.bag(b)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def test_production_samples_estimate_each_row(spark):
    """At 64 samples, whole rows of crowded ids, null ids and repeated rows against the exact similarity."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]

    def text():
        start = rng.randint(0, 300)
        return " ".join(rng.choice(words[start : start + 60]) for _ in range(rng.randint(0, 90)))

    data = [(i, text(), "a") for i in range(0, 900, 3)]
    data += [(30, text(), "a") for _ in range(500)]  # one id, many texts
    data += [(None, text(), "a") for _ in range(400)]
    data += [(31, "the same text over and over", "a")] * 700 + [(32, None, "a")] * 3 + [(-5, "first", "a")]
    frame = spark.createDataFrame(rows_of(*data), DOCS)
    out = fingerprints.fingerprint_with_next(frame, bucket_rows=100).collect()
    hashed = spark.createDataFrame([(t or "",) for _, t, _ in data], "text string").distinct()
    by_hash = {r.text: r.h for r in hashed.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(((i is not None, i or 0, by_hash[t or ""]), i, t or "") for i, t, _ in data)
    expected, errors = Counter(), []
    own = dict(zip(by_hash, fingerprints.signatures([fingerprints.bag(t) for t in by_hash])))
    exact = {}
    for (_, i, t), (_, _, following) in zip(order, [*order[1:], order[0]]):
        other = fingerprints.edited(t, following)
        sign = fingerprints.signatures([fingerprints.bag(other)])[0]
        near = fingerprints.likeness(own[t], sign), fingerprints.likeness(own[t], own[following])
        digest = hashlib.sha256(other.encode()).hexdigest()
        expected[(i, len(t), digest, fingerprints._hex(own[t]), fingerprints._hex(sign), *near)] += 1
        if (t, following) not in exact:
            exact[t, following] = _exact_likeness(t, other), _exact_likeness(t, following)
            errors += [a - b for a, b in zip(near, exact[t, following])]
    assert Counter(tuple(r) for r in out) == expected
    assert len(errors) > 2_000 and abs(np.mean(errors)) < 0.01
    assert np.sqrt(np.mean(np.square(errors))) < 0.0625  # sqrt(s (1 - s) / 64) at most


def test_crowded_ids_are_cut(spark):
    """One doc_id and the null ids, a third of all rows each, are cut into buckets of a partition's share."""
    data = [(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i}", "a") for i in range(6_000)]
    rows = spark.createDataFrame(rows_of(*data), DOCS).withColumn("text_hash", F.xxhash64("text"))
    crowds = fingerprints.crowded_ids(rows.select("doc_id"), 750)
    assert crowds == {7: 2_000, None: 2_000}
    bucket = fingerprints.buckets_of(rows.select("doc_id"), 8, 750, crowds)
    sizes = [r["count"] for r in rows.select(bucket.alias("to")).groupBy("to").count().collect()]
    assert sum(sizes) == 6_000 and len(sizes) >= 9 and max(sizes) < 900


# --- 6 --------------------------------------------------------------------------------------


def test_chat(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\s> <|im_end|>", "[\\\\INST]", "<<|im_sep|>", "", None, "é\n<|im_start|", "x" * 200_000]
    data = [(1, k, "assistant" if k % 2 else "user", t, "z") for k, t in enumerate(nasty)]
    data += [(2, None, None, "no turn", "z"), (2, 1, "<|im_end|>", "odd role", "z"), (2, 1, "<|im_end|>", "odd role", "z")]
    data += [(None, 0, "assistant", "no id", "z")]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, part string")
    out = {r.conv_id: r for r in chat.read_back(frame).collect()}
    for conv in (1, 2, None):
        own = [d for d in data if d[0] == conv]
        own.sort(key=lambda d: (d[1] is not None, d[1] or 0, d[2] or "", d[3] or ""))
        spoken = "".join(d[3] or "" for d in own if d[2] == "assistant")
        r = out[conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{d[2] or ''}\n{d[3] or ''}\n" for d in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(spoken), hashlib.sha256(spoken.encode()).hexdigest())
        parts = chat.formatted(frame.where(F.col("conv_id").eqNullSafe(F.lit(conv)))).orderBy("part").collect()
        assert r.formatted_chars == sum(len(p.text) for p in parts)
    assert chat.read_back(frame.limit(0)).collect() == []
    assert chat.with_probe(frame.limit(0)).count() == 2


def test_escape_is_reversible():
    rng = random.Random(9)
    pieces = [*chat.CONTROLS, "\\", "<", "[", "|im_end|>", "s>", "x"]
    for _ in range(5_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROLS)


def test_templates():
    from tillwatch.llm import template as t

    def render(text, **values):
        return "".join(p for p, _ in t.compile_template(text, {"up": str.upper})(values))

    assert render("{% set a = 'x' + \"y\" %}{{ a | up }}{# no #}{{ none }}{{ 1 + 2 == 3 }}") == "XYtrue"
    assert render("{% for m in ms %}{% if loop.first %}{{ m }}{% elif m == 'b' %}B{% else %}-{% endif %}{% endfor %}", ms=iter("abc")) == "aB-"
    body = t.fold(t.parse("a{{ 'b' | up }}{% if 1 == 2 %}c{% else %}d{% endif %}{{ x }}{% if not false and x %}e{% endif %}"), {"up": str.upper})
    assert body == (t.Show(t.Const("aBd")), t.Show(t.Name("x")), t.If(t.Name("x"), (t.Show(t.Const("e")),), ()))
    for bad in ("{{ x.__class__ }}", "{{ f(1) }}", "{% for x %}{% endfor %}", "{% if x %}", "{{ x | none }}", "{% endif %}", "{{ 'a }}"):
        with pytest.raises(t.TemplateError):
            t.compile_template(bad, {})
    for dead in ("{% if false %}{{ 'a' + 1 }}{% endif %}z", "{% if true or 'a' + 1 %}z{% else %}{{ 1 + 'a' }}{% endif %}"):
        assert render(dead) == "z"
    with pytest.raises(t.TemplateError):
        render("{{ x.real }}", x=1)
    with pytest.raises(t.TemplateError):
        render("{% for x in y %}{{ x }}{% endfor %}", y="text")


# --- 7 --------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, b int, q int, dim int"


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    points = rng.standard_normal((900, 16)).astype(np.float32)
    points[500:700] = points[500]  # one very common vector
    data = [(i, p.tolist(), 0, 1, 1, 1) for i, p in enumerate(points)]
    data += [(200, None, 0, 1, 1, 1), (1_000, [], 0, 1, 1, 1), (1_100, [0.0] * 16, 0, 1, 1, 1), (1_200, [float("nan")] * 16, 0, 1, 1, 1)]
    data += [(1_300, [None] * 16, 0, 1, 1, 1), (None, [1.0] * 16, 0, 1, 1, 1), (1_400, [1.0, 2.0], 0, 1, 1, 1), (1_500, [1.0, 3.0], 0, 1, 1, 1)]
    data += data[:3]
    frame = spark.createDataFrame(data, VECTORS)
    out = neighbours.nearest_neighbours(frame, block=200).collect()
    exact, found = 0, {}
    for r in out:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {*range(0, 900, 100), 1_400, 1_500}
    assert [(r[1], r[2]) for r in found[1_400]] == [(1_500, 1.0)]
    for query in range(0, 900, 100):
        far = np.sqrt(((points.astype(float) - points[query]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(900), far)) if i != query][:10]
        own = sorted(found[query])
        assert [r[0] for r in own] == list(range(1, 11))
        assert [r[2] for r in own] == pytest.approx([far[r[1]] for r in own], abs=1e-12)
        exact += len({r[1] for r in own} & set(order))
        if query == 500:
            assert [r[1] for r in own] == order
    assert exact / 90 >= 0.9
    assert neighbours.nearest_neighbours(frame.limit(0)).collect() == []


def test_a_forest_ascends_only_as_far_as_it_must():
    """Clustered vectors: few are compared; the candidates are those that share the prefix in some tree."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((200, 24))
    points = np.repeat(centres, 30, axis=0) + 0.05 * rng.standard_normal((6_000, 24))
    ids = np.arange(len(points))
    forest = neighbours.Forest(points, points.mean(axis=0))
    strings = forest.strings(points)
    for length in (0, 3, 17, forest.bits):
        a, b = forest.spans(strings[:, 40], length)
        same = (strings >> (forest.bits - length)) == (strings[:, 40, None] >> (forest.bits - length))
        for t in range(forest.trees):
            assert sorted(forest.order[a[t] : b[t]]) == np.flatnonzero(same[t]).tolist()
    found = 0
    for own in range(0, 6_000, 100):
        near, far = forest.search(points[own], ids, own, 10, neighbours.MISS)
        every = np.sqrt(((points - points[own]) ** 2).sum(axis=1))
        every[own] = np.inf
        assert far.tolist() == every[near].tolist()
        found += len(set(near) & set(np.lexsort((ids, every))[:10]))
    assert found >= 0.97 * 600
    assert forest.compared < 0.05 * 60 * len(points)


# --- 8 --------------------------------------------------------------------------------------


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(spark, docs, no_docs):
    rng = random.Random(8)
    many = [(i, "w " * rng.choice([1, 3, 20, 0]), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(1_500)]
    many += [(7_000, "same text here", "a")] * 800 + [(8_000, "tiny", "z")] + [(None, "x y", "b")] * 3
    frame = spark.createDataFrame(rows_of(*many), DOCS)
    out = mixing.copies(frame, fan_in=8).collect()
    assert len(out) == len(many)
    sizes, taken = Counter(), Counter()
    for _, t, s in many:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    expected = _targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r["size"]
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 20
    assert tuples(mixing.copies(frame, fan_in=8)) == sorted((tuple(r) for r in out), key=repr)
    mixed = mixing.mix(frame, fan_in=8)
    assert mixed.columns == frame.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in _per_id(out).items() if n})
    assert mixing.copies(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []
    assert sum(r.copies for r in mixing.copies(docs).collect()) == mixing.mix(docs).count()


def _per_id(out):
    total = Counter()
    for r in out:
        total[r.doc_id] += r.copies
    return total


def test_mixing_keeps_expectations(spark):
    frame = spark.createDataFrame(rows_of(*[(i, "w " * (1 + i % 7), "a") for i in range(3_000)]), DOCS)
    by_size = Counter()
    for r in mixing.copies(frame, share=0.4).collect():
        by_size[r["size"]] += r.copies
    for size in range(1, 8):
        assert by_size[size] / (3_000 / 7) == pytest.approx(0.4, abs=0.1)


# --- 9 --------------------------------------------------------------------------------------


def _license(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [
        (i, label)
        for phrase, label in licenses.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({x for _, x in places})),
    )


def test_licenses(spark, docs, no_docs):
    more = [
        (20, "MIT License MIT\nlicense cc by cc-by CC_BY", "a"),
        (21, "the miK mit licenseé İmit license", "a"),
        (22, "This work is licensed under the GNU General Public License, version 3.", "a"),
        (23, "Permission is hereby granted, free of charge, to any person getting a copy of this nice software and "
             "associated documentation files", "a"),
        (24, "under free charge license public copy", "a"),
    ]
    frame = docs.union(spark.createDataFrame(rows_of(*more), DOCS))
    out = licenses.scan(frame).collect()
    assert len(out) == len(AWKWARD) + len(more)
    texts = {i: t for i, t, _ in [*AWKWARD, *more]}
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _license(texts[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    labels = {r.doc_id: r.labels.split(",") for r in out}
    assert "apache-2.0" in labels[10] and "gpl-3.0" in labels[22] and "mit-text" in labels[23] and labels[24] == [""]
    assert licenses.scan(no_docs).collect() == []


def test_licenses_of_one_family_are_told_apart(spark):
    notice = "This work is licensed under the GNU General Public License"
    cases = [
        (1, f"{notice}, version 3", {"gpl-3.0"}),
        (2, f"{notice}, version 2", {"gpl-2.0"}),
        (3, f"{notice}, version 1", set()),
        (4, f"{notice}.", set()),
        (5, f"{notice}, version 2, or at your choice {notice}, version 3", {"gpl-2.0", "gpl-3.0"}),
        (6, "Licensed under the fine GNU General Public License version 3", {"gpl-3.0"}),
    ]
    out = licenses.scan(spark.createDataFrame(rows_of(*[(i, t, "a") for i, t, _ in cases]), DOCS)).collect()
    assert {r.doc_id: set(r.labels.split(",")) - {"", "gpl"} for r in out} == {i: x for i, _, x in cases}
    assert licenses.telling_pairs({"a b c d e f": "x", "a b c d e g": "y"}) == {"a b c d e f": [[4]], "a b c d e g": [[4]]}


# --- 10 -------------------------------------------------------------------------------------


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_are_simhash():
    for _, t, _ in AWKWARD:
        assert simhash.fingerprint((t or "").encode()) == _fingerprint(t)


def test_spark_hashes_shingles_alike(spark):
    [row] = spark.sql("select xxhash64('the cat sat') as h").collect()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"the cat sat", 42)


def _components(fps, radius=2):
    parent = {f: f for f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= radius:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return {f: top(f) for f in fps}


@pytest.mark.parametrize("limit", [2, 6, 256])
def test_links_connect_as_all_pairs_do(spark, limit):
    from tillwatch.sources.store import Store

    rng = random.Random(limit)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(450):  # chains and dense balls
        f = rng.choice(sorted(fps))
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    fps |= {0, (1 << 64) - 1}
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    store = Store(spark)
    roots = {r.a: r.b for r in simhash.connected(simhash.links(frame, store, limit=limit), store).collect()}
    groups = {}
    for f in fps:
        groups.setdefault(roots.get(simhash._signed(f), simhash._signed(f)), set()).add(f)
    expected = {}
    for f, r in _components(fps).items():
        expected.setdefault(r, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert [name for name, *_ in store._paths] == ["crowded", "small_star"]  # no older step is left


def test_near_duplicates(spark, docs, no_docs):
    long = " ".join(f"w{i}" for i in range(400))
    more = [(30, long, "a"), (31, long.replace("w7 ", "v7 "), "a"), (32, long.upper(), "b"), (33, "other words " + long[:900], "a")]
    frame = docs.union(spark.createDataFrame(rows_of(*more), DOCS))
    data = [*AWKWARD, *more]
    fps = {f: None for f in {_fingerprint(t) for _, t, _ in data}}
    roots = _components(fps)
    first = {}
    for i, t, _ in data:
        if i is not None:
            r = roots[_fingerprint(t)]
            first[r] = min(i, first.get(r, i))
    out = simhash.near_duplicates(frame)
    expected = [(i, simhash._signed(_fingerprint(t)), first.get(roots[_fingerprint(t)])) for i, t, _ in data]
    assert tuples(out.select("doc_id", "fp", "component_id")) == sorted(expected, key=repr)
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted({e[2] for e in expected}, key=repr)
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.one_of_each(no_docs).collect() == []


def test_bk_tree_follows_edges_within_the_radius():
    rng = random.Random(0)
    tree, members = simhash.BKTree(), [rng.getrandbits(16) for _ in range(400)]
    for m in members:
        tree.add(m)
    for query in (rng.getrandbits(16) for _ in range(50)):
        assert sorted(tree.within(query, 2)) == sorted({m for m in members if (m ^ query).bit_count() <= 2})
    for parent, below in tree.children.items():
        assert all((parent ^ child).bit_count() == edge for edge, child in below.items())


# --- whatever the order and the columns -----------------------------------------------------

TIES = "doc_id long, text string, lang string, source string, n_chars long, toxic int, _labelled string, _number_n int, _number_i int, _key string, _block int"


def ties(spark):
    rows = [(i // 6, "same words here", lang, "s", n, 1, "l", 2, 3, "k", 4) for i in range(24) for lang, n in (("en", 1), ("de", None))]
    rows += [(100 + i, f"text number {i} of them all", "en", "t", i, 0, None, 2, 3, "k", 4) for i in range(30)]
    rows += [(None, "no id", "en", None, 1, 0, None, None, None, None, None)] * 3
    return spark.createDataFrame(rows, TIES)


@pytest.mark.parametrize("stage", [mixing.mix, simhash.one_of_each])
def test_stages_do_not_depend_on_order(spark, stage):
    given = ties(spark)
    found = [tuples(stage(df)) for df in (given.coalesce(1), given.repartition(3), given.orderBy(F.desc("lang")).repartition(8, "lang"))]
    assert found[0] == found[1] == found[2]
    assert stage(given).columns == given.columns
    rows = Counter(tuple(r) for r in given.collect())
    if stage is mixing.mix:
        assert all(n <= 2 * rows[row] for row, n in Counter(found[0]).items())
    else:
        assert len(found[0]) == len({r[:2] for r in found[0]})


def test_mix_takes_as_many_words_as_copies_does(spark):
    given = ties(spark)
    taken = mixing.copies(given).groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("n")).where("n > 0")
    by_key = mixing.mix(given).groupBy("doc_id", "source", F.xxhash64("text").alias("text_hash")).agg(F.count("*").alias("n"))
    assert tuples(by_key) == tuples(taken)


def test_mix_unfolds_a_large_group_of_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 10)
    rows = spark.createDataFrame([(1, "a b c", "en", "s", 1)] * 300 + [(2, "d e", "en", "t", 2)] * 4, "doc_id long, text string, lang string, source string, n_chars long")
    found = Counter(tuple(r) for r in mixing.mix(rows).collect())
    taken = mixing.copies(rows).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()
    assert {k[0]: n for k, n in found.items()} == {r.doc_id: r.n for r in taken if r.n}


def test_toxicity_learns_with_clashing_columns(spark):
    given = ties(spark)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(130)], "doc_id long, toxic int, text string")
    assert toxicity.fit(given, labels) is not None
    assert toxicity.clean(given, toxicity.fit(given, labels)).columns == given.columns
