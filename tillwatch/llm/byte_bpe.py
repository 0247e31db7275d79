"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary is a file of ranks (base64 of a token's bytes, and its number). The tokenizers library
works on characters, so each byte is mapped to a printable one; every split of a token into two tokens
is a merge, in the order of the ranks. Texts are cut by a pattern, and each piece is encoded by
itself. The pattern never looks past a single space between two words, so a text is first cut there;
such words repeat a lot, and a worker remembers what they are encoded and decoded to, in two generations of
bounded size: when the younger one is full the older one goes, and words that are met move up. New words go to
the library together, many in one text.

The library breaks ties between two ways of forming the same token by the order of its merges, rank
files by the position in the text. That matters only where parts x, y, z stand in a row and xy = yz
is a token, x not being y. Pieces that hold such an xyz are merged by rank and position here.

Decoding turns the characters of each id's token into bytes by the reversed byte table and joins them; characters
that were split over tokens come together again, and only then are bytes read as UTF-8.

Nulls: a null text is encoded as an empty one, which has no ids. Repeated rows give repeated rows, other
columns are not read, an empty table gives an empty result. No special tokens are added, and their
strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import accumulate, chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tillwatch.llm.common import arrow_rows, map_arrow, text_of

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Words of a generation that a worker remembers, and their characters; longer words are not remembered.
REMEMBERED, LONGEST = 600_000, 200
REMEMBERED_CHARS = 16 * REMEMBERED
#: Characters of the texts whose new words are learnt together, and pieces in one text for the library.
CHARS, TOGETHER = 500_000, 200
#: Stands between pieces there, and is a token of its own.
_BETWEEN = "\x00"
#: What often ends a word, and is a piece of its own after letters.
_ENDS = frozenset(".,;:!?")
_GAP = re.compile(r"\s ").search


def byte_characters() -> dict[int, str]:
    """Each byte as a printable character: itself if it prints, else one from 256 on."""
    table, spare = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[b] = chr(b)
        else:
            table[b] = chr(spare)
            spare += 1
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _words(text: str) -> list[str]:
    """The text cut at each space that has no other white space beside it; the first part has none before it."""
    parts = text.split(" ")
    if not _GAP(text):
        return parts
    out, run = [], []
    for part in parts:
        run.append(part)
        if part and not part[-1].isspace():
            out.append(" ".join(run))
            run = []
    return [*out, " ".join(run)] if run else out


#: What a piece or a word is encoded to: its ids as text, each with a comma, and the bytes that they decode to.
Piece = tuple[str, bytes]


class Codec:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pieces = regex.compile(pattern).findall
        self.library = self._library()
        characters = {c: b for b, c in byte_characters().items()}
        #: The bytes of each id: the characters of its token, read back by the reversed byte table.
        self.bytes_of = {
            rank: bytes(map(characters.__getitem__, token)) for token, rank in self.library.get_vocab().items()
        }
        self.listed = {rank: f"{rank}," for rank in self.bytes_of}
        #: With the token that stands between pieces written as itself.
        self.listed_apart = self.listed | {self.ranks[_BETWEEN.encode()]: _BETWEEN}
        self.spaced: dict[str, Piece] = {}  # words after a space
        self.spaced_before: dict[str, Piece] = {}
        self.known: dict[str, Piece] = {}  # pieces without a space before them
        self.known_chars = self.spaced_chars = 0
        self.ties = self._ties()

    def _library(self) -> Tokenizer:
        characters = byte_characters()

        def named(token: bytes) -> str:
            return "".join(map(characters.__getitem__, token))

        merges = []
        for token in sorted(self.ranks, key=self.ranks.__getitem__):
            halves = [(token[:i], token[i:]) for i in range(1, len(token))]
            merges += [(named(a), named(b)) for a, b in halves if a in self.ranks and b in self.ranks]
        vocab = {named(token): rank for token, rank in self.ranks.items()}
        library = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0))
        library.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(_BETWEEN, "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        return library

    def _ties(self) -> ahocorasick.Automaton:
        """Finds, in bytes read as Latin-1, what the library and the ranks may merge differently."""
        found, ranks = ahocorasick.Automaton(), self.ranks
        for token in ranks:
            for i in range(1, len(token)):
                x, y, z = token[:i], token[i:], token[-i:]
                if x != y and len(y) + i == len(token) and y + z == token and x in ranks and y in ranks and z in ranks:
                    found.add_word((x + y + z).decode("latin-1"), True)
        found.make_automaton()
        return found

    def _tied(self, pieces: list[bytes]) -> set[int]:
        """The numbers of the pieces that hold such bytes."""
        if self.ties.kind != ahocorasick.AHOCORASICK:
            return set()
        # What stands between them is no byte, so nothing is found across it.
        ends = list(accumulate(len(p) + 1 for p in pieces))
        joined = "\u0100".join(p.decode("latin-1") for p in pieces)
        return {bisect_right(ends, at) for at, _ in self.ties.iter(joined)}

    def _piece(self, ids: list[int]) -> Piece:
        return "".join(map(self.listed.__getitem__, ids)), self.decode(ids)

    def _learnt(self, pieces: list[str]) -> dict[str, Piece]:
        """Pieces as they are encoded, many of them in one text for the library."""
        raw = [p.encode() for p in pieces]
        own = self._tied(raw)
        own.update(i for i, r in enumerate(raw) if r in self.ranks or b"\x00" in r)
        plain = [p for i, p in enumerate(pieces) if i not in own] if own else pieces
        found = {pieces[i]: self._piece(self.by_rank(raw[i])) for i in own}
        texts = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        encoded = self.library.encode_batch_fast([_BETWEEN.join(t) for t in texts], add_special_tokens=False)
        for text, encoding in zip(texts, encoded, strict=True):
            ids = encoding.ids
            listed = "".join(map(self.listed_apart.__getitem__, ids)).split(_BETWEEN)
            found.update(zip(text, zip(listed, self.decode(ids).split(b"\x00"), strict=True), strict=True))
        return found

    def by_rank(self, raw: bytes) -> list[int]:
        """Merge the pair of lowest rank, the leftmost first, until none is left."""
        if raw in self.ranks:
            return [self.ranks[raw]]
        ends = list(range(1, len(raw) + 1))  # of the part that starts at i
        before = list(range(-1, len(raw) - 1))
        alive = [True] * len(raw)
        waiting: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and ends[i] < len(raw):
                to = ends[ends[i]]
                rank = self.ranks.get(raw[i:to])
                if rank is not None:
                    heapq.heappush(waiting, (rank, i, to))

        for i in range(len(raw)):
            offer(i)
        while waiting:
            _, i, to = heapq.heappop(waiting)
            if not alive[i] or ends[i] >= len(raw) or ends[ends[i]] != to or not alive[ends[i]]:
                continue
            alive[ends[i]] = False
            ends[i] = to
            if to < len(raw):
                before[to] = i
            offer(before[i])
            offer(i)
        return [self.ranks[raw[i : ends[i]]] for i in range(len(raw)) if alive[i]]

    def _cut(self, words: Iterable[str]) -> tuple[list[str], dict[str, list[str]]]:
        """Words that are one piece with the space before them, and the pieces of the others."""
        whole, cut = [], {}
        for word in words:
            if word.isascii() and word.isalpha():
                whole.append(word)
            elif word[-1:] in _ENDS and word[:-1].isascii() and word[:-1].isalpha():
                cut[word] = [f" {word[:-1]}", word[-1]]
            else:
                cut[word] = self.pieces(f" {word}")
        return whole, cut

    def _learn(self, words: set[str], firsts: list[str]) -> tuple[dict[str, Piece], list[Piece]]:
        """The words after a space, and the texts' first words, as they are encoded.

        What a piece is encoded to is taken from the word that is that piece, where it is known.
        """
        whole, cut = self._cut(words)
        starts = [self.pieces(f) for f in firsts]
        pieces, new = {}, [f" {w}" for w in whole]
        for piece in set(chain.from_iterable(chain(cut.values(), starts))).difference(new):
            if piece[0] == " ":
                known = self.spaced.get(piece[1:]) or self.spaced_before.get(piece[1:])
            else:
                known = self.known.get(piece)
            if known is None:
                new.append(piece)
            else:
                pieces[piece] = known
        learnt = self._learnt(new)
        self._remember(
            {p: found for p, found in learnt.items() if p[0] != " "},
            {p[1:]: found for p, found in learnt.items() if p[0] == " " and len(p) <= LONGEST},
        )
        pieces |= learnt
        out = {w: pieces[f" {w}"] for w in whole}
        composed = {w: _joined([pieces[p] for p in own]) for w, own in cut.items()}
        self._remember({}, {w: found for w, found in composed.items() if len(w) <= LONGEST})
        return out | composed, [_joined([pieces[p] for p in own]) for own in starts]

    def _remember(self, known: dict[str, Piece], words: dict[str, Piece]) -> None:
        """Keep pieces and words for later texts; if there are too many, those not met since the last time go."""
        for piece, found in known.items():
            if len(piece) <= LONGEST:
                if self.known_chars > REMEMBERED_CHARS or len(self.known) > REMEMBERED:
                    self.known, self.known_chars = {}, 0
                self.known[piece] = found
                self.known_chars += len(piece)
        chars = sum(map(len, words))
        if self.spaced_chars + chars > REMEMBERED_CHARS or len(self.spaced) + len(words) > REMEMBERED:
            self.spaced_before, self.spaced, self.spaced_chars = self.spaced, {}, 0
        if chars > REMEMBERED_CHARS or len(words) > REMEMBERED:
            return
        self.spaced.update(words)
        self.spaced_chars += chars

    def encode_all(self, texts: list[str]) -> Iterator[list[Piece]]:
        """The words of each text as they are encoded; the new words of all of them are learnt together."""
        cut, found, new = [], [], set()
        for text in texts:
            first, *words = _words(text)
            pieces = list(map(self.spaced.get, words))
            if None in pieces:
                new.update([w for w, p in zip(words, pieces, strict=True) if p is None])
            cut.append((first, words))
            found.append(pieces)
        again = {w: p for w in new if (p := self.spaced_before.get(w)) is not None}
        learnt, firsts = self._learn(new - again.keys(), [first for first, _ in cut])
        self._remember({}, again)
        learnt |= again
        for (_, words), pieces, first in zip(cut, found, firsts, strict=True):
            if None in pieces:
                pieces = [p or learnt[w] for w, p in zip(words, pieces, strict=True)]
            yield [first, *pieces]

    def encode(self, text: str) -> list[int]:
        (pieces,) = self.encode_all([text])
        return list(map(int, "".join([listed for listed, _ in pieces]).split(",")[:-1]))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def starts(self, ids: list[int]) -> list[int]:
        """The character in which each token begins; a token may begin within a character."""
        lead = [sum((b & 0xC0) != 0x80 for b in self.bytes_of[i]) for i in ids]
        split = [(self.bytes_of[i][0] & 0xC0) == 0x80 for i in ids]
        ends = accumulate(lead, initial=0)
        return [e - s for e, s in zip(ends, split, strict=False)]


def _joined(pieces: list[Piece]) -> Piece:
    if len(pieces) == 1:
        return pieces[0]
    return "".join([listed for listed, _ in pieces]), b"".join([decoded for _, decoded in pieces])


def _together(texts: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows whose second value is a text, about `CHARS` characters at a time."""
    held, chars = [], 0
    for row in texts:
        held.append(row)
        chars += len(row[1])
        if chars > CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


@contextmanager
def rare_collection():
    """Collect cycles only at the end: the many small results of a batch make none."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(
    documents: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """doc_id, ids, and the character in which each token starts."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32()))])

    def make(batch: pa.RecordBatch) -> Iterator[tuple]:
        own = codec(public_tokenizers.path(ranks), pattern)
        for doc_id, text in zip(*batch.columns, strict=True):
            ids = own.encode(text.as_py())
            yield doc_id.as_py(), ids, own.starts(ids)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return map_arrow(rows, arrow_rows(make, schema), "doc_id long, ids array<int>, starts array<int>")


def decode(encoded: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and the bytes of its ids; null ids count as none."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def make(batch: pa.RecordBatch) -> Iterator[tuple]:
        own = codec(public_tokenizers.path(ranks), pattern)
        for doc_id, ids in zip(*batch.columns, strict=True):
            yield doc_id.as_py(), own.decode(ids.as_py() or ())

    return map_arrow(encoded.select("doc_id", "ids"), arrow_rows(make, schema), "doc_id long, decoded binary")


def round_trip(documents: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, ids never shuffled."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]

    def make(batch: pa.RecordBatch) -> Iterator[tuple]:
        own = codec(public_tokenizers.path(ranks), pattern)
        with rare_collection():
            rows = ((doc_id.as_py(), text.as_py()) for doc_id, text in zip(*batch.columns, strict=True))
            for held in _together(rows):
                for (doc_id, _), pieces in zip(held, own.encode_all([t for _, t in held]), strict=True):
                    ids, decoded = zip(*pieces, strict=True)
                    listed = "".join(ids)
                    yield (
                        doc_id,
                        listed.count(","),
                        hashlib.sha256(listed[:-1].encode()).hexdigest(),
                        hashlib.sha256(b"".join(decoded)).hexdigest(),
                    )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(rows, arrow_rows(make, pa.schema(fields)), kinds)
