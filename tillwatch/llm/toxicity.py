"""Toxicity by a support vector machine on a subsequence string kernel, with Nystroem landmarks.

The kernel of two strings counts the subsequences of `LENGTH` characters that both hold, each occurrence
weighted by DECAY ** (the characters it spans), up to a span of `SPAN`. A gap only lowers the weight, so
`i.d.i.o.t` and `idxiot` still resemble `idiot`. Landmarks are words, those that tell the labelled classes
apart best; a sentence is described by its kernel values with the landmarks, whitened by the landmarks' own
kernel matrix (Nystroem), and divided by the square root of its length. A linear machine (hinge loss) is
trained on labelled sentences: labels are on documents, so of a toxic document the sentence that the machine
holds most toxic is the example, chosen anew in each round, and of a clean one every sentence is an example,
of which the hardest are used. A document's score comes from its worst sentence and from how much there is of
such sentences, through a logistic curve fitted to the training documents.

As whitening and the machine are linear, the machine is one weight per subsequence, and scoring a text is a
sum over its places and gaps: no landmark is compared again. Subsequences are hashed to `TABLE` numbers.

The only thing that is bounded is the fit: at most `MAX_DOCUMENTS` labelled documents of each class, the
first by a hash of the id. Every text is scored whole: no word is left out, and long sentences are cut into parts
that overlap by as much as a subsequence may span. What is said again and again in a part says no more than once but
would add up, so a repeated word of `LENGTH` letters or more only adds what it forms with new neighbours.

Nulls: a null or empty text has no sentence and scores as a sentence without any known subsequence; labels
that are null, or of documents that are not there, are not learnt from. Repeated rows give repeated rows; of
several labels of one document the largest counts, and of several texts under one doc_id the largest is learnt from.
Without labels of both classes every score is 0. An empty
table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from tillwatch.llm.common import importable, text_of

LENGTH = 4
SPAN = 7
DECAY = 0.7
LANDMARKS = 192
#: The machine's penalty on its weights, and the part of the largest eigenvalue below which landmarks count as alike.
RIDGE = 1e-3
LEAST_EIGENVALUE = 1e-6
#: Lengths at which the beginning of a word may be a landmark.
BEGINNINGS = (5, 6, 7)
#: The chi-square root from which a word tells the classes apart.
MIN_GAIN = 4.0
#: The largest share of toxic documents that may be left out as wrongly labelled.
DOUBTFUL = 0.35
MAX_DOCUMENTS = 1_500
TABLE_BITS = 20
TABLE = 1 << TABLE_BITS
ROUNDS = 4
THRESHOLD = 0.3
#: Sentences end here; longer ones are cut, between words if these are not as long themselves.
SENTENCE_END = re.compile(r"[.!?]+(?=\s|$)|[\n\r]+")
SENTENCE_CHARS = 160
#: Four or more letters with the same sign or blank between them.
SET_APART = re.compile(r"(?<![^\W_])[^\W\d_]([^\w\n]|_)[^\W\d_](?:\1[^\W\d_]){2,}(?![^\W_])")
#: Added to a sentence's length before the root, so that very short ones don't stand out by chance.
PLAIN_CHARS = 24
BATCH_CHARS = 1 << 17

#: Offsets of the later characters of a subsequence, by its span.
GAPS = [(0, *rest) for rest in combinations(range(1, SPAN), LENGTH - 1)]
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _parts(sentence: str) -> Iterator[str]:
    """Parts of about SENTENCE_CHARS; whatever spans at most SPAN characters stands whole in one of them."""
    start = 0
    while len(sentence) - start > SENTENCE_CHARS + 1:
        cut = sentence.find(" ", start + SENTENCE_CHARS + 1, start + 2 * SENTENCE_CHARS)
        if cut < 0:
            if len(sentence) - start <= 2 * SENTENCE_CHARS:
                break
            cut = start + SENTENCE_CHARS
        yield sentence[start:cut]
        reach = cut - SPAN + 1
        word = sentence.rfind(" ", cut - SENTENCE_CHARS // 4, reach + 1)
        start = reach if word < 0 else word
    yield sentence[start:]


def sentences(text: str) -> list[str]:
    """The lower-cased sentences with all their words, cut at about SENTENCE_CHARS.

    They start with a space, so that every word does; how a word begins can be told from what it holds. Only a
    part that begins within a very long word has none.

    A word whose letters are all set apart is closed up first, as its span would exceed the kernel's.
    """
    out = []
    for sentence in SENTENCE_END.split(SET_APART.sub(lambda run: run[0][::2], text.lower())):
        words = sentence.split()
        if words:
            out.extend(_parts(f" {' '.join(words)}"))
    return out


def _known(string: str) -> Iterator[tuple[int, int, int]]:
    """First and last (exclusive) place, and up to where what begins at these places stood in the string before.

    These are words of LENGTH letters or more, with the space before them. Where neighbours recur too, so does what
    spans both: every different stretch of SPAN characters counts once.
    """
    words = string.split(" ")
    if len(set(words)) == len(words):
        return
    seen, at = set(), 0
    for word in words:
        if len(word) >= LENGTH:
            if word in seen:
                yield at - 1, at + len(word), at + len(word)
            elif at:
                seen.add(word)
        at += len(word) + 1
    if len(set(zip(words, words[1:], strict=False))) < len(words) - 1:
        seen.clear()
        for i in range(len(string) - SPAN + 1):
            stretch = string[i : i + SPAN]
            if stretch in seen:
                yield i, i + 1, i + SPAN
            else:
                seen.add(stretch)


def _codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters, the number of the string that each belongs to, and up to where it repeats (or 0)."""
    chars = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    again, first = np.zeros(len(chars), np.int64), 0
    for s in strings:
        for start, stop, end in _known(s):
            again[first + start : first + stop] = first + end
        first += len(s)
    return chars, np.repeat(np.arange(len(strings)), [len(s) for s in strings]), again


def _places(chars: np.ndarray, owner: np.ndarray, again: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each way to leave gaps: the hash at each first character, where it counts, the weight.

    It counts where it stays in its string and is not all within what repeats.
    """
    parts = [chars * m for m in _MULTIPLIERS]
    n, shift = len(chars), np.uint32(32 - TABLE_BITS)
    inside = {
        last: (owner[: n - last] == owner[last:]) & (again[: n - last] <= np.arange(last, n))
        for last in range(LENGTH - 1, SPAN)
        if last < n
    }
    for gaps in GAPS:
        last = gaps[-1]
        if last >= n:
            continue
        code = parts[0][: n - last] + parts[1][gaps[1] : n - last + gaps[1]]
        code += parts[2][gaps[2] : n - last + gaps[2]]
        code += parts[3][last:]
        yield code >> shift, inside[last], DECAY ** (last + 1)


def features(strings: list[str]) -> list[dict[int, float]]:
    """The hashed subsequences of each (short) string with their weights."""
    out: list[dict[int, float]] = [{} for _ in strings]
    chars, owner, again = _codes(strings)
    for code, inside, weight in _places(chars, owner, again):
        for i in np.flatnonzero(inside):
            bag, at = out[owner[i]], int(code[i])
            bag[at] = bag.get(at, 0.0) + weight
    return out


def _norm(owner: np.ndarray, again: np.ndarray, n: int) -> np.ndarray:
    """By the length of each of the `n` strings without what repeats."""
    return np.sqrt(1 + np.bincount(owner, weights=again == 0, minlength=n) / PLAIN_CHARS)


@dataclass
class Model:
    """Weights of the hashed subsequences that count, and the curve from a text's sentences to its score."""

    at: np.ndarray
    weight: np.ndarray
    edge: float
    slopes: np.ndarray
    offset: float

    def table(self) -> np.ndarray:
        table = np.zeros(TABLE, np.float32)
        table[self.at] = self.weight
        return table

    def score(self, values: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary(values, self.edge) @ self.slopes + self.offset, -30, 30)))


def sentence_values(strings: list[str], table: np.ndarray) -> np.ndarray:
    """The machine's value of each sentence, without its offset."""
    chars, owner, again = _codes(strings)
    total = np.zeros(len(chars), np.float32)
    by_last: dict[int, np.ndarray] = {}
    masks: dict[int, tuple[np.ndarray, float]] = {}
    for (code, inside, weight), gaps in zip(_places(chars, owner, again), (g for g in GAPS if g[-1] < len(chars)), strict=True):
        last = gaps[-1]
        if last in by_last:
            by_last[last] += table.take(code)
        else:
            by_last[last], masks[last] = table.take(code), (inside, weight)
    for last, sums in by_last.items():
        inside, weight = masks[last]
        total[: len(sums)] += sums * (inside * np.float32(weight))
    return np.bincount(owner, weights=total, minlength=len(strings)) / _norm(owner, again, len(strings))


def values_by_text(texts: list[list[str]], table: np.ndarray) -> list[np.ndarray]:
    """The values of each text's sentences."""
    flat = [s for t in texts for s in t]
    values, chunk, chars = [np.zeros(0)], [], 0
    for s in flat:
        chunk.append(s)
        chars += len(s)
        if chars >= BATCH_CHARS:
            values.append(sentence_values(chunk, table))
            chunk, chars = [], 0
    if chunk:
        values.append(sentence_values(chunk, table))
    ends = np.cumsum([len(t) for t in texts])
    return np.split(np.concatenate(values), ends[:-1]) if texts else []


def summary(values: list[np.ndarray], edge: float) -> np.ndarray:
    """Per text: the value of the worst sentence, and the logarithm of how much of it is above an edge."""
    worst = [v.max() if len(v) else 0.0 for v in values]
    above = [np.log1p(np.maximum(0, v - edge).sum()) for v in values]
    return np.stack([worst, above], axis=1) if values else np.zeros((0, 2))


# --- training -------------------------------------------------------------------------------


def _landmarks(texts: list[list[str]], toxic: np.ndarray, wanted: int) -> tuple[list[str], list[str]]:
    """Words and beginnings of words that tell the classes apart (by the root of their chi-square); frequent clean ones.

    They start with a space, as words do in sentences.
    """
    counts = {1: Counter(), 0: Counter()}
    for text, label in zip(texts, toxic, strict=True):
        words = {w.strip(".,;:()") for s in text for w in s.split()}
        counts[label].update({w[:n] for w in words if len(w) >= LENGTH for n in (*BEGINNINGS, len(w))})
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))

    def gain(word: str) -> float:
        a, b = counts[1][word] / n1, counts[0][word] / n0
        return (a - b) / np.sqrt((a + b) / 2 * (1 - (a + b) / 2) * (1 / n1 + 1 / n0) + 1e-9)

    words = [w for w in {*counts[1], *counts[0]} if LENGTH <= len(w) <= 32 and counts[1][w] + counts[0][w] > 1]
    ranked = sorted(((gain(w), w) for w in words), key=lambda g: (-g[0], g[1]))
    clean = wanted // 4  # so that the machine also sees what ordinary text is made of
    most = sorted(words, key=lambda w: (-counts[0][w], w))[:clean]
    telling = [w for g, w in ranked[: wanted - clean] if g >= MIN_GAIN] or [w for _, w in ranked[:8]]
    return [f" {w}" for w in telling], [f" {w}" for w in most if w not in telling]


def _hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, start: np.ndarray, steps: int = 400) -> np.ndarray:
    """A linear machine by full gradient steps on the squared hinge loss; the last column is constant."""
    w = start.copy()
    free = np.ones(x.shape[1])
    free[-1] = 0
    lipschitz = 2 * np.linalg.norm(x * np.sqrt(cost)[:, None], 2) ** 2 + RIDGE
    v, t = w.copy(), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        gradient = -2 * x.T @ (cost * y * slack) + RIDGE * free * v
        new = v - gradient / lipschitz
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of the curve, by damped Newton steps with a small prior."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z, w = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(h, z.T @ (p - y) + 0.05 * w), -2, 2)
    return w[:-1] / scale, float(w[-1])


def train(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> Model | None:
    """A model from labelled documents; None unless both classes occur in texts with sentences."""
    cut = [sentences(t) for t in texts]
    kept = [i for i, c in enumerate(cut) if c]
    cut, toxic = [cut[i] for i in kept], np.array([labels[i] for i in kept], int)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    telling, plain = _landmarks(cut, toxic, landmarks)
    words = [*telling, *plain]
    if not words:
        return None
    bags = features(words)
    at = np.array(sorted({k for b in bags for k in b}), np.int64)
    place = {k: i for i, k in enumerate(at.tolist())}
    phi = np.zeros((len(words), len(at)))
    for i, b in enumerate(bags):
        phi[i, [place[k] for k in b]] = list(b.values())
    phi /= np.maximum(np.linalg.norm(phi, axis=1, keepdims=True), 1e-12)
    values, vectors = np.linalg.eigh(phi @ phi.T)
    good = values > LEAST_EIGENVALUE * values.max()
    project = (vectors[:, good] / np.sqrt(values[good])).T @ phi  # Nystroem: sentence features to coordinates

    compact = np.full(TABLE, -1, np.int32)
    compact[at] = np.arange(len(at))

    def coordinates(strings: list[str]) -> np.ndarray:
        out = np.zeros((len(strings), project.shape[0] + 1))
        for i in range(0, len(strings), 512):
            part = strings[i : i + 512]
            chars, owner, again = _codes(part)
            sums = np.zeros((len(part), len(at)), np.float32)
            for code, inside, weight in _places(chars, owner, again):
                to = compact[code]
                hit = np.flatnonzero(inside & (to >= 0))
                np.add.at(sums, (owner[hit], to[hit]), np.float32(weight))
            out[i : i + 512, :-1] = (sums @ project.T) / _norm(owner, again, len(part))[:, None]
        out[:, -1] = 1.0
        return out

    def table(w: np.ndarray) -> np.ndarray:
        found = np.zeros(TABLE, np.float32)
        found[at] = w[:-1] @ project
        return found

    # The first choice of sentences: by the landmarks that speak for toxicity.
    start = np.zeros(TABLE, np.float32)
    start[at] = phi[: len(telling)].sum(axis=0)
    w, now = np.zeros(project.shape[0] + 1), start
    held: dict[str, None] = {}
    for round_ in range(rounds):
        own = values_by_text(cut, now)
        best = [(float(v.max()), c[int(v.argmax())]) for c, v, t in zip(cut, own, toxic, strict=True) if t]
        if round_ > 1:
            # Labels err: what still looks clean among the toxic is left out, at most DOUBTFUL of them.
            least = min(np.quantile([b for b, _ in best], DOUBTFUL), -w[-1] - 0.5)
            best = [b for b in best if b[0] >= least]
        positive = [text for _, text in best]
        if round_ > 0:  # further sentences on the toxic side, so that one insult among many words counts too
            for c, v, t in zip(cut, own, toxic, strict=True):
                if t:
                    positive += [c[j] for j in np.argsort(-v, kind="stable")[1:4] if v[j] > -w[-1]]
        for c, v, t in zip(cut, own, toxic, strict=True):
            if not t:
                held.update(dict.fromkeys(c[j] for j in np.argsort(-v, kind="stable")[:2]))
        negative = list(held)
        x = coordinates(positive + negative)
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        cost = np.where(y > 0, 0.5 / max(1, len(positive)), 0.5 / max(1, len(negative))) * 200
        w = _hinge(x, y, cost, w)
        now = table(w)
    edge = -float(w[-1]) - 0.5
    found = summary(values_by_text(cut, now), edge)
    slopes, offset = _logistic(found, toxic.astype(float))
    if slopes.min() < 0:  # neither may speak against toxicity
        found[:, slopes.argmin()] = 0
        slopes, offset = _logistic(found, toxic.astype(float))
    return Model(at, now[at], edge, slopes, offset)


# --- operators ------------------------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> Model | None:
    """A model from at most `max_documents` labelled documents of each class that are not held out."""
    usable = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("doc_id", F.lit(11))
    ids = usable.where("toxic = 1").orderBy(order, "doc_id").limit(max_documents)
    ids = ids.union(usable.where("toxic = 0").orderBy(order, "doc_id").limit(max_documents))
    known = ids.select(F.col("doc_id").alias("_labelled"), "toxic")
    rows = (
        documents.select("doc_id", text_of().alias("text"))
        .join(F.broadcast(known), F.col("doc_id") == F.col("_labelled"))
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
        .orderBy("doc_id")
        .collect()  # at most 2 * max_documents rows
    )
    return train([r.text for r in rows], [r.toxic for r in rows])


def scored(text: Column, model: Model | None) -> Column:
    """The score of a text column."""

    @arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = None if model is None else model.table()
        for texts in batches:
            found = np.zeros(len(texts))
            if model is not None:
                cut, chars, first = [], 0, 0
                for i, text in enumerate(texts):
                    cut.append(sentences(text.as_py()))
                    chars += sum(map(len, cut[-1]))
                    if chars >= BATCH_CHARS or i + 1 == len(texts):
                        found[first : i + 1] = model.score(values_by_text(cut, table))
                        cut, chars, first = [], 0, i + 1
            yield pa.array(found, pa.float64())

    return run(text)


def score(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    importable(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), scored(text_of(), model).alias("score"))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return rows.select("doc_id", held_out().alias("held_out"), "score", predicted)


def clean(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, with the columns they had."""
    importable(documents.sparkSession)
    return documents.where(scored(text_of(), model) < threshold)
