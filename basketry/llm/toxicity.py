"""Toxicity of whole texts after noisy-channel deobfuscation.

A disguised word is seen as a clean word sent through a channel that swaps letters for look-alikes,
repeats letters, and puts separators between them. Its lattice holds, for every written character,
the letters it may stand for and what that costs; Viterbi search finds the path that a character
trigram model of the whole corpus and the channel together find likeliest. Words without any sign of
disguise are their own only path; one with doubled letters counts as written and as restored. Tokens of
any length are searched, long ones in overlapping parts. Letters that the character model does not know
stand for themselves. Each distinct token is decoded once per worker; words of letters alone that start like no
feature of the model are neither decoded nor remembered when texts are scored.

The score is a logistic model over the restored words and their beginnings, so that inflected forms
share what is learned; a feature that by itself all but settles the label counts as much as it did there. Words and beginnings are chosen by their association with the labels, and all
steps use about ``SAMPLE`` labelled documents, chosen by hash of the id; the character model
counts every document. Ids, languages, sources and labels are no inputs of a score.

Defined results: NULL and empty texts get the score of a text without known words; documents without
label are scored like others; repeated labels of a document count as toxic if one is; NULL ids and
labels do not train; if the labels hold one class only, every score is its smoothed share; repeated
rows are scored one by one; an empty table gives no rows; other columns are ignored or carried along.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.held import held

SAMPLE = 20_000  # labelled documents that train; a parameter of ``fit``
FEATURES = 3_000  # words and beginnings the model looks at
LEAST_DOCS = 3  # documents a feature must occur in
CHI_SQUARE = 15.0  # association it must have with the labels
LIFT = 3.0  # how much likelier it must make the label; common words only tell long texts from short ones
BEGINNINGS = (3, 4, 5, 6)
PRIOR = 5.0  # documents of the average sort that every feature is given
SURE = 0.95  # smoothed share from which a feature settles the label by itself
PENALTY = 1.0  # documents' worth of evidence that a weight must outweigh
CACHED = 200_000  # tokens a worker remembers; beyond it, it starts afresh

# Letters of the character model; everything else is a word boundary, number 0.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
SIZE = len(LETTERS) + 1
_BYTES = np.array([CODE.get(bytes([b]).decode("latin-1"), 0) for b in range(256)], np.int64)

# What a written sign may stand for (fixed values of the channel).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c", "(": "c", "<": "c",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ο": "o", "α": "a",
}
VOWELS = "aeiou"
SWAP, DROP, HIDDEN, REPEAT = 0.5, 7.0, 1.0, 0.7  # costs in nats
# What a separator costs that means nothing, and one that parts words: in spelled-out runs, elsewhere.
JOIN, PART = (0.2, 2.0), (5.0, 0.5)
EDGES = ".,;:?\"'()[]{}…«»“”‘’ "
JUNK = re.compile(r"([^\w\s])\1{2,}$")
DOUBLE = re.compile(r"(.)\1")
TRIPLE = re.compile(r"(.)\1\1")
REPEATED = re.compile(r"(.)\1{3,}")
PLAIN = re.compile(f"[{LETTERS}]+")
LONG = 40  # characters from which a token may also be an address or a key, so its plain words count as well
PIECE, LAP = 400, 60  # characters of a token that are searched at a time, and how many of them again with the next
INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
# A letter without neighbours (what follows an apostrophe belongs to the word before it), or a sign that may
# stand for one. Runs of these have anything but letters and digits between them and around them.
UNIT = r"(?:(?<![^\W_])(?<![^\W_]{2}['’])[^\W_](?![^\W_])|(?<![^\W_])(?<![@$!|+])[@$!|+](?![^\W_]|[@$!|+]))"
BETWEEN = rf"(?:(?!{UNIT})[\W_])"
SINGLE = re.compile(UNIT)
SPELLED = re.compile(rf"{UNIT}(?:{BETWEEN}++{UNIT})+")
SPACED = re.compile(rf"{UNIT}(?:{BETWEEN}++{UNIT}){{2,}}+")
RUN, SHARED = 256, 32  # letters of a run that are read at a time, and how many of them again with the next


def trigram_counts(texts) -> np.ndarray:
    """How often each three codes follow one another in the lower-cased texts."""
    total = np.zeros(SIZE**3, np.int64)
    for text in texts:
        raw = f" {text.lower()} ".encode("latin-1", "replace")
        codes = _BYTES[np.frombuffer(raw, np.uint8)]
        total += np.bincount((codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:], minlength=SIZE**3)
    return total


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """The same over all documents; tasks add up, at most SIZE**3 numbers reach the driver."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            joined, length = [], 0
            for raw in batch[0]:
                if raw.is_valid:
                    joined.append(raw.as_py())
                    length += len(joined[-1])
                if length > 1 << 20:
                    total += trigram_counts(["  ".join(joined)])
                    joined, length = [], 0
            if joined:
                total += trigram_counts(["  ".join(joined)])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    counts = docs.select("text").mapInArrow(compute, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = np.zeros(SIZE**3, np.int64)
    for r in counts.collect():
        total[r["gram"]] = r["n"]
    return total


def log_model(counts: np.ndarray) -> list[float]:
    """log P(c | a, b), each order smoothed by the one below it."""
    three = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(2, keepdims=True) + 5)
    return np.log(p3).ravel().tolist()


def _outside(c: str) -> bool:
    """Letters, and marks on letters, that the character model does not know and that look like none of its own."""
    return c not in CODE and c not in LOOKALIKES and (c.isalpha() or unicodedata.category(c)[0] == "M")


def _choices(text: str) -> list[tuple[list[tuple[str, float]], int]]:
    """For every position: (what may have been meant, its cost) and how many characters that covers."""
    spelled = SPELLED.fullmatch(text) is not None
    join, part = (costs[0 if spelled else 1] for costs in (JOIN, PART))
    letters = {m.start() for m in SINGLE.finditer(text)} if spelled else set()
    foreign = not any(c in CODE for c in text) and any(_outside(c) for c in text)  # its letters stand for themselves
    out, i = [], 0
    while i < len(text):
        c, n = text[i], 1
        if spelled and i not in letters:
            while i + n not in letters:
                n += 1
            out.append(([("", join), (" ", part)], n))
        elif c in CODE:
            while i + n < len(text) and text[i + n] == c:
                n += 1
            if n == 1:
                out.append(([(c, 0.0)], 1))
            else:
                cost = REPEAT if n > 2 else 2 * REPEAT
                out.append(([(c, cost), (c * 2, REPEAT if n > 2 else 0.0)] + ([(c * n, REPEAT)] if n > 2 else []), n))
        elif _outside(c) or foreign and c.isalpha():
            out.append(([(c, 0.0)], 1))
        elif c in LOOKALIKES:
            out.append(([(x, SWAP) for x in LOOKALIKES[c]] + [("", DROP), (" ", DROP)], 1))
        elif c in "*#%&":
            out.append(([(x, HIDDEN) for x in VOWELS] + [("", DROP), (" ", DROP)], 1))
        else:
            out.append(([("", join if c in " ._-*" else DROP), (" ", part)], 1))
        i += n
    return out


def viterbi(text: str, logp: list[float]) -> str:
    """The likeliest words behind the lower-cased text, separated by blanks."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options, _ in [*_choices(text), ([(" ", 0.0)], 1)]:
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, made) in states.items():
            for meant, cost in options:
                x, y, total = a, b, score - cost
                for c in meant:
                    z = CODE.get(c, 0)
                    if z or y:  # one boundary is enough
                        total += logp[(x * SIZE + y) * SIZE + z]
                        x, y = y, z
                known = following.get((x, y))
                if known is None or total > known[0]:
                    following[x, y] = (total, made + meant)
        states = following
    return " ".join(max(states.values())[1].split())


def spelled_runs(low: str) -> Iterator[str]:
    """Spelled-out words of a lower-cased text. A sign at an end may also be punctuation."""
    for run in SPACED.finditer(low):
        units = [m.start() + run.start() for m in SINGLE.finditer(run[0])]
        for first in range(0, max(1, len(units) - SHARED), RUN - SHARED):
            part = units[first : first + RUN]
            yield low[part[0] : part[-1] + 1]
        inner = units[low[units[0]] in "!|+" : len(units) - (low[units[-1]] in "!|+")]
        if 1 < len(inner) < len(units) <= RUN:
            yield low[inner[0] : inner[-1] + 1]


def _simple(word: str) -> bool:
    if not word.isalpha() or TRIPLE.search(word):
        return False
    known = [c in CODE for c in word]
    return all(known) or not any(known)  # mixed scripts may be a disguise


class Restorer(dict):
    """token -> the words it stands for; each distinct token is decoded once."""

    def __init__(self, logp: list[float]):
        super().__init__()
        self.logp = logp

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) > CACHED:
            self.clear()
        self[token] = words = self._decode(token)
        return words

    def _searched(self, word: str) -> Iterator[str]:
        for first in range(0, max(1, len(word) - LAP), PIECE - LAP):
            yield from viterbi(word[first : first + PIECE], self.logp).split()

    def _plain(self, word: str) -> tuple[str, ...]:
        """A simple word and, if it has doubled letters, what the search makes of it."""
        if not DOUBLE.search(word) or not all(c in CODE for c in word):
            return (word,)
        return tuple(dict.fromkeys([word, *self._searched(word)]))

    def _decode(self, token: str) -> tuple[str, ...]:
        word = JUNK.sub("", INVISIBLE.sub("", token).strip(EDGES)).strip(EDGES)
        if _simple(word):
            return self._plain(word)
        word = unicodedata.normalize("NFKC", word).lower()
        if _simple(word):
            return self._plain(word)
        if len(word) > LONG:
            word = REPEATED.sub(r"\1\1\1", word)
        parts = [w for w in re.split(r"[\W\d_]+", word) if w]
        if not any(c.isalpha() for c in word):
            return tuple(parts)
        mixed = word.isalpha() and not TRIPLE.search(word)  # Latin letters among others, a word as it stands
        return tuple(dict.fromkeys([*(parts if mixed or len(word) > LONG else []), *self._searched(word)]))

    def words(self, text: str) -> set[str]:
        """All restored words of a text; letters that stand alone in a row are read together."""
        low = text.lower()
        found = set()
        for token in set(low.split()):
            found.update(self[token])
        for run in spelled_runs(low):
            found.update(viterbi(run, self.logp).split())
        return found


def features_of(words: set[str]) -> set[str]:
    """Restored words and, marked by a hyphen, their beginnings."""
    found = set(words)
    for word in words:
        for n in BEGINNINGS:
            if len(word) > n:
                found.add(word[:n] + "-")
    return found


@dataclass
class Model:
    """The character model, and the weights of the chosen words and beginnings."""

    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(SIZE**3, np.int64))
    weights: dict[str, float] = field(default_factory=dict)
    alone: dict[str, float] = field(default_factory=dict)  # smoothed share of toxic documents with a sure feature
    bias: float = 0.0


class Heads(dict):
    """The first three letters of a word -> whether any of the named features may lie in such a word.

    The search only shortens runs of a letter. Without a doubled letter among the first three these stay, and
    every feature of a word, the word and its beginnings, starts with them.
    """

    def __init__(self, names):
        super().__init__()
        self.starts = {f[:3] for f in names}

    def __missing__(self, head: str) -> bool:
        self[head] = may = head in self.starts or DOUBLE.search(head) is not None
        return may


class Finder:
    """Finds named features in texts; remembers for every token that may hold some which they are."""

    def __init__(self, counts: np.ndarray, names):
        self.restorer, self.names, self.heads = Restorer(log_model(counts)), names, Heads(names)
        self.known: dict[str, tuple[str, ...]] = {}

    def _of_words(self, words) -> tuple[str, ...]:
        return tuple(f for f in features_of(set(words)) if f in self.names)

    def found(self, text: str | None) -> set[str]:
        low, known, heads, found = (text or "").lower(), self.known, self.heads, set()
        for token in set(low.split()):
            word = token.strip(EDGES)
            if not heads[word[:3]] and len(word) <= PIECE and word.isalpha() and (word.isascii() or PLAIN.fullmatch(word)):
                continue  # one word, however it is read, that starts like none of the features
            hits = known.get(token)
            if hits is None:
                if len(known) > CACHED:
                    known.clear()
                known[token] = hits = self._of_words(self.restorer._decode(token))
            if hits:
                found.update(hits)
        for run in spelled_runs(low):
            found.update(self._of_words(viterbi(run, self.restorer.logp).split()))
        return found


class Scorer(Finder):
    """Scores texts by the weights of a model."""

    def __init__(self, model: Model):
        super().__init__(model.counts, model.weights)
        self.model = model

    def score(self, text: str | None) -> float:
        found = self.found(text)
        margin = self.model.bias + math.fsum(self.model.weights[f] for f in found)
        together = 1 / (1 + math.exp(-max(-50.0, min(50.0, margin))))
        return max(together, max((self.model.alone.get(f, 0.0) for f in found), default=0.0))


def _scorer(model: Model) -> Scorer:
    return held(("toxicity", model.name), lambda: Scorer(model))


def logistic(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, size: int, penalty: float = PENALTY, rounds: int = 1500):
    """(weights, bias) of a logistic model on sparse 0/1 features whose weights are not negative.

    The absolute penalty leaves weight only on features that explain several documents which nothing
    else explains. Accelerated proximal steps with restarts.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    w = np.zeros(size + 1)
    w[size] = math.log(share / (1 - share))

    def margins(v):
        return np.bincount(rows, v[columns], len(labels)) + v[size]

    def back(r):
        return np.append(np.bincount(columns, r[rows], size), r.sum())

    largest = np.ones(size + 1)
    for _ in range(20):
        largest = back(margins(largest / np.linalg.norm(largest)))
    step = 4 / max(float(np.linalg.norm(largest)), 1.0)
    ahead, pace = w.copy(), 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(margins(ahead), -50, 50))) - labels
        after = ahead - step * back(error)
        after[:size] = np.maximum(after[:size] - step * penalty, 0)
        if (ahead - after) @ (after - w) > 0:
            pace = 1.0  # momentum points the wrong way
        following = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = after + (pace - 1) / following * (after - w)
        w, pace = after, following
    return w[:size], float(w[size])


def held_out(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from (doc_id, text) and (doc_id, toxic); held-out ids (crc32 mod 5 = 0) do not train."""
    spark = docs.sparkSession
    model = Model(counts=count_trigrams(docs))
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    size = one.count()
    chosen = one.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < float(2**31) * min(1.0, sample / max(1, size)))
    # About ``sample`` rows of two numbers: bounded, whatever the number of labels.
    train = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("_toxic", "text")
    shared = spark.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _scorer(shared.value).restorer
        seen: list[Counter] = [Counter(), Counter()]

        def flush() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            arrays = [pa.array(names, pa.string()), *(pa.array([s[f] for f in names], pa.int64()) for s in seen)]
            seen[0].clear(), seen[1].clear()
            return pa.RecordBatch.from_arrays(arrays, ["feature", "clean", "toxic"])

        for batch in batches:
            for toxic, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                seen[1 if toxic else 0].update(features_of(restorer.words(text.as_py() or "")))
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield flush()
        yield flush()

    sums = train.agg(F.count("*").alias("n"), F.sum("_toxic").alias("t")).first()
    n, t = sums["n"], sums["t"] or 0
    if not 0 < t < n:
        share = (t + 0.5) / (n + 1) if n else 0.5
        model.bias = math.log(share / (1 - share))
        return model
    counts = train.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(f"clean + toxic >= {LEAST_DOCS}")
    a, b = F.col("toxic"), F.col("clean")
    determinant = a * (n - t - b) - b * (t - a)
    chi = F.lit(float(n)) * determinant.cast("double") ** 2 / (F.lit(float(t) * (n - t)) * (a + b) * (n - a - b + 1e-9))
    lifted = a * n > (a + b) * t * F.lit(LIFT)
    best = counts.filter(lifted).withColumn("chi", chi).filter(F.col("chi") > CHI_SQUARE).orderBy(F.desc("chi"), "feature").limit(FEATURES)
    rows = best.select("feature", "clean", "toxic").collect()  # at most FEATURES rows
    names = [r["feature"] for r in rows]
    shares = [(r["toxic"] + PRIOR * t / n) / (r["toxic"] + r["clean"] + PRIOR) for r in rows]
    index = {f: i for i, f in enumerate(names)}
    known = spark.sparkContext.broadcast(index)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = held(("toxicity features", shared.value.name), lambda: Finder(shared.value.counts, known.value))
        for batch in batches:
            rows = [sorted(known.value[f] for f in finder.found(text.as_py())) for text in batch[1]]
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(rows, pa.list_(pa.int32()))], ["toxic", "features"])

    rows = train.mapInArrow(encode, "toxic int, features array<int>").collect()  # the bounded sample
    columns = np.array([f for r in rows for f in r["features"]], np.int64)
    at = np.repeat(np.arange(len(rows)), [len(r["features"]) for r in rows])
    labels_of = np.array([1.0 if r["toxic"] else 0.0 for r in rows])
    weights, model.bias = logistic(at, columns, labels_of, len(names))
    explains = [(f, w, share) for f, w, share in zip(names, weights.tolist(), shares, strict=True) if w > 0]
    model.weights = {f: w for f, w, _ in explains}
    model.alone = {f: share for f, _, share in explains if share >= SURE}
    model.name = uuid.uuid4().hex
    return model


def score(docs: DataFrame, model: Model, carried: list[str] | None = None) -> DataFrame:
    """(doc_id[, carried...], score): the toxicity of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE**3 counts and at most FEATURES weights
    rows = docs.select("doc_id", *(carried or []), F.col("text").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        for batch in batches:
            scores = pa.array([scorer.score(t.as_py()) for t in batch["_text"]], pa.float64())
            kept = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, scores], [*kept.schema.names, "score"])

    return rows.mapInArrow(compute, f"{fields}, score double")
