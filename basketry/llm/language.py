"""Language of whole texts by prediction by partial matching (PPM).

Every language has a context tree over bytes: for each context of up to ``ORDER`` bytes, how often each
byte followed it. A byte is coded in the longest context the tree knows; if it never followed there,
an escape leads to the context that is one byte shorter, where the bytes of the longer one are left out
(method C with exclusion), and past the empty context all bytes not yet seen are equally likely. So
the lengths of the 256 possible bytes of a place always make up a whole code. The statistics are
frozen: a text's code length under a language is a sum over its places, in whole units of 2**-20 bits,
and the language with the shortest code is predicted.

Texts are read in lower case with every digit as 0. Words are coded with the white space around them
and contexts end at the white space before a word, so each distinct word is coded once a task.

The trees count all training rows. A byte after a context is kept if it makes up at least
``languages / NODES`` of its language's bytes; that bounds the trees to ``NODES`` entries an order, whatever
the number of rows and languages, and drops nothing from tables of fewer bytes than that.

Defined results: NULL texts and texts without a letter are ``und`` with score 0, and so are all texts if no
language was learned; equal code lengths go to the first language by name; NULL languages do not train;
repeated rows count and are scored one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import cut

ORDER = 4  # bytes of context at most; a context and its byte must fit into 56 bits
NODES = 2**18  # entries of one order over all languages at most
UNIT = 2.0**20  # code lengths are whole numbers of 1 / UNIT bits
UNDETERMINED = "und"
HELD_WORDS, HELD_BYTES = 200_000, 32 << 20  # distinct words, and bytes of text, a task holds before it starts afresh
AT_ONCE = 1 << 20  # bytes of text coded together

DIGITS = bytes(48 if 48 <= b <= 57 else b for b in range(256))
LETTERISH = re.compile(r"[^\W\d_]")


def held_out(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in LETTERISH.finditer(text or ""))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(DIGITS).split()


def places(words: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context length, context and byte, word) of every coded place: each byte of a word and the blank after it.

    A context reaches back to the blank before the word at most. The second array holds the byte in
    its lowest eight bits and the context above it.
    """
    if not words:
        return (np.zeros(0, np.int64),) * 3
    raw = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    length = np.minimum(at, order)
    gram = raw.copy()
    for k in range(1, order + 1):
        gram[k:] += np.where(length[k:] >= k, raw[:-k] << (8 * k), 0)
    coded = at > 0
    return length[coded], gram[coded], word[coded]


def _find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of every wanted value in the sorted table, -1 if it is missing."""
    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


@dataclass
class Level:
    """All contexts of one length: the bytes after them, and each context's sums."""

    grams: np.ndarray  # sorted (context, byte)
    counts: np.ndarray
    contexts: np.ndarray = field(init=False)  # sorted
    total: np.ndarray = field(init=False)  # how often a context was followed by a kept byte
    kinds: np.ndarray = field(init=False)  # distinct kept bytes after it
    left_out: np.ndarray = field(init=False)  # how often these bytes follow the context one byte shorter

    def __post_init__(self):
        self.contexts, first, self.kinds = np.unique(self.grams >> 8, return_index=True, return_counts=True)
        self.total = np.add.reduceat(self.counts, first) if len(first) else np.zeros(0, np.int64)
        self.left_out = np.zeros(len(first), np.int64)

    def link(self, shorter: Level, length: int) -> Level:
        below = shorter.counts[_find(shorter.grams, self.grams & ((1 << (8 * length)) - 1))]
        if len(below):
            self.left_out = np.add.reduceat(below, np.searchsorted(self.grams >> 8, self.contexts))
        return self


def tree(grams: list[np.ndarray], counts: list[np.ndarray]) -> list[Level]:
    """The levels of one language from its (context, byte) counts by context length."""
    levels: list[Level] = []
    for length, (gram, count) in enumerate(zip(grams, counts, strict=True)):
        by = np.argsort(gram)
        level = Level(gram[by], count[by])
        levels.append(level.link(levels[-1], length) if levels else level)
    return levels


def code_lengths(levels: list[Level], length: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Bits of every place, in whole units, under one language."""
    bits = np.zeros(len(gram))
    open_ = np.ones(len(gram), bool)
    less_total, less_kinds = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        rows = np.flatnonzero(open_ & (length >= k))
        here = gram[rows] & ((1 << (8 * (k + 1))) - 1)
        context = _find(level.contexts, here >> 8)
        rows, here, context = rows[context >= 0], here[context >= 0], context[context >= 0]
        total = level.total[context] - less_total[rows]
        kinds = level.kinds[context] - less_kinds[rows]
        at = _find(level.grams, here)
        seen = at >= 0
        bits[rows[seen]] += np.log2((total[seen] + kinds[seen]) / level.counts[at[seen]])
        open_[rows[seen]] = False
        new = ~seen & (kinds > 0)  # a context without a byte of its own costs nothing to leave
        bits[rows[new]] += np.log2((total[new] + kinds[new]) / kinds[new])
        less_total[rows[~seen]], less_kinds[rows[~seen]] = level.left_out[context[~seen]], level.kinds[context[~seen]]
    if open_.any():
        bits[open_] += np.log2(256 - (levels[0].kinds[0] if len(levels[0].kinds) else 0))
    return np.rint(bits * UNIT).astype(np.int64)


@dataclass
class Model:
    """The learned languages in the order of their names, and their context trees."""

    languages: list[str]
    trees: list[list[Level]]


class Coder:
    """Code lengths of texts under all languages; every distinct word is coded once."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self):
        self.known: dict[bytes, int] = {}
        self.lengths = np.zeros((0, len(self.model.languages)), np.int64)
        self.bytes = 0

    def _learn(self, words: list[bytes]):
        length, gram, word = places(words)
        both, back = np.unique(gram | (length << 56), return_inverse=True)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else word
        size, only = both >> 56, both & ((1 << 56) - 1)
        made = [np.add.reduceat(code_lengths(t, size, only)[back], first) for t in self.model.trees]
        self.known.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words)), strict=True))
        self.lengths = np.concatenate([self.lengths, np.stack(made, 1)])
        self.bytes += sum(map(len, words))

    def code(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per language."""
        split = [words_of(t) for t in texts]
        if len(self.known) > HELD_WORDS or self.bytes > HELD_BYTES:
            self._forget()
        new = set().union(*split) - self.known.keys()
        if new:
            self._learn(sorted(new))
        out = np.zeros((len(texts), len(self.model.languages)), np.int64)
        for i, words in enumerate(split):
            if words:
                out[i] = self.lengths[list(map(self.known.__getitem__, words))].sum(0)
        return out


def _counted(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """How often each place (context length in the top byte) occurs."""
    length, gram, word = places(list(words))
    times = np.fromiter(words.values(), np.int64, len(words))[word]
    both, back = np.unique(gram | (length << 56), return_inverse=True)
    return both, np.bincount(back, times, len(both)).astype(np.int64)


def count_places(rows: DataFrame) -> DataFrame:
    """(lang, length, gram, n) over all rows of (lang, text): every context length of every place."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, words in seen.items():
                both, n = _counted(words)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(both), pa.string()), pa.array(both), pa.array(n)], ["lang", "place", "n"])
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                words = words_of(text.as_py())
                seen.setdefault(lang, Counter()).update(words)
                held += len(words)
                if held > HELD_WORDS and sum(map(len, seen.values())) > HELD_WORDS or held > HELD_BYTES:
                    yield from flush()
                    held = 0
        yield from flush()

    longest = rows.select(F.col("lang").cast("string"), "text").mapInArrow(compute, "lang string, place long, n long")
    longest = longest.groupBy("lang", "place").agg(F.sum("n").alias("n"))
    # Of every place only the longest context travels; the shorter ones are its ends.
    length, gram = F.shiftright("place", 56), F.col("place").bitwiseAND((1 << 56) - 1)
    ends = F.transform(
        F.sequence(F.lit(0), length.cast("int")),
        lambda k: F.struct(k.alias("length"), gram.bitwiseAND(_low(k)).alias("gram")),
    )
    every = longest.select("lang", "n", F.explode(ends).alias("e"))
    return every.groupBy("lang", "e.length", "e.gram").agg(F.sum("n").alias("n"))


def _low(k: Column) -> Column:
    """The lowest k + 1 bytes."""
    masks = F.array(*[F.lit((1 << (8 * (i + 1))) - 1).cast("long") for i in range(ORDER + 1)])
    return F.get(masks, k)


def fit(docs: DataFrame, nodes: int = NODES) -> Model:
    """Context trees of all languages from (doc_id, lang, text); held-out ids (crc32 mod 4 = 2) do not train."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out("doc_id"), F.lit(False)))
    counts = cut(count_places(rows))
    sizes = counts.filter("length = 0").groupBy("lang").agg(F.sum("n").alias("bytes"))
    # At most ``nodes`` languages have an entry that is kept, and an order at most ``nodes`` entries.
    every = sizes.agg(F.count("*").alias("languages")).first()["languages"]
    kept = counts.join(sizes, "lang").filter(F.col("n") * nodes >= F.col("bytes") * every)
    table = kept.select("lang", "length", "gram", "n").toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    length, gram, n = (table[c].to_numpy() for c in ("length", "gram", "n"))
    languages = sorted(set(names.tolist()))
    trees = []
    for lang in languages:
        of = [np.flatnonzero((names == lang) & (length == k)) for k in range(ORDER + 1)]
        trees.append(tree([gram[i].astype(np.int64) for i in of], [n[i].astype(np.int64) for i in of]))
    return Model(languages, trees)


def predict(docs: DataFrame, model: Model, carried: list[str] | None = None) -> DataFrame:
    """(doc_id[, carried...], lang_pred, score): score is the predicted language's share of the likelihood."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most NODES entries an order
    rows = docs.select("doc_id", *(carried or []), F.col("text").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def judge(coder: Coder, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        known = [has_letter(t) and bool(coder.model.languages) for t in texts]
        coded = iter(coder.code([t for t, k in zip(texts, known, strict=True) if k]) if any(known) else ())
        for k in known:
            if not k:
                yield UNDETERMINED, 0.0
                continue
            bits = next(coded)
            best = int(bits.argmin())
            yield coder.model.languages[best], float(1 / np.exp2(np.maximum((bits[best] - bits) / UNIT, -1000.0)).sum())

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(held.value)
        for batch in batches:
            found, texts, size = [], [], 0
            for value in batch["_text"]:
                texts.append(value.as_py())
                size += len(texts[-1] or "")
                if size > AT_ONCE:
                    found += judge(coder, texts)
                    texts, size = [], 0
            found += judge(coder, texts)
            kept = batch.drop_columns(["_text"])
            made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], [*kept.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(compute, f"{fields}, lang_pred string, score double")
