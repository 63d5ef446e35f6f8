"""Benchmark decontamination by winnowing.

Of every ``WINDOW - K + 1`` consecutive K-word grams the one with the smallest hash is kept as a
fingerprint, on both sides. A shared run of WINDOW words holds that many grams, so both sides keep
the same gram of it: no shared run of WINDOW words is missed. Fingerprints that meet are
extended word by word in both directions, and runs of at least WINDOW words are hits. An item of
fewer words is one window; its grams are looked up at every position of a document.

A benchmark of at most ``SMALL_CHARS`` characters is handed to every task. A larger one is joined:
fingerprints of documents with those of items, each document then verified against its candidates.

Defined results: NULL and empty texts have no words and no hits; a NULL item_id is written ``null``;
rows with the same item_id are one item with several texts; repeated documents are judged one by
one; an empty benchmark contaminates nothing, an empty table gives no rows; other columns are
ignored, unless they are named to be carried along.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.held import held
from basketry.session import cut

WINDOW = 13
K = 5
SMALL_CHARS = 8_000_000
HOT_SHARE, DEALT = 0.001, 32  # share of the grams from which one is dealt out, and over how many places

# A-Z become a-z; ASCII other than digits and letters separates words, other bytes belong to them.
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))
MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(K)], np.uint64)


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(TABLE).split()


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word grams of an array of word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += words[i : i + n] * MULTIPLIERS[i]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash (the last on a tie) of every ``window`` consecutive grams."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams[::-1], window).argmin(axis=1)
    picked = np.zeros(len(grams), bool)
    picked[np.arange(len(least)) + least] = True
    return np.flatnonzero(picked[::-1])


class WordHashes(dict):
    """Word -> XXH64; starts afresh when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], np.uint64)


class Vocabulary:
    """The same hashes for the words of some items only; any other word cannot be part of a hit."""

    def __init__(self, words: set[bytes]):
        self.index = {w: i + 1 for i, w in enumerate(words)}
        self.hashes = np.array([1, *map(xxhash.xxh64_intdigest, self.index)], np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        get = self.index.get
        return self.hashes[np.array([get(w, 0) for w in words], np.int64)]


class Items:
    """Benchmark texts with their fingerprints, ready to be found in documents."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.ids, self.words = [], []
        for item_id, raw in items:
            if words := words_of(raw):
                self.ids.append(item_id)
                self.words.append(words)
        self.vocabulary = Vocabulary({w for words in self.words for w in words})
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.short: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        heads: dict[int, set[int]] = defaultdict(set)
        for item, words in enumerate(self.words):
            hashes = self.vocabulary.of(words)
            if len(words) >= WINDOW:
                grams = gram_hashes(hashes, K)
                for at in winnow(grams, WINDOW - K + 1).tolist():
                    self.postings[int(grams[at])].append((item, at))
            else:
                self.short[len(words)][b" ".join(words)].add(self.ids[item])
                heads[len(words)].add(int(gram_hashes(hashes, min(K, len(words)))[0]))
        self.known = np.array(sorted(self.postings), np.uint64)
        self.heads = {n: np.array(sorted(h), np.uint64) for n, h in heads.items()}

    @staticmethod
    def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known) or not len(values):
            return np.zeros(len(values), bool)
        return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values

    def search(self, words: list[bytes]) -> tuple[int, set[str]]:
        """(words of the document that are hit, items that occur in it)."""
        hashes = self.vocabulary.of(words)
        grams = gram_hashes(hashes, K)
        hit, found = np.zeros(len(words), bool), set()
        at = winnow(grams, WINDOW - K + 1)
        reached: dict[tuple[int, int], int] = {}  # end of the last run by (item, shift)
        for place in at[self._among(grams[at], self.known)].tolist():
            for item, start in self.postings[int(grams[place])]:
                shift = place - start
                if reached.get((item, shift), -1) > place:
                    continue
                first, last = self._extend(words, self.words[item], place, start)
                reached[item, shift] = last
                if last - first >= WINDOW:
                    hit[first:last] = True
                    found.add(self.ids[item])
        for n, heads in self.heads.items():
            starts = grams if n >= K else gram_hashes(hashes, n)
            for place in np.flatnonzero(self._among(starts, heads)).tolist():
                if ids := self.short[n].get(b" ".join(words[place : place + n])):
                    hit[place : place + n] = True
                    found |= ids
        return int(hit.sum()), found

    @staticmethod
    def _extend(words: list[bytes], other: list[bytes], place: int, start: int) -> tuple[int, int]:
        """The run of equal words around a gram that both sides have at ``place`` and ``start``."""
        last, end = place, start
        while last < len(words) and end < len(other) and words[last] == other[end]:
            last, end = last + 1, end + 1
        while place > 0 and start > 0 and words[place - 1] == other[start - 1]:
            place, start = place - 1, start - 1
        return place, last


def _shared(broadcast) -> Items:
    """The items of a broadcast (name, texts), built once per worker."""
    name, texts = broadcast.value
    return held(("items", name), lambda: Items(texts))


FOUND = "n_words long, n_hit long, items array<string>, contaminated boolean"


def _judge(batch: pa.RecordBatch, texts, items_of) -> pa.RecordBatch:
    columns = [[], [], [], []]
    for row, raw in enumerate(texts):
        words = words_of(raw.as_py())
        hits, found = items_of(row).search(words) if words else (0, set())
        for column, value in zip(columns, (len(words), hits, sorted(found), hits > 0 and 20 * hits >= len(words)), strict=True):
            column.append(value)
    types = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_())
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    names = ["n_words", "n_hit", "items", "contaminated"]
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])


def _named(items: DataFrame) -> DataFrame:
    return items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), F.col("text").cast("binary").alias("text"))


def written_size(benchmark: DataFrame) -> int:
    """Characters of all items: every item counts, also one without a text, and its id with it."""
    written = F.coalesce(F.length("text"), F.lit(0)) + F.coalesce(F.length(F.col("item_id").cast("string")), F.lit(4)) + 16
    return benchmark.agg(F.sum(written.cast("long"))).first()[0] or 0


def judge(docs: DataFrame, benchmark: DataFrame, carried: list[str] | None = None, small_chars: int = SMALL_CHARS) -> DataFrame:
    """(doc_id[, carried...], n_words, n_hit, items, contaminated) of every document."""
    size = written_size(benchmark)
    rows = docs.select("doc_id", *(carried or []), F.col("text").cast("binary").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    if size <= small_chars:
        texts = [(r["id"], bytes(r["text"] or b"")) for r in _named(benchmark).collect()]
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, texts))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _shared(shared)
            for batch in batches:
                yield _judge(batch.drop_columns(["_text"]), batch["_text"], lambda _: items)

        return rows.mapInArrow(scan, f"{fields}, {FOUND}")
    return _judge_by_join(rows, _named(benchmark), fields)


def _judge_by_join(rows: DataFrame, items: DataFrame, fields: str) -> DataFrame:
    """The same for a benchmark of any size: candidates by a join on fingerprints."""
    rows = rows.withColumn("_key", F.xxhash64("doc_id", "_text"))
    lengths = sorted(
        r["n"] for r in items.mapInArrow(_short_lengths, "n int").distinct().collect()
    )  # at most WINDOW - 1 numbers

    def fingerprint(batches: Iterator[pa.RecordBatch], is_item: bool) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keys, grams_out = [], []
            for key, raw in zip(batch[0].to_pylist(), batch[1], strict=True):
                words = words_of(raw.as_py())
                values = hashes.of(words)
                grams = gram_hashes(values, K)
                found = set()
                if len(words) >= WINDOW:
                    found.update(grams[winnow(grams, WINDOW - K + 1)].view(np.int64).tolist())
                for n in lengths:
                    if not is_item or n == len(words):
                        part = grams if n >= K else gram_hashes(values, n)
                        found.update((part[:1] if is_item else part).view(np.int64).tolist())
                grams_out += found
                keys += [key] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(grams_out, pa.int64()), pa.array(keys, batch.schema.types[0])], ["gram", "key"])

    ours = rows.select("_key", "_text").mapInArrow(lambda b: fingerprint(b, False), "gram long, key long")
    theirs = items.withColumn("row", F.xxhash64("id", "text"))
    theirs_grams = theirs.select("row", "text").mapInArrow(lambda b: fingerprint(b, True), "gram long, key long")
    pairs = _shared_grams(cut(ours.withColumnRenamed("key", "_key")), theirs_grams.withColumnRenamed("key", "row")).distinct()
    candidates = (
        pairs.join(theirs.dropDuplicates(["row"]), "row")
        .groupBy("_key")
        .agg(F.collect_list(F.struct("id", "text")).alias("_candidates"))
    )
    nothing = Items([])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch["_candidates"]

            def items_of(row: int, near=near) -> Items:
                found = near[row].as_py()
                return Items([(c["id"], c["text"]) for c in found]) if found else nothing

            yield _judge(batch.drop_columns(["_text", "_key", "_candidates"]), batch["_text"], items_of)

    joined = rows.join(candidates, "_key", "left")
    order = [c for c in rows.columns if c not in ("_key", "_text")]
    return joined.select(*order, "_text", "_key", "_candidates").mapInArrow(verify, f"{fields}, {FOUND}")


def _shared_grams(ours: DataFrame, theirs: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """(_key, row) for every gram of (gram, _key) that is also one of (gram, row).

    Grams with more than ``hot_share`` of all rows, at most 1 / ``hot_share`` of them, are dealt out: the
    documents' rows over ``DEALT`` places, the items' rows to each of these.
    """
    total = ours.count()
    hot = F.broadcast(ours.groupBy("gram").count().filter(F.col("count") > total * hot_share).select("gram", F.lit(DEALT).alias("places")))
    spread = F.when(F.col("places").isNull(), 0).otherwise(F.pmod(F.xxhash64("_key"), F.lit(DEALT))).cast("int")
    left = ours.join(hot, "gram", "left").select("gram", spread.alias("place"), "_key")
    everywhere = F.sequence(F.lit(0), F.coalesce("places", F.lit(1)) - 1)
    right = theirs.join(hot, "gram", "left").select("gram", F.explode(everywhere).alias("place"), "row")
    return left.join(right, ["gram", "place"]).select("_key", "row")


def _short_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = {len(words_of(raw.as_py())) for raw in batch["text"]}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(n for n in counts if 0 < n < WINDOW), pa.int32())], ["n"])
