"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints link at two or fewer differing bits. A fingerprint is cut into three segments of 22, 21
and 21 bits. Two errors leave at least one segment without any, and of the three pairs (exact
segment, next segment) at least one has an exact first and at most one error in the second. The
second segment, padded to 23 bits, is decoded with the binary Golay code: every word lies within
three bits of exactly one codeword. Within two bits, a flipped bit leads to the same codeword; at
three bits it may not, so such a word also gets the indices of the five codewords at distance four.
Two words that differ in one bit then always share an index. A key is the pair's number, the exact
segment and an index; fingerprints that share a key are joined and verified.

Keys that very many distinct fingerprints share would make the verifying join quadratic. Beyond
``CROWD`` distinct fingerprints, a key's fingerprints are linked through their neighbourhoods
instead: two fingerprints are within two bits exactly if some value is within one bit of both. That
takes 65 rows per fingerprint, whatever the size of the crowd, and loses no link.

Defined results: NULL and empty texts have no words and fingerprint zero, linked like any other; a
text of one or two words has one shingle; exact copies and repeated rows share their fingerprint
and travel as one; a NULL doc_id is ignored when the smallest id of a component is taken; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import connected_components
from basketry.operators.scale import attach_by_key
from basketry.session import cut

WORDS = 3
SEED = 42
CROWD = 1024
AT_ONCE = 50_000  # shingles turned into bits at a time
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, width)
GENERATOR = 0b101011100011  # of the cyclic binary Golay code of length 23

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(raw: bytes | None, words: int = WORDS) -> int:
    """The 64 bits of a UTF-8 text: a bit is set if more than half of the shingles' hashes set it."""
    tokens = (raw or b"").translate(LOWER).split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, np.int64)
    for first in range(0, n, AT_ONCE):
        part = tokens[first : min(first + AT_ONCE, n) + words - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(words)])) if len(part) >= words else [b" ".join(part)]
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, carried: list[str] | None = None) -> DataFrame:
    """(doc_id, fp[, carried...]): the fingerprint as a signed 64-bit number."""
    carried = carried or []
    text = F.col("text").cast("binary").alias("_text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch["_text"]], np.uint64).view(np.int64)
            kept = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found)], [*kept.schema.names, "fp"])

    rows = docs.select("doc_id", *carried, text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(compute, f"{fields}, fp long")


def _codewords() -> np.ndarray:
    """All 4096 codewords, at their index: a multiple of the generator polynomial."""
    message = np.arange(4096, dtype=np.uint32)
    words = np.zeros(4096, np.uint32)
    for bit in range(12):
        words ^= np.where(message >> bit & 1, np.uint32(GENERATOR << bit), np.uint32(0))
    return words


@cache
def _decoder() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codewords, the index of the codeword nearest to each 23-bit word, and the distance to it."""
    words = _codewords()
    nearest, distance = np.zeros(1 << 23, np.uint16), np.zeros(1 << 23, np.uint8)
    flips = [0, *(1 << i for i in range(23))]
    errors = {e for a in flips for b in flips for c in flips if (e := a ^ b ^ c) >= 0}
    for error in errors:
        at = words ^ np.uint32(error)
        nearest[at] = np.arange(4096)
        distance[at] = error.bit_count()
    return words, nearest, distance


@cache
def _four_away() -> dict[int, np.ndarray]:
    """For each error of weight three, the five differences to codewords at distance four."""
    words = _codewords()
    heavy = words[np.bitwise_count(words) == 7]
    return {
        e: heavy[(heavy & np.uint32(e)) == e]
        for a in range(23) for b in range(a) for c in range(b)
        for e in [1 << a | 1 << b | 1 << c]
    }


def golay_indices(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): one index per word within two bits of its codeword, six at three bits."""
    words, nearest, distance = _decoder()
    centre = nearest[segment]
    rows, indices = [np.arange(len(segment))], [centre.astype(np.int64)]
    far = np.flatnonzero(distance[segment] == 3)
    errors = words[centre[far]] ^ segment[far].astype(np.uint32)
    for error in np.unique(errors):
        at = far[errors == error]
        for step in _four_away()[int(error)]:
            rows.append(at)
            indices.append(nearest[words[centre[at]] ^ step].astype(np.int64))
    return np.concatenate(rows), np.concatenate(indices)


def golay_keys(fps: DataFrame) -> DataFrame:
    """(key, fp): the keys of every distinct fingerprint."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch[0].to_numpy().view(np.uint64)
            parts = [((values >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
            for pair in range(3):
                exact, near = parts[pair], parts[(pair + 1) % 3]
                row, index = golay_indices(near)
                key = (exact[row] << 14) | (index << 2) | pair
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[row].view(np.int64))], ["key", "fp"])

    return fps.select("fp").mapInArrow(compute, "key long, fp long")


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b) between distinct fingerprints: every pair within two bits is linked, directly or, in a
    crowd, through the smallest fingerprint of each shared neighbourhood."""
    keys = golay_keys(fps)
    # Only shared keys matter. Counting combines within tasks, and keys are cheap to compute again.
    shared = cut(keys.join(keys.groupBy("key").count().filter("count > 1"), "key"))
    quiet = shared.filter(F.col("count") <= crowd)
    left, right = (quiet.select("key", F.col("fp").alias(c)) for c in "ab")
    verified = left.join(right, "key").filter("a < b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
    crowded = shared.filter(F.col("count") > crowd).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    around = crowded.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
    # Everything around a value is within two bits of everything else around it.
    hub = around.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    through = around.join(hub, "value").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return verified.select("a", "b").unionByName(through).distinct()


def near_duplicates(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per distinct fingerprint of (doc_id, fp): fp, copies, component_id, component.

    ``component_id`` is the smallest doc_id of the component, ``component`` its smallest fingerprint.
    """
    fps = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    classes = connected_components(links(fps, crowd))
    placed = cut(
        fps.join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    )
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    return attach_by_key(placed.drop("least"), least, "component", "n")


def document_components(docs: DataFrame, words: int = WORDS, crowd: int = CROWD) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    prints = cut(fingerprints(docs, words))
    classes = near_duplicates(prints, crowd).select("fp", "component_id", "copies")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return attach_by_key(prints, classes, "fp", "copies").select("doc_id", text.alias("fingerprint"), "component_id")
