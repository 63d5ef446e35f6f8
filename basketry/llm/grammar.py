"""Token ids in Re-Pair compressed shard files with random access to every document.

Within a shard, frequent pairs of neighbouring ids are replaced by new ids (nonterminals), again and
again, all chosen pairs of a round at once; a pair never spans the end id, so a document starts
at a symbol of its own. A file stores the rules, the length of every rule's expansion, where each
document starts (in symbols and in tokens) and the remaining symbols:

    magic | docs, tokens, symbols, rules, first rule, bytes per symbol (int64 each)
    rule left (u32) | rule right (u32) | expansion length (u32)
    doc id (i64) | id is NULL (u8) | symbol start (i64, one more) | token start (i64, one more)
    symbols (u16 or u32)

Documents are dealt by ranges of (id, text hash) and sorted, so shard files follow one another in
ascending id order, NULL ids first. A file holds at most about ``shard_tokens`` tokens (or one
document), which bounds a task's memory; a task writes as many files as it needs.

Defined results: NULL or empty text is the end id alone; repeated rows and ids are documents of
their own; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm import files
from basketry.llm.tokens import encoder
from basketry.session import stage

MAGIC = b"REPAIR01"
SHARD_TOKENS = 4_000_000
ROUNDS = 5  # rounds of replacement; each looks at every remaining symbol
LEAST_USES = 16  # a rule that saves fewer symbols costs more than it gives
BUCKET_BITS = 20
MANIFEST = "part int, roll int, path string, n_docs long, n_tokens long, n_symbols long, n_rules long"


def _bucket(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left * np.uint32(0x9E3779B1)) ^ (right * np.uint32(0x85EBCA6B))
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def compress(ids: np.ndarray, end_id: int, first_rule: int, rounds: int = ROUNDS, most_rules: int | None = None):
    """(symbols, left, right): the ids with frequent pairs replaced, rule i being id first_rule + i.

    ``most_rules`` defaults to what keeps symbols in 16 bits, where the vocabulary leaves room.
    """
    room = (1 << 16) - first_rule
    most_rules = most_rules if most_rules is not None else (room if room >= 1024 else 1 << 16)
    symbols = ids.astype(np.uint32)
    lefts, rights, made = [], [], 0
    for left_rounds in range(rounds, 0, -1):
        if made >= most_rules or len(symbols) < 2:
            break
        a, b = symbols[:-1], symbols[1:]
        bucket = _bucket(a, b)
        count = np.bincount(bucket, minlength=1 << BUCKET_BITS)
        budget = (most_rules - made) // left_rounds
        least = LEAST_USES
        if (count >= least).sum() > budget:
            least = max(least, int(np.partition(count, -budget)[-budget]) + 1)
        at = np.flatnonzero((count >= least)[bucket] & (a != end_id) & (b != end_id))
        if not len(at):
            break
        # One pair stands for its bucket; the few others of the bucket wait for a later round.
        held = bucket[at]
        pair = (a[at].astype(np.uint64) << np.uint64(32)) | b[at]
        stands = np.zeros(1 << BUCKET_BITS, np.uint64)
        stands[held] = pair
        same = stands[held] == pair
        at, held = at[same], held[same]
        # Of neighbouring matches every second one is replaced.
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1] + 1
        start = np.maximum.accumulate(np.where(first, at, 0))
        chosen = ((at - start) & 1) == 0
        at, held = at[chosen], held[chosen]
        uses = np.bincount(held, minlength=1 << BUCKET_BITS)
        kept = np.flatnonzero(uses >= LEAST_USES)[: most_rules - made]
        if not len(kept):
            break
        number = np.zeros(1 << BUCKET_BITS, np.uint32)
        number[kept] = first_rule + made + np.arange(len(kept), dtype=np.uint32)
        used = number[held] > 0
        at, held = at[used], held[used]
        lefts.append((stands[kept] >> np.uint64(32)).astype(np.uint32))
        rights.append((stands[kept] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        made += len(kept)
        size = len(symbols)
        symbols = symbols.copy()
        symbols[at] = number[held]
        stays = np.ones(size, bool)
        stays[at + 1] = False
        symbols = symbols[stays]
        if len(symbols) > 0.99 * size:
            break
    none = [np.zeros(0, np.uint32)]
    return symbols, np.concatenate(lefts or none), np.concatenate(rights or none)


def expansion_lengths(left: np.ndarray, right: np.ndarray, first_rule: int) -> np.ndarray:
    """Tokens that each rule stands for; a rule only refers to earlier ones."""
    lengths = np.ones(len(left), np.int64)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        lengths[i] = (lengths[a - first_rule] if a >= first_rule else 1) + (lengths[b - first_rule] if b >= first_rule else 1)
    return lengths


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat = np.zeros(int(starts[-1]), np.uint32)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        at = int(starts[i])
        for part in (a, b):
            if part < first_rule:
                flat[at] = part
                at += 1
            else:
                k = part - first_rule
                flat[at : at + int(lengths[k])] = flat[starts[k] : starts[k + 1]]
                at += int(lengths[k])
    symbols = symbols.astype(np.int64)
    is_rule = symbols >= first_rule
    rule = np.where(is_rule, symbols - first_rule, 0)
    each = np.where(is_rule, lengths[rule] if len(lengths) else 1, 1)
    ends = np.cumsum(each)
    out = np.repeat(symbols, each).astype(np.uint32)
    inside = np.repeat(is_rule, each)
    if inside.any():
        source = np.repeat((starts[rule] if len(lengths) else rule) - (ends - each), each) + np.arange(len(out))
        out[inside] = flat[source[inside]]
    return out


def write_file(path: str, doc_ids: list[int | None], texts: list[bytes], end_id: int, first_rule: int) -> tuple[int, int, int]:
    """Write one shard of documents given as little-endian ids; (tokens, symbols, rules)."""
    ids = np.frombuffer(b"".join(texts), "<u4")
    tokens = np.concatenate([[0], np.cumsum([len(t) // 4 for t in texts])]).astype("<i8")
    symbols, left, right = compress(ids, end_id, first_rule)
    # Every document ends with its end id, which is never part of a rule, so ends can be counted
    # back from the tokens: the last symbol of a document is the symbol that reaches its token end.
    lengths = expansion_lengths(left, right, first_rule)
    each = np.ones(len(symbols), np.int64)
    rules = symbols >= first_rule
    each[rules] = lengths[symbols[rules] - first_rule]
    starts = np.concatenate([[0], np.searchsorted(np.cumsum(each), tokens[1:]) + 1]).astype("<i8")
    width = 2 if first_rule + len(left) <= 1 << 16 else 4
    header = np.array([len(texts), len(ids), len(symbols), len(left), first_rule, width], "<i8")
    with files.create(path) as out:
        out.write(MAGIC + header.tobytes())
        for column in (left, right, lengths):
            out.write(column.astype("<u4").tobytes())
        out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
        out.write(np.array([d is None for d in doc_ids], "u1").tobytes())
        out.write(starts.tobytes() + tokens.tobytes())
        out.write(symbols.astype(f"<u{width}").tobytes())
    return len(ids), len(symbols), len(left)


class ShardFile:
    """Random access to the documents of a shard file by ranged reads."""

    def __init__(self, path: str):
        self.file = files.open_ranges(path)
        head = self.file.read_at(len(MAGIC) + 48, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"not a compressed shard: {path}")
        self.n_docs, self.n_tokens, self.n_symbols, rules, self.first_rule, self.width = np.frombuffer(head[len(MAGIC) :], "<i8").tolist()
        at = len(MAGIC) + 48

        def column(kind: str, n: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * n
            found = np.frombuffer(self.file.read_at(size, at), kind)
            at += size
            return found

        self.left, self.right, self.lengths = (column("<u4", rules) for _ in range(3))
        self.lengths = self.lengths.astype(np.int64)
        self.doc_ids, self.is_null = column("<i8", self.n_docs), column("u1", self.n_docs)
        self.symbol_starts, self.token_starts = column("<i8", self.n_docs + 1), column("<i8", self.n_docs + 1)
        self.data_at = at

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of documents first..last-1 in one array; only their symbols are read."""
        lo, hi = int(self.symbol_starts[first]), int(self.symbol_starts[last])
        raw = self.file.read_at((hi - lo) * self.width, self.data_at + lo * self.width)
        return expand(np.frombuffer(raw, f"<u{self.width}"), self.left, self.right, self.lengths, self.first_rule)


def write_corpus(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode and write all documents; one row per file written, in (part, roll) order of the ids."""
    folder = files.qualified(docs.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        first_rule = encode.tokenizer.get_vocab_size()
        end = np.array([end_id], "<u4").tobytes()
        part, roll = TaskContext.get().partitionId(), 0
        doc_ids, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            path = files.new_file(folder, f"part-{part:06d}-{roll:04d}", ".repair")
            counts = write_file(path, doc_ids, texts, end_id, first_rule)
            row = (part, roll, path, len(doc_ids), *counts)
            kinds = (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4)
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                doc_ids.append(doc_id)
                texts.append(encode.ids(text.as_py()) + end)
                held += len(texts[-1]) // 4
                if held >= shard_tokens:
                    yield flush()
                    doc_ids, texts, held, roll = [], [], 0, roll + 1
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return stage(ordered.mapInArrow(write, MANIFEST), "repair-manifest")


def read_corpus(manifest: DataFrame, docs_at_once: int = 4096) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Only the file list is ordered as a whole; it has one row per some million tokens.
    """
    before = W.orderBy("part", "roll").rowsBetween(W.unboundedPreceding, -1)
    based = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                shard = ShardFile(path)
                for first in range(0, shard.n_docs, docs_at_once):
                    last = min(first + docs_at_once, shard.n_docs)
                    raw = shard.ids(first, last).astype("<u4").tobytes()
                    ends = (shard.token_starts[first : last + 1] - shard.token_starts[first]) * 4
                    crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[first:last], mask=shard.is_null[first:last].astype(bool)),
                            pa.array(shard.token_starts[first:last] + base),
                            pa.array(np.diff(shard.token_starts[first : last + 1])),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # By number: the few bytes of the list must not make adaptive execution read all files in one task.
    spread = based.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
