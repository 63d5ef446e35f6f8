"""Sum-of-squares packing of tokenized documents into sequences of a fixed length.

Documents longer than a sequence are cut into full pieces and a rest; a full piece is a sequence of
its own. Rests are placed longest first: of the open sequences a rest fits into, it goes to one of
the gap for which the sum over all gaps of (open sequences with that gap) squared becomes smallest,
the smallest gap on a tie; only if none fits, a sequence is opened.

The rows to place are narrow (no text, no ids unless asked for) and dealt evenly into groups of
about ``group_rows`` by a hash, so one task holds a bounded number of them and groups run in
parallel; a group leaves about one sequence unfilled.

Defined results: NULL or empty text is the end id alone; repeated rows and repeated or NULL ids are
packed like others; an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.tokens import encoder
from basketry.session import stage

LENGTH = 2048
GROUP_ROWS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``length`` tokens; ``ids`` (little-endian uint32) if asked for."""
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            ids, columns = [], [[], [], [], [], []]
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                raw = encode.ids(text.as_py()) + end
                for piece, at in enumerate(range(0, len(raw), width)):
                    part = raw[at : at + width]
                    for column, value in zip(columns, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
                    if keep_ids:
                        ids.append(part)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)] + ([pa.array(ids, pa.binary())] if keep_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids binary" if keep_ids else ""))


def place(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every item, sequences numbered from 0."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_count = np.zeros(length + 1, np.int64)  # by gap; gap 0 is closed and not counted
    open_ids: list[list[int]] = [[] for _ in range(length + 1)]
    opened = 0
    for item in np.argsort(-lengths, kind="stable"):
        size = int(lengths[item])
        before = open_count[size:length]  # by what would remain: gaps size..length-1
        if before.any():
            # (n - 1)^2 + (m + 1)^2 - n^2 - m^2 for a sequence that goes from gap n to gap m.
            change = 2 * (open_count[: length - size] - before) + 2
            change[0] = 1 - 2 * before[0]
            rest = int(np.argmin(np.where(before > 0, change, np.iinfo(np.int64).max)))
            gap = rest + size
            open_count[gap] -= 1
            chosen = open_ids[gap].pop()
        else:
            gap, rest, chosen = length, length - size, opened
            opened += 1
        sequence[item], offset[item] = chosen, length - gap
        if rest:
            open_count[rest] += 1
            open_ids[rest].append(chosen)
    return sequence, offset


def pack(pieces: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds sequence_id and offset to pieces as from ``token_pieces``."""
    staged = stage(pieces, "pieces")
    groups = max(1, -(-staged.count() // group_rows))
    # The position spreads rows that are equal in everything else.
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))

    def fill(table: pa.Table) -> pa.Table:
        sequence, offset = place(table["length"].to_numpy(), length)
        base = table["_group"][0].as_py() << 40  # a group has fewer sequences than that
        kept = table.drop_columns(["_group"])
        return kept.append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in staged.schema)
    return (
        staged.withColumn("_group", key)
        .repartition(groups, "_group")
        .groupBy("_group")
        .applyInArrow(fill, f"{fields}, sequence_id long, offset long")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array), documents in their order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    raw = F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "")
    return packed.groupBy("sequence_id").agg(F.unhex(raw).alias("ids"), F.transform(parts, lambda p: p["doc_id"]).alias("doc_ids"))
