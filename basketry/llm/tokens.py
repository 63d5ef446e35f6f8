"""Token ids of whole texts with a public tokenizer, one dictionary lookup per repeated word.

The tokenizer drops white space and none of its steps looks across it, so a text's ids are those of
its white-space-separated pieces, one after the other. Each distinct piece is encoded by the
library once per worker; ids are kept as little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import struct

from tokenizers import Tokenizer

from basketry.llm.held import held

CACHED_PIECES = 600_000  # distinct pieces a worker remembers; beyond it, it starts afresh
MARKS = ".,;:!?"  # never part of a word, so a word and the marks after it are encoded apart


def _byte_characters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder(dict):
    """``encoder.ids(raw)``: the ids of a UTF-8 text as little-endian 32-bit bytes.

    As a dictionary it maps a piece to its ids.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def ids(self, raw: bytes | None) -> bytes:
        if not raw:
            return b""
        if len(self) > CACHED_PIECES:
            self.clear()
        if b"<|" not in raw:  # special tokens are the only strings whose case the tokenizer sees
            raw = raw.lower()
        # Only these six are white space for bytes; others stay inside a piece for the library.
        return b"".join([self[piece] for piece in raw.split()])

    def __missing__(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        word = text.rstrip(MARKS)
        if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
            # One word in composed form, perhaps with marks after it: only the model is needed.
            small = word.lower()
            key = small.encode()
            ids = self.get(key)
            if ids is None:
                written = small if len(key) == len(small) else key.decode("latin-1").translate(BYTE_CHARACTERS)
                ids = self[key] = _bytes([token.id for token in self.model.tokenize(written)])
            if len(word) < len(text):
                ids += self[text[len(word) :].encode()]
        else:
            ids = _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[piece] = ids
        return ids


def encoder(path: str) -> Encoder:
    """The worker's encoder; what it has learned serves later tasks of the same operator as well."""
    return held(("encoder", path), lambda: Encoder(path))
