"""Byte-level BPE encoding and decoding through a sentencepiece model.

A rank file (token bytes -> rank) becomes a sentencepiece BPE model without
training: each token's bytes are written with one printable character per
byte, its score is the negative rank, and the normaliser is the identity.
Merging the pair of highest score, leftmost first, is then merging the pair of
lowest rank, so ids are ranks.  Texts are split by the pattern, each
pre-token is encoded on its own, and ids are decoded by the inverse mapping.

Runs inside the scan's tasks, without a shuffle.  Distinct pre-tokens are
encoded once per task and kept in a table of bounded size, which is emptied
when full.  Defined results: a null or empty text has no ids; rows stored
twice return twice; further columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from streamkit.llm.common import id_type, map_texts, read_table, text_rows, tokenizer_path

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens kept per task, and the longest that is kept.
KEPT, KEPT_CHARS = 300_000, 48


def byte_characters() -> list[str]:
    """One printable character per byte: itself where it is printable
    Latin-1, else the next unused character from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, varint or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; the unknown piece takes the first free id."""
    chars = byte_characters()
    tokens = [b""] * len(ranks)
    for token, rank in ranks.items():
        tokens[rank] = token
    normal, unknown, bpe = 1, 2, 2
    piece = lambda text, score, kind: _field(1, _field(1, text.encode()) + _field(2, score) + _field(3, kind))
    pieces = [piece("".join(chars[b] for b in t), -float(i), normal) for i, t in enumerate(tokens)]
    pieces.append(piece("⁇", 0.0, unknown))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(tokens)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        chars = byte_characters()
        self.to_chars = {i: c for i, c in enumerate(chars)}
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(sentencepiece_model(ranks))
        byte_of = {c: b for b, c in enumerate(chars)}
        self.bytes_of = [bytes(byte_of[c] for c in self.model.id_to_piece(i)) for i in range(len(ranks))]
        self.kept: dict[str, bytes] = {}

    def mapped(self, token: str) -> str:
        return token.encode().decode("latin-1").translate(self.to_chars)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if len(self.kept) > KEPT:
            self.kept.clear()
        kept, tokens = self.kept, self.split(text)
        if new := [t for t in dict.fromkeys(tokens) if t not in kept]:
            for t, ids in zip(new, self.model.encode([self.mapped(t) for t in new], num_threads=1)):
                kept[t] = np.array(ids, "<u4").tobytes()
        out = b"".join([kept[t] for t in tokens])
        for t in new:
            if len(t) > KEPT_CHARS:
                kept.pop(t, None)
        return out

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def codec(name: str, pattern: str | None = None) -> ByteBpe:
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return ByteBpe(tokenizer_path(name), pattern)


def encode(docs: DataFrame, name: str = RANKS, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): each text's ids as little-endian 32-bit integers."""

    def make():
        one = codec(name, pattern).encode
        return lambda rows: {"doc_id": rows["doc_id"], "ids": [one(t) for t in rows["text"]]}

    rows = text_rows(docs, id_col, text_col)
    return map_texts(rows, make, f"doc_id {id_type(rows)}, ids binary")


def decode(encoded: DataFrame, name: str = RANKS, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids, bytes) of rows with ``ids`` as ``encode`` gives them."""

    def make():
        one = codec(name, pattern).decode
        return lambda rows: rows | {"bytes": [one(x) for x in rows["ids"]]}

    return map_texts(encoded.select("doc_id", "ids"), make, f"doc_id {id_type(encoded)}, ids binary, bytes binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every document: encoded, then decoded from the ids.
    Encoder, decoder and digests share one pass, so ids stay in the task."""

    def make():
        bpe = codec(RANKS)

        def digests(rows: dict) -> dict:
            out: dict[str, list] = {"doc_id": rows["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in rows["text"]:
                ids = bpe.encode(text)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            return out

        return digests

    rows = text_rows(read_table(spark, sf_dir, "documents"))
    return map_texts(rows, make, f"doc_id {id_type(rows)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
