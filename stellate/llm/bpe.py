"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

``model_proto`` writes a sentencepiece BPE model straight from a vocabulary of
byte strings with merge ranks: every byte stands for one character (byte ``b``
for code point 256 + ``b``), a piece's score is its negative rank, and the
normaliser is the identity. Merging the best-scored adjacent pair first is
then merging the lowest rank first. Text is cut into pre-tokens by the
vocabulary's pattern and each is encoded by itself; decoding maps ids back to
their bytes.

Null or empty texts give an empty id list; very long texts are encoded whole;
rows are independent, so ties, repeats, empty tables and extra columns need no
care: every input column is kept and the outputs are added under the names
given (an input column of that name is replaced).
"""

from __future__ import annotations

import base64
import struct
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.common import whole

# Field numbers and enum values of sentencepiece's public model format.
BPE_MODEL = 2
NORMAL_PIECE, UNKNOWN_PIECE = 1, 2

BYTE_BASE = 0x100
TO_CHARS = {b: BYTE_BASE + b for b in range(256)}
CACHED_PRETOKENS = 200_000  # pre-tokens a worker remembers before it starts afresh


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a ``base64 rank`` per line file: token bytes -> id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _block(1, _block(1, text.encode()) + score_field + _number(3, kind))


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model for a byte-level vocabulary.

    Piece ``i`` is the token of the ``i``-th lowest rank; the unknown piece
    every model must have comes last (no byte string ever needs it).
    """
    tokens = sorted(ranks, key=ranks.get)
    pieces = b"".join(
        _piece(t.decode("latin-1").translate(TO_CHARS), -float(ranks[t]), NORMAL_PIECE) for t in tokens
    )
    unknown = _piece("<unk>", 0.0, UNKNOWN_PIECE)
    trainer = _number(3, BPE_MODEL) + _number(4, len(tokens) + 1)
    trainer += _number(40, len(tokens)) + b"".join(_number(f, -1) for f in (41, 42, 43))
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + unknown + _block(2, trainer) + _block(3, normaliser)


@dataclass
class Codec:
    """What a task needs: the model, the pre-token pattern and the id <-> bytes table."""

    proto: bytes
    pattern: str
    ids: list[int]
    tokens: list[bytes]

    def open(self) -> Codec:
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=self.proto)
        self.split = regex.compile(self.pattern).findall
        self.table = dict(zip(self.ids, self.tokens, strict=True))
        self.same_ids = self.ids == list(range(len(self.ids)))
        self.known: dict[str, list[int]] = {}
        return self

    def encode(self, text: str) -> list[int]:
        pretokens = self.split(text)
        known = self.known
        new = [p for p in set(pretokens) if p not in known]
        if new:
            if len(known) + len(new) > CACHED_PRETOKENS:
                known.clear()
                new = list(set(pretokens))
            mapped = [p.encode().decode("latin-1").translate(TO_CHARS) for p in new]
            found = self.processor.encode(mapped, num_threads=1)
            if not self.same_ids:
                found = [[self.ids[i] for i in one] for one in found]
            known.update(zip(new, found, strict=True))
        out: list[int] = []
        for p in pretokens:
            out += known[p]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


def _codec(shared) -> Codec:
    """The worker's codec, opened once and kept beside the broadcast parts."""
    parts = shared.value
    if "codec" not in parts:
        parts["codec"] = Codec(*parts["parts"]).open()
    return parts["codec"]


class ByteBpe:
    """Encode and decode columns with one vocabulary file.

    ``path`` is read on the driver; the model (its size is that of the
    vocabulary, not of the data) is sent to the executors once. ``pattern``
    defaults to the public tokenizers' pre-token pattern.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str | None = None):
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        ranks = read_ranks(path)
        tokens = sorted(ranks, key=ranks.get)
        parts = (model_proto(ranks), pattern, [ranks[t] for t in tokens], tokens)
        self.shared = spark.sparkContext.broadcast({"parts": parts})

    def encode(self, df: DataFrame, text: str = "text", ids: str = "input_ids") -> DataFrame:
        """Add ``ids`` array<int>: the token ids of the whole text."""
        shared = self.shared

        @F.arrow_udf("array<int>")
        def encoded(texts):
            import numpy as np
            import pyarrow as pa

            codec = _codec(shared)
            rows = [np.array(codec.encode(t.as_py()), dtype=np.int32) for t in texts]
            offsets = np.zeros(len(rows) + 1, dtype=np.int32)
            np.cumsum([len(r) for r in rows], out=offsets[1:])
            flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))

        return df.withColumn(ids, encoded(whole(text)))

    def decode(self, df: DataFrame, ids: str = "input_ids", out: str = "decoded") -> DataFrame:
        """Add ``out`` binary: the bytes the ids stand for (null ids: no bytes)."""
        shared = self.shared

        @F.arrow_udf("binary")
        def decoded(lists):
            import pyarrow as pa

            codec = _codec(shared)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)  # a document at a time becomes Python numbers
            return pa.array([codec.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])], pa.binary())

        return df.withColumn(out, decoded(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def digests(
    df: DataFrame, ids: str = "input_ids", decoded: str = "decoded", extra: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_tokens, the SHA-256 of the ids as text and of the decoded bytes, and ``extra`` columns."""
    return df.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
        *extra,
    )
