"""Byte-level BPE encoding and decoding as a monoid tree reduction (operator 1).

A text is cut by the vocabulary's pattern; each match is encoded on its own. A match
is halved until its parts are short, the parts are merged by rank, and two encoded
neighbours are joined as follows. A token sequence is the encoding of its bytes exactly
when every token encodes to itself and every adjacent pair of tokens re-encodes to that
same pair: the first merge across a border would also be the first one across it in the
pair alone. So a join re-encodes a window around the border, doubling it on any side
where the window's outer token does not form such a stable pair with its neighbour; once
both sides are stable, the tokens outside cannot change. Decoding maps each id to its
bytes and concatenates up the same tree.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordsmith.llm.common import map_slices, read_table

LEAF_BYTES = 4          # parts of at most this many bytes are merged directly
MEMO_BYTES = 8          # parts of at most this many bytes are remembered
MEMO_SIZE = 200_000     # entries of each memory table before it is emptied
CHUNK_CHARS = 64        # longer stretches between spaces are not remembered
DECODE_LEAF = 4096      # tokens of a leaf of the decoding tree


class _Unsafe(Exception):
    """A space after white space: the text needs the exact cut."""


class _Chunks(dict):
    """Encoded stretches between spaces; ``lead`` says whether a space comes first."""

    def __init__(self, coder: "ByteBpe", lead: str):
        self.coder, self.lead = coder, lead

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[-1].isspace():
            raise _Unsafe
        ids = self.coder.encode_chunk(self.lead + chunk)
        if len(chunk) <= CHUNK_CHARS:
            if len(self) >= MEMO_SIZE:
                self.clear()
            self[chunk] = ids
        return ids


class ByteBpe:
    """Encoder and decoder over a rank table (bytes -> id)."""

    # A space that follows a non-space always begins a match, and what stands before it
    # is matched without looking past it: such cuts never change the matches.
    CUT = regex.compile(r"(?<=\S)(?= )")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.matches = regex.compile(pattern).findall
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.short: dict[bytes, tuple] = {}
        self.stable: dict[tuple, bool] = {}
        self.first, self.rest = _Chunks(self, ""), _Chunks(self, " ")

    # -- encoding -------------------------------------------------------------
    def merge(self, piece: bytes) -> tuple:
        """Lowest rank first, leftmost on ties, by a heap over linked parts."""
        n = len(piece)
        if n == 1:
            return (self.ranks[piece],)
        ranks, end, before = self.ranks, list(range(1, n + 1)), list(range(-1, n))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue                                   # one of the two parts has changed
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                r = ranks.get(piece[i:end[stop]])
                if r is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            j = before[i]
            if j >= 0:
                r = ranks.get(piece[j:stop])
                if r is not None:
                    heapq.heappush(heap, (r, j, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(out)

    def _merged(self, piece: bytes) -> tuple:
        if len(piece) > 2 * MEMO_BYTES:
            return self.merge(piece)
        ids = self.short.get(piece)
        if ids is None:
            if len(self.short) >= MEMO_SIZE:
                self.short.clear()
            ids = self.short[piece] = self.merge(piece)
        return ids

    def _pair_stable(self, a: int, b: int) -> bool:
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) >= MEMO_SIZE:
                self.stable.clear()
            known = self.stable[a, b] = self._merged(self.table[a] + self.table[b]) == (a, b)
        return known

    def join(self, left: tuple, right: tuple) -> tuple:
        """Encoding of the concatenation of two encoded byte strings."""
        if not left or not right:
            return left or right
        if self._pair_stable(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            window = self._merged(b"".join([self.table[i] for i in left[-a:] + right[:b]]))
            low = a >= len(left) or self._pair_stable(left[-a - 1], window[0])
            high = b >= len(right) or self._pair_stable(window[-1], right[b])
            if low and high:
                return left[:-a] + window + right[b:]
            a, b = a if low else 2 * a, b if high else 2 * b

    def encode_piece(self, piece: bytes) -> tuple:
        """Ids of one match of the pattern."""
        n = len(piece)
        if n <= MEMO_BYTES:
            ids = self.short.get(piece)
            if ids is not None:
                return ids
        if n <= LEAF_BYTES:
            return self._merged(piece) if n else ()
        half = n // 2
        ids = self.join(self.encode_piece(piece[:half]), self.encode_piece(piece[half:]))
        if n <= MEMO_BYTES:
            if len(self.short) >= MEMO_SIZE:
                self.short.clear()
            self.short[piece] = ids
        return ids

    def encode_chunk(self, text: str) -> bytes:
        ids: tuple = ()
        pieces = [self.encode_piece(m.encode()) for m in self.matches(text)]
        ids = [i for piece in pieces for i in piece]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers (null: none)."""
        if not text:
            return b""
        try:
            parts = text.split(" ")
            if len(parts) == 1:
                return self.encode_chunk(text)
            out = [self.first[parts[0]] if parts[0] else b""]
            out.extend(map(self.rest.__getitem__, parts[1:-1]))
            out.append(self.encode_chunk(" " + parts[-1]))
            return b"".join(out)
        except _Unsafe:
            return b"".join([self.encode_chunk(c) for c in self.CUT.split(text)])

    # -- decoding -------------------------------------------------------------
    def decode(self, ids: bytes | None) -> bytes:
        """Bytes of packed ids; leaves of the tree are joined, then the joined leaves."""
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        lookup = self.table.__getitem__
        return b"".join([b"".join(map(lookup, numbers[i:i + DECODE_LEAF]))
                         for i in range(0, len(numbers), DECODE_LEAF)])


def default_vocabulary() -> tuple[str, str]:
    """(path of the rank file, pattern) of the public byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def load_coder(path: str, pattern: str) -> ByteBpe:
    """One coder per worker process; the rank file has one base64 token and rank a line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return ByteBpe(ranks, pattern)


def _kept(df: DataFrame, *replaced: str) -> list[T.StructField]:
    names = {r.lower() for r in replaced}
    return [f for f in df.schema.fields if f.name.lower() not in names]


def bpe_encode(df: DataFrame, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens",
               vocabulary: tuple[str, str] | None = None, keep_text: bool = True) -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens`` to every row.

    Null and empty texts give no ids and 0 tokens. Rows are independent, so repeated rows
    repeat and any other column may be null. Columns of ``df`` named like an output column
    are replaced. Very long texts and very long matches cost time about in proportion to
    their length.
    """
    path, pattern = vocabulary or default_vocabulary()
    kept = _kept(df, ids, n_tokens, *([] if keep_text else [text]))
    schema = T.StructType([*kept, T.StructField(ids, T.BinaryType()),
                           T.StructField(n_tokens, T.LongType())])

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = load_coder(path, pattern)
        packed = [coder.encode(t) for t in batch.column("__text").to_pylist()]
        columns = [batch.column(f.name) for f in kept]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(packed, pa.binary()),
             pa.array([len(p) // 4 for p in packed], pa.int64())], [*(f.name for f in schema)])

    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias("__text"))
    return map_slices(source, encode, schema, "__text")


def bpe_decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded",
               vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Add ``decoded`` (binary): the bytes of the packed ids; null ids give no bytes."""
    path, pattern = vocabulary or default_vocabulary()
    kept = _kept(df, decoded)
    schema = T.StructType([*kept, T.StructField(decoded, T.BinaryType())])

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = load_coder(path, pattern)
        out = [coder.decode(p) for p in batch.column(ids).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(f.name) for f in kept), pa.array(out, pa.binary())],
            [f.name for f in schema])

    return map_slices(df.select(*[F.col(f"`{f.name}`") for f in kept]), decode, schema, ids)


def op1_bpe_roundtrip(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_decode(bpe_encode(docs, keep_text=False))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
