"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token starts as one symbol per UTF-8 byte in a linked list.  Every merge
rank has a bucket of list positions, and a bitmap of two levels says which
buckets hold any: the lowest rank is found by find-first-set from the top
level down, in constant time whatever the length.  A position taken from a
bucket is stale, and skipped, if its pair has meanwhile got another rank; else
the pair is merged and its two neighbour pairs are filed under their new ranks.
Each bucket gives its leftmost position first, which is the order of the public
library.  The work is about linear in a pre-token's length, so one very long
word is no problem.  Ids of short pre-tokens are remembered in a table of
bounded size per worker.

``encode`` gives the ids as little-endian unsigned 32-bit integers (binary),
``decode`` gives the bytes of such ids, ``round_trip`` gives both in one pass.

Nulls and edges: a null or empty text has no ids; null ids decode to no bytes;
an id outside the vocabulary, or ids that are not whole integers, raise; other
columns are carried unchanged, whatever they hold; repeated rows are encoded
each; an empty table stays empty.  A result column that the input already has
raises.
"""

from __future__ import annotations

import base64
import heapq
import struct

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.tokens import vocabulary_path

#: Bits of a word of the lower bitmap.
_WORD = 256
_BITS = [1 << i for i in range(_WORD)]


class RankQueue:
    """Buckets of positions per rank, and bitmaps of two levels: which words of ranks, and which ranks, hold any."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * (ranks // _WORD + 1)
        self.top = 0

    def put(self, rank: int, position: int) -> None:
        if rank in self.buckets:
            heapq.heappush(self.buckets[rank], position)
            return
        self.buckets[rank] = [position]
        word = rank // _WORD
        if not self.low[word]:
            self.top |= 1 << word
        self.low[word] |= _BITS[rank % _WORD]

    def pop(self) -> tuple[int, int] | None:
        """The lowest rank and its leftmost position, or None when nothing is left."""
        top = self.top
        if not top:
            return None
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        rank = word * _WORD + (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heapq.heappop(bucket)
        del self.buckets[rank]
        self.low[word] = bits = bits & (bits - 1)  # its lowest bit is the one that was found
        if not bits:
            self.top = top & (top - 1)
        return rank, bucket[0]


class Coder(dict):
    """Ids of pre-tokens as packed 32-bit integers; as a mapping it remembers those of short ones, lately seen."""

    def __init__(self, ranks: dict[bytes, int], split: str, remember: int = 400_000, longest: int = 40):
        super().__init__()
        self.ranks, self.split = ranks, regex.compile(split)
        self.remember, self.longest = remember, longest
        self.older: dict[str, bytes] = {}
        self.size = max(ranks.values(), default=-1) + 1
        self.queue = RankQueue(self.size)  # empty again after each pre-token
        self.single = [ranks[bytes([byte])] for byte in range(256)]
        self.double = {tuple(token): rank for token, rank in ranks.items() if len(token) == 2}
        self.table: list[bytes | None] = [None] * self.size
        for token, rank in ranks.items():
            self.table[rank] = token

    def merged(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of = self.ranks.get
        if (whole := rank_of(data)) is not None:
            return [whole]
        n = len(data)
        ids = [self.single[byte] for byte in data]
        after = list(range(1, n + 2))  # the start of the next symbol; symbol i is data[i:after[i]]
        before = list(range(-1, n))
        pair = [self.double.get(two) for two in zip(data, data[1:])] + [None]  # the rank of the pair that starts at a position
        put, pop = self.queue.put, self.queue.pop
        for i, rank in enumerate(pair):
            if rank is not None:
                put(rank, i)
        while (found := pop()) is not None:
            rank, i = found
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            end = after[i] = after[j]
            ids[i] = rank  # a merge's rank is the id that it makes
            pair[j] = None
            if end < n:
                before[end] = i
                pair[i] = made = rank_of(data[i: after[end]])
                if made is not None:
                    put(made, i)
            else:
                pair[i] = None
            if (p := before[i]) >= 0:
                pair[p] = made = rank_of(data[p:end])
                if made is not None:
                    put(made, p)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def __missing__(self, token: str) -> bytes:
        packed = self.older.get(token)
        if packed is None:
            ids = self.merged(token.encode("utf-8"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= self.longest:
            if len(self) >= self.remember:
                self.older = dict(self)
                self.clear()
            self[token] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.split.findall(text))) if text else b""

    def decode(self, packed: bytes | None) -> bytes:
        if not packed:
            return b""
        return b"".join(map(self.table.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(vocabulary: str, split: str | None = None) -> Coder:
    """The vocabulary, loaded once per worker; ``split`` defaults to the pattern that its package names."""
    if split is None:
        import public_tokenizers

        split = public_tokenizers.PATTERN
    if (vocabulary, split) not in _CODERS:
        with open(vocabulary_path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CODERS[vocabulary, split] = Coder(ranks, split)
    return _CODERS[vocabulary, split]


def encode(
    docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", split: str | None = None, text: str = "text",
    out: str = "ids",
) -> DataFrame:
    """``docs`` with the ids of every whole text, packed as little-endian unsigned 32-bit integers."""
    if out in docs.columns:
        raise ValueError(f"input must not have a column named {out!r}")

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        bpe = coder(vocabulary, split)
        return pd.Series([bpe.encode(t) for t in texts], dtype=object)

    return docs.withColumn(out, encoded(F.coalesce(F.col(text), F.lit(""))))


def decode(
    rows: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", split: str | None = None, ids: str = "ids",
    out: str = "decoded",
) -> DataFrame:
    """``rows`` with the bytes of every row's ids."""
    if out in rows.columns:
        raise ValueError(f"input must not have a column named {out!r}")

    @F.pandas_udf("binary")
    def decoded(packed: pd.Series) -> pd.Series:
        bpe = coder(vocabulary, split)
        return pd.Series([bpe.decode(p) for p in packed], dtype=object)

    return rows.withColumn(out, decoded(F.col(ids)))


def round_trip(
    docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", split: str | None = None, text: str = "text",
    ids: str = "ids", decoded: str = "decoded",
) -> DataFrame:
    """``docs`` with the ids of every whole text and the bytes that these ids stand for, in one pass of one worker."""
    if clash := {ids, decoded} & set(docs.columns):
        raise ValueError(f"input must not have columns named {sorted(clash)}")

    @F.pandas_udf("ids binary, decoded binary")
    def coded(texts: pd.Series) -> pd.DataFrame:
        bpe = coder(vocabulary, split)
        packed = [bpe.encode(t) for t in texts]
        return pd.DataFrame({"ids": pd.Series(packed, dtype=object), "decoded": pd.Series(map(bpe.decode, packed), dtype=object)})

    both = coded(F.coalesce(F.col(text), F.lit("")))
    return docs.withColumn("__coded", both).select(*docs.columns, F.col("__coded.ids").alias(ids), F.col("__coded.decoded").alias(decoded))


def n_ids(ids: str = "ids"):
    """How many ids a packed column holds."""
    return F.floor(F.octet_length(ids) / 4).cast("long")
