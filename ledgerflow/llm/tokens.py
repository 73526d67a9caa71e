"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as one symbol per UTF-8 byte, held in a doubly linked list.
A heap holds the rank of every adjacent pair that can merge; the lowest rank
(leftmost first) is popped, its pair merged, and the pairs with the two
neighbours pushed.  The token count is the number of initial symbols minus the
number of merges; no identifiers are emitted.  The work is O(n log n) in a
pre-token's length, so one very long word is no problem, and counts of short
pre-tokens are remembered in a table of bounded size per worker.

Nulls and edges: a null or empty text has 0 bytes and 0 tokens; other columns
are carried unchanged, whatever they hold; repeated rows are counted each; an
empty table stays empty.  A result column that the input already has raises.
"""

from __future__ import annotations

import heapq
import json
import os

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how this family of vocabularies splits text before merging.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def vocabulary_path(name: str) -> str:
    """An absolute path as it is; else the file of that name among the installed public vocabularies."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Merges:
    """Merge ranks of a byte-level vocabulary file, and counts of pre-tokens seen lately."""

    def __init__(self, path: str, remember: int = 300_000, longest: int = 40):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.byte_id = [vocab[c] for c in _byte_letters()]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.remember, self.longest, self.counts = remember, longest, {}

    def merged(self, data: bytes) -> int:
        """Tokens of one pre-token: its bytes minus the merges that its pairs allow."""
        n = len(data)
        symbol = [self.byte_id[b] for b in data]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        ranks, heap = self.ranks, []
        for i in range(n - 1):
            if (found := ranks.get((symbol[i], symbol[i + 1]))) is not None:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if symbol[i] < 0 or j < 0 or ranks.get((symbol[i], symbol[j])) != (rank, made):
                continue  # one of the two was merged meanwhile
            merges += 1
            symbol[i], symbol[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if (p := before[i]) >= 0 and (found := ranks.get((symbol[p], made))) is not None:
                heapq.heappush(heap, (found[0], p, found[1]))
            if (q := after[i]) >= 0 and (found := ranks.get((made, symbol[q]))) is not None:
                heapq.heappush(heap, (found[0], i, found[1]))
        return n - merges

    def _piece(self, piece: str) -> int:
        known, total = self.counts, 0
        for token in SPLIT.findall(piece):
            n = known.get(token)
            if n is None:
                n = self.merged(token.encode("utf-8"))
                if len(token) <= self.longest:
                    if len(known) >= self.remember:
                        known.clear()
                    known[token] = n
            total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self._piece(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(self._piece(p) for p in pieces if p)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


_LOADED: dict[str, Merges] = {}


def merges(path: str) -> Merges:
    """The vocabulary, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Merges(path)
    return _LOADED[path]


def count_tokens(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024, text: str = "text"
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text."""
    if clash := {"n_bytes", "n_tokens", "over_limit"} & set(docs.columns):
        raise ValueError(f"input must not have columns named {sorted(clash)}")

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        bpe = merges(vocabulary_path(vocabulary))
        return pd.Series([bpe.count(t) for t in texts], dtype="int64")

    body = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.withColumn("n_bytes", F.octet_length(body).cast("long"))
        .withColumn("n_tokens", counted(body))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
