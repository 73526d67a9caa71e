"""Best-fit packing by sum of squares.

Texts become pieces of at most ``size`` tokens (only longer texts are cut; the
first piece takes the remainder).  Pieces are packed into sequences by the
sum-of-squares rule: with N(g) open bins of residual gap g, a piece goes where
the sum of N(g)**2 becomes smallest.

The rule sees lengths only, so it runs on the histogram of lengths, which has
at most ``size`` entries however many pieces there are.  Beyond ``most`` pieces
the histogram is split into equal shares: one share is packed, its well-filled
bins are repeated for all shares, and what is left is packed in the next round.
The result is a table of slots ("the pieces of length s ranked r..r+n-1 go to
bins b..b+n-1 at offset o"), and Spark ranks the pieces within each length in
two levels (salted blocks, then prefix sums), so no length is gathered in one
task, and no piece passes through the driver.

Nulls and edges: a null text counts as empty and is one piece of the end token
alone; null ids are kept; repeated rows are packed each; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerflow.llm.tokens import SPLIT, vocabulary_path
from ledgerflow.session import scratch_path

#: Beyond these characters two libraries could differ by their Unicode tables: then the vocabulary's own library is used.
_COMMON = regex.compile(r"[\x00-\x7f¡-ſ‐-‧]*")
#: The fast library fails on a run of white space of about a million characters: texts with a run of this length go to the other.
LONG_SPACE = 100_000
_SPACE = regex.compile(r"\s+")


def long_space(text: str) -> bool:
    """Whether a text has a long run of white space; each run is read once."""
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in _SPACE.finditer(text))


class Encoder:
    """Token ids of a byte-level vocabulary given as a .json file and as ranks of the same tokens."""

    def __init__(self, vocabulary: str, ranks: str):
        self.vocabulary = vocabulary_path(vocabulary)
        with open(vocabulary_path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(self.vocabulary, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
        self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT.pattern, mergeable_ranks=table, special_tokens=special)

    @functools.cached_property
    def exact(self) -> Tokenizer:
        """Loaded by the first text that needs it."""
        return Tokenizer.from_file(self.vocabulary)

    def ids(self, text: str) -> list[int]:
        if _COMMON.fullmatch(text) and not long_space(text):
            return self.fast.encode(text, allowed_special="all")
        return self.exact.encode(text, add_special_tokens=False).ids


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str, ranks: str) -> Encoder:
    if (vocabulary, ranks) not in _ENCODERS:
        _ENCODERS[vocabulary, ranks] = Encoder(vocabulary, ranks)
    return _ENCODERS[vocabulary, ranks]


def pieces(
    docs: DataFrame, size: int = 1024, end_id: int = 2, vocabulary: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken", order: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of every text: doc_id, piece, start, length, ids_crc32 (of the little-endian 32-bit ids)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary, ranks)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, t in enumerate(batch["body"]):
                ids = np.array([*enc.ids(t), end_id], dtype="<u4")
                n = len(ids)
                first = n % size or min(n, size)
                cuts = [0, *range(first, n + 1, size)]
                raw = memoryview(ids.tobytes())
                for k in range(len(cuts) - 1):
                    row.append(i)
                    piece.append(k)
                    start.append(cuts[k])
                    length.append(cuts[k + 1] - cuts[k])
                    crc.append(zlib.crc32(raw[4 * cuts[k]: 4 * cuts[k + 1]]))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].iloc[row].array, "piece": np.array(piece, dtype=np.int32),
                "start": np.array(start, dtype=np.int64), "length": np.array(length, dtype=np.int64),
                "ids_crc32": np.array(crc, dtype=np.int64),
            })

    # The id travels as text, so that a null among long ids doesn't turn them into doubles.
    body = docs.select(F.col(order).cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    out = body.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def sum_of_squares(counts: np.ndarray, size: int) -> list[list[int]]:
    """Pack counts[s] pieces of each length s, longest first; the bins as lists of lengths.

    A bin is opened only where no open one has room, which needs fewer bins
    than letting the rule weigh a new bin against the open ones.
    """
    open_bins = np.zeros(size + 1, dtype=np.int64)  # by gap; gaps 0 and size never count
    stacks: dict[int, list[list[int]]] = defaultdict(list)
    closed: list[list[int]] = []
    for s in range(size, 0, -1):
        for _ in range(int(counts[s])):
            if s == size:
                closed.append([s])
                continue
            # Change of the sum of squares: a bin leaves gap g and joins gap g - s (0: it is full and counts no more).
            have = open_bins[s:size]
            after = open_bins[0: size - s]
            change = np.where(have > 0, 2 * (after - have) + 2, np.iinfo(np.int64).max)
            change[0] = 1 - 2 * have[0] if have[0] > 0 else change[0]
            g = int(change.argmin()) + s
            if have[g - s] > 0:
                own = stacks[g].pop()
                open_bins[g] -= 1
                gap = g - s
            else:
                own, gap = [], size - s
            own.append(s)
            if gap:
                stacks[gap].append(own)
                open_bins[gap] += 1
            else:
                closed.append(own)
    return closed + [b for gap in sorted(stacks) for b in stacks[gap]]


def plan(counts: np.ndarray, size: int, most: int = 1 << 17, full: float = 0.995) -> dict[str, np.ndarray]:
    """Slots for counts[s] pieces of each length: arrays length, rank, repeat, bin, offset.

    Pieces of ``length`` ranked rank .. rank+repeat-1 go to bins bin ..
    bin+repeat-1, at ``offset``.  Bins are numbered from 0 without holes.
    """
    rest, used = counts.astype(np.int64).copy(), np.zeros(size + 1, dtype=np.int64)
    slots: list[tuple[int, int, int, int, int]] = []
    next_bin = 0

    def put(own: list[int], times: int) -> None:
        nonlocal next_bin
        at = 0
        for s in own:
            slots.append((s, int(used[s]), times, next_bin, at))
            used[s] += times
            rest[s] -= times
            at += s
        next_bin += times

    if rest[size]:
        put([size], int(rest[size]))
    while (total := int(rest.sum())) > 0:
        shares = max(1, total // most)
        while shares > 1 and not (rest // shares).any():
            shares //= 2
        bins = sum_of_squares(rest // shares, size)
        if shares > 1:
            good = [b for b in bins if sum(b) >= full * size]
            if len(good) < len(bins) // 4:  # too few well-filled ones to go on with: take them all
                good = bins
            bins = good
        for own in bins:
            put(own, shares)
    table = np.array(slots, dtype=np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return dict(zip(("length", "rank", "repeat", "bin", "offset"), table.T.copy(), strict=True))


def pack(cut: DataFrame, size: int = 1024, block: int = 4096) -> DataFrame:
    """Add sequence_id and offset to a *written* table of pieces (read twice: lengths, then ranks)."""
    spark = cut.sparkSession
    hist = cut.groupBy("length").count().collect()  # at most `size` rows
    counts = np.zeros(size + 1, dtype=np.int64)
    for r in hist:
        counts[r["length"]] = r["count"]
    slots = spark.sparkContext.broadcast(plan(counts, size))
    blocks = max(1, int(counts.sum()) // block)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    before = (
        salted.groupBy("length", "salt").count()
        .withColumn("before", F.sum("count").over(
            Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("own", F.row_number().over(inside) - 1).join(before, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("own"))
    )

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = slots.value
        shift = np.int64(1) << 42
        key = length.to_numpy(np.int64) * shift + rank.to_numpy(np.int64)
        at = np.searchsorted(t["length"] * shift + t["rank"], key, side="right") - 1
        return pd.DataFrame({
            "sequence_id": t["bin"][at] + rank.to_numpy(np.int64) - t["rank"][at], "offset": t["offset"][at]})

    return ranked.withColumn("at", placed("length", "rank")).select(*cut.columns, "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, size: int = 1024, end_id: int = 2, **options) -> DataFrame:
    """Pieces of all texts with their place: tokenised once into a written table, then packed."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"pieces-{uuid4().hex}")
    pieces(docs, size, end_id, **options).write.parquet(path)
    return pack(spark.read.parquet(path), size)
