"""Alignment of two tokenizers over the same bytes, by divide and conquer at shared cuts.

A text is encoded by a byte-level vocabulary (A, given a space and the text) and
by a piece vocabulary (B, which adds the space itself).  Where a token of A and
a token of B end at the same byte, the text is cut.  The cuts are found by
divide and conquer: near the middle token of an interval, ever wider rings of
ends of A are looked up among the ends of B by bisection until one is shared;
both halves go on alike, and an interval without a cut inside is a leaf group.
All intervals of a run of texts go through one step together.

Within the groups, every pair of an A and a B token whose byte ranges overlap is
a link.  How often each pair of ids is linked in the whole corpus is counted by
Spark; every text then gets the sum of its links' counts, and how many of its
links are the most frequent one of their B id.  The most frequent pairs (at most
``max_hot``) are broadcast, all others are joined.

Nulls and edges: texts that are null, empty, or that either vocabulary doesn't
give back byte by byte have no tokens: zeros and an empty digest; special
strings are plain text; null ids are kept; repeated rows are aligned and counted
each; an empty table stays empty; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.ctw import most_frequent
from ledgerflow.llm.packing import long_space
from ledgerflow.llm.textops import gather_ranges, runs
from ledgerflow.llm.tokens import SPLIT, _byte_letters, vocabulary_path
from ledgerflow.session import scratch_path

#: Characters that a worker encodes at a time (a longer text goes alone).
_RUN = 1 << 18
_FAR = np.iinfo(np.int64).max


class Vocabularies:
    """Both encoders, and the bytes, byte lengths and decimal digits of all their ids."""

    def __init__(self, a: str, ranks: str, b: str):
        import sentencepiece
        import tiktoken

        self.a_file = vocabulary_path(a)
        with open(vocabulary_path(ranks), "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        # The ranks file holds the same vocabulary without special tokens, so their strings are plain text.
        self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT.pattern, mergeable_ranks=table, special_tokens={})
        byte = {letter: bytes([i]) for i, letter in enumerate(_byte_letters())}
        with open(self.a_file, encoding="utf-8") as f:
            names = {i: token for token, i in json.load(f)["model"]["vocab"].items()}
        self.a_bytes = [b"".join(byte[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(b))
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode("utf-8") for i, name in enumerate(names)]
        self.a_size, self.b_size = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        self.shift = len(names).bit_length()
        self.digits = _decimal(max(len(self.a_bytes), len(self.b_bytes)))

    @functools.cached_property
    def exact(self):
        """The vocabulary's own library, for the texts on which the faster one fails."""
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(self.a_file)
        own.encode_special_tokens = True
        return own

    def ids_a(self, spaced: str) -> list[int]:
        return self.exact.encode(spaced, add_special_tokens=False).ids if long_space(spaced) else self.fast.encode_ordinary(spaced)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both vocabularies for every text; none where one of them doesn't give the text back."""
        out_a, out_b = [], []
        for text, ids_b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            spaced = " " + text
            ids_a, raw = self.ids_a(spaced), spaced.encode("utf-8")
            if not text or b"".join(map(self.b_bytes.__getitem__, ids_b)) != raw or b"".join(map(self.a_bytes.__getitem__, ids_a)) != raw:
                ids_a = ids_b = []
            out_a.append(np.array(array("i", ids_a)))
            out_b.append(np.array(array("i", ids_b)))
        return out_a, out_b


def _decimal(n: int) -> np.ndarray:
    """Row i: the decimal digits of i, left-aligned, with room for a separator."""
    numbers = [str(i).encode() for i in range(n)]
    width = len(numbers[-1]) + 1
    return np.frombuffer(b"".join(x.ljust(width) for x in numbers), dtype=np.uint8).reshape(n, width)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First A token of every group, ascending.

    ends_*: ascending byte offsets at which tokens end.  first[d]:last[d] are the
    A tokens of text d (at least one), whose last end is shared.
    """
    lo, hi, ring = first.astype(np.int64), last.astype(np.int64), np.zeros(len(first), dtype=np.int64)
    leaves = []
    while len(lo):
        leaf = hi - lo == 1
        leaves.append(lo[leaf])
        lo, hi, ring = lo[~leaf], hi[~leaf], ring[~leaf]
        if not len(lo):
            break
        # Inner ends are those of tokens lo .. hi-2.  Ring 0 is the middle one; ring r has the distances 2**(r-1) .. 2**r - 1.
        mid = (lo + hi - 2) // 2
        near, far = (1 << ring) >> 1, (1 << ring) - 1
        left = np.maximum(mid - far, lo)
        n_left = np.where(ring > 0, np.maximum(mid - near - left + 1, 0), 0)
        right = mid + near
        n_right = np.maximum(np.minimum(mid + far, hi - 2) - right + 1, 0)
        tried = gather_ranges(np.concatenate((left, right)), np.concatenate((n_left, n_right)))
        owner = np.repeat(np.tile(np.arange(len(lo)), 2), np.concatenate((n_left, n_right)))
        sought = ends_a[tried]
        hit = ends_b[np.searchsorted(ends_b, sought)] == sought
        best = np.full(len(lo), _FAR)
        np.minimum.at(best, owner[hit], 2 * np.abs(tried[hit] - mid[owner[hit]]) + (tried[hit] > mid[owner[hit]]))
        found = best < _FAR
        cut = mid[found] + np.where(best[found] & 1, best[found] >> 1, -(best[found] >> 1)) + 1
        whole = ~found & (mid - far <= lo) & (mid + far >= hi - 2)
        leaves.append(lo[whole])
        on = ~found & ~whole
        zero = np.zeros(len(cut), dtype=np.int64)
        lo, hi, ring = (np.concatenate(x) for x in (
            (lo[found], cut, lo[on]), (cut, hi[found], hi[on]), (zero, zero, ring[on] + 1)))
    return np.sort(np.concatenate(leaves)) if leaves else np.zeros(0, dtype=np.int64)


@dataclass
class Aligned:
    """Groups and links of a run of texts; ptr_*[d]:ptr_*[d+1] are text d's tokens."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    ptr_a: np.ndarray
    ptr_b: np.ndarray
    first_a: np.ndarray  # first A token of each group, and the end
    first_b: np.ndarray
    link_a: np.ndarray  # token of each link
    link_b: np.ndarray


def align_run(ids_a: list[np.ndarray], ids_b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    ptr_a, ptr_b = (np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64) for ids in (ids_a, ids_b))
    flat_a, flat_b = (np.concatenate(ids).astype(np.int64) for ids in (ids_a, ids_b))
    # Both vocabularies give every text back, so offsets of the whole run agree.
    ends_a, ends_b = np.cumsum(size_a[flat_a]), np.cumsum(size_b[flat_b])
    some = ptr_a[1:] > ptr_a[:-1]
    first_a = np.append(shared_cuts(ends_a, ends_b, ptr_a[:-1][some], ptr_a[1:][some]), len(flat_a))
    # The B token in which each A token ends; the next A token begins there too, or, at a shared end, with the next B token.
    into = np.searchsorted(ends_b, ends_a)
    onward = into + (ends_b[into] == ends_a)
    low = np.concatenate(([0], onward[:-1])) if len(onward) else onward
    first_b = np.append(low[first_a[:-1]], len(flat_b))
    links = into + 1 - low
    return Aligned(flat_a, flat_b, ptr_a, ptr_b, first_a, first_b, np.repeat(np.arange(len(flat_a)), links), gather_ranges(low, links))


def written_groups(run: Aligned, digits: np.ndarray) -> list[str]:
    """Every text's groups as ``a1,a2|b1;a3|b2,b3``."""
    n_a, n_b = len(run.ids_a), len(run.ids_b)
    count_a, count_b = np.diff(run.first_a), np.diff(run.first_b)
    group_a, group_b = (np.repeat(np.arange(len(c)), c) for c in (count_a, count_b))
    place_a = np.arange(n_a) + run.first_b[group_a]  # all tokens in written order: a group's A, then its B
    place_b = np.arange(n_b) + run.first_a[group_b + 1]
    ids = np.empty(n_a + n_b, dtype=np.int64)
    ids[place_a], ids[place_b] = run.ids_a, run.ids_b
    after = np.full(n_a + n_b, ord(","), dtype=np.uint8)
    after[place_a[run.first_a[1:] - 1]] = ord("|")
    after[place_b[run.first_b[1:] - 1]] = ord(";")
    letters = digits[ids]
    length = (letters != ord(" ")).sum(axis=1)
    letters[np.arange(len(ids)), length] = after
    text = letters[np.arange(letters.shape[1])[None, :] <= length[:, None]].tobytes().decode("ascii")
    at = np.concatenate(([0], np.cumsum(length + 1)))[run.ptr_a + run.ptr_b]
    return [text[lo: hi - 1] if hi > lo else "" for lo, hi in zip(at[:-1], at[1:], strict=True)]


def linked_pairs(run: Aligned, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs of every text, in its order: text, pair (A id << shift | B id), how many links."""
    doc = np.repeat(np.arange(len(run.ptr_a) - 1), np.diff(run.ptr_a))[run.link_a]
    pair = run.ids_a[run.link_a] << shift | run.ids_b[run.link_b]
    bits = max(1, int(pair.max(initial=0)).bit_length())  # at most 63 with the text's number: a run has few texts
    keys, times = np.unique(doc << bits | pair, return_counts=True)
    return keys >> bits, keys & ((1 << bits) - 1), times


_LOADED: dict[tuple[str, str, str], Vocabularies] = {}


def vocabularies(a: str, ranks: str, b: str) -> Vocabularies:
    """Both vocabularies, loaded once per worker."""
    if (a, ranks, b) not in _LOADED:
        _LOADED[a, ranks, b] = Vocabularies(a, ranks, b)
    return _LOADED[a, ranks, b]


def align(
    docs: DataFrame, a: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", b: str = "piece_bpe_32k.model",
    order: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every text's alignment: doc_id, n_a, n_b, n_groups, n_links, groups (string), pairs (A id << shift | B id) and
    times (links of each pair)."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a, ranks, b)
        for batch in batches:
            texts = batch.column("body").to_pylist()
            for lo, hi in runs(texts, _RUN):
                run = align_run(*both.encode(texts[lo:hi]), both.a_size, both.b_size)
                n = hi - lo
                doc, pair, times = linked_pairs(run, both.shift)
                offsets = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                group = np.searchsorted(run.first_a[:-1], run.ptr_a)
                counts = (np.diff(run.ptr_a), np.diff(run.ptr_b), np.diff(group),
                          np.bincount(doc, weights=times, minlength=n).astype(np.int64))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, n), *map(pa.array, counts),
                    pa.array(written_groups(run, both.digits), type=pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(pair)),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    body = docs.select(F.col(order).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return body.mapInArrow(
        aligned, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>")


def pair_shift(b: str = "piece_bpe_32k.model") -> int:
    """Bits of a B id in a pair."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(b)).get_piece_size().bit_length()


def pair_counts(links: DataFrame, shift: int, folder: str) -> DataFrame:
    """pair, count (links of the whole corpus), best (no pair of its B id has more), written to ``folder``."""
    spark = links.sparkSession
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    counts.write.parquet(f"{folder}/counts")
    counts = spark.read.schema("pair long, count long").parquet(f"{folder}/counts")
    own = F.col("pair").bitwiseAND((1 << shift) - 1)
    most = counts.groupBy(own.alias("b")).agg(F.max("count").alias("most"))
    marked = counts.withColumn("b", own).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    marked.write.parquet(f"{folder}/pairs")
    return spark.read.schema("pair long, count long, best boolean").parquet(f"{folder}/pairs")


def report(
    docs: DataFrame, b: str = "piece_bpe_32k.model", max_hot: int = 1 << 18, keep_groups: bool = False, **options,
) -> DataFrame:
    """Per text: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups, if kept)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, f"alignment-{uuid4().hex}")
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256))
    rows = align(docs, b=b, **options).withColumn("groups_sha256", digest)
    rows = rows if keep_groups else rows.drop("groups")
    rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/texts")
    done = spark.read.parquet(f"{folder}/texts")
    linked = done.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times").withColumnRenamed("pairs", "pair")
    pairs = pair_counts(linked, pair_shift(b), folder)
    # Bounded: at most max_hot rows.  What they don't hold is kept aside for the join.
    hot = F.broadcast(most_frequent(pairs, "count", max_hot))
    total, best = F.sum(F.col("times") * F.col("count")), F.sum(F.when(F.col("best"), F.col("times")))
    rare = F.collect_list(F.when(F.col("count").isNull(), F.struct("pair", "times")))
    linked.join(hot, "pair", "left").groupBy("row").agg(
        total.alias("sum_hot"), best.alias("best_hot"), rare.alias("rare")).write.parquet(f"{folder}/sums")
    sums = spark.read.parquet(f"{folder}/sums")
    rest = (
        sums.select("row", F.explode("rare").alias("p")).select("row", "p.pair", "p.times").join(pairs, "pair")
        .groupBy("row").agg(total.alias("sum_rest"), best.alias("best_rest"))
    )
    either = lambda x, y: F.coalesce(F.col(x), F.lit(0)) + F.coalesce(F.col(y), F.lit(0))
    return done.drop("pairs", "times").join(sums.drop("rare"), "row", "left").join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", either("best_hot", "best_rest").alias("n_best"),
        either("sum_hot", "sum_rest").alias("count_sum"), "groups_sha256", *(["groups"] if keep_groups else []))
