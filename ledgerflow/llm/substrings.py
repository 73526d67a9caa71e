"""Substring dedup over a sparse de Bruijn graph of word k-mers.

Every window of ``window`` words names one of its k-mers, the one with the
least hash, as an edge of the graph; equal windows name the same edge at the
same place, so all repeats of a window meet at one edge, and only about one
k-mer in (window - k) / 2 is kept.  Edges of a single document drop out.

At a repeated edge, occurrences are compacted by what surrounds them: an
occurrence's path is the run of words that all windows through the edge can
reach.  Where all occurrences have one path the edge does not branch, and one
join with the path's least document decides all windows through it.  Where
paths branch, only one representative per path (those in its least document)
is opened into single windows, whose hashes meet in a second, word-level join.
Edges and windows carry their source coordinates (document, word), and two
independent hashes (64 and 64 bits for paths, 64 and 32 for windows) must agree.

A window that also starts in a document with a smaller id is repeated; the
words under repeated windows are removed from the later document.  Decisions
use the input, never what is left.

Nulls and edges: a null text counts as empty (no words); texts shorter than a
window keep all words; a null id counts as the largest; rows with equal ids are
never each other's source; repeated rows get equal results; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.textops import WORD_BASES, gather_ranges, mix64, range_hash, runs, signed, words
from ledgerflow.session import scratch_path

LAST = (1 << 63) - 1


def _sliding(values: np.ndarray, width: int, reduce) -> np.ndarray:
    """reduce over values[i:i+width] for every i that has room, in log2(width) steps."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have, reach = values, 1
    while reach * 2 <= width:
        have = reduce(have[:-reach], have[reach:])
        reach *= 2
    return reduce(have[:n], have[width - reach: width - reach + n])


def named_edges(ptr: np.ndarray, kmer: np.ndarray, k: int, window: int) -> np.ndarray:
    """Positions whose k-mer has the least hash of some window of its document."""
    count, n = window - k + 1, int(ptr[-1])
    if n < window:
        return np.zeros(0, dtype=np.int64)
    least = _sliding(kmer, count, np.minimum)  # by window start
    end = np.repeat(ptr[1:], np.diff(ptr))
    whole = np.arange(len(least)) + window <= end[: len(least)]
    least = np.where(whole, least, np.uint64(0))  # windows across two documents name nothing
    padded = np.concatenate((np.zeros(count - 1, dtype=np.uint64), least, np.zeros(count - 1, dtype=np.uint64)))
    reached = _sliding(padded, count, np.maximum)[: len(kmer)]  # over the windows that hold the k-mer
    return np.flatnonzero((reached == kmer[: len(reached)]) & (reached > 0))


def edges_of(texts: list[str], k: int, window: int) -> dict[str, np.ndarray]:
    """Named edges: doc (index), at (word), lo and hi (first and last window start through it), edge, and two path hashes."""
    out: dict[str, list[np.ndarray]] = {c: [] for c in ("doc", "at", "lo", "hi", "edge", "path1", "path2")}
    for a, b in runs(texts):
        w = words(texts[a:b])
        n = len(w.hashes)
        if n < window:
            continue
        starts = np.arange(n - k + 1)
        kmer = mix64(range_hash(w.hashes, starts, starts + k, WORD_BASES[0])) | np.uint64(1)
        at = named_edges(w.ptr, kmer, k, window)
        doc = np.searchsorted(w.ptr, at, side="right") - 1
        first, last = w.ptr[doc], w.ptr[doc + 1]
        lo = np.maximum(at - (window - k), first)
        hi = np.minimum(at, last - window)
        left = (at - lo).astype(np.uint64)  # equal paths hold the edge at the same place
        out["doc"].append(doc + a)
        out["at"].append(at - first)
        out["lo"].append(lo - first)
        out["hi"].append(hi - first)
        out["edge"].append(kmer[at])
        out["path1"].append(mix64(range_hash(w.hashes, lo, hi + window, WORD_BASES[0]) ^ left))
        out["path2"].append(mix64(range_hash(w.hashes, lo, hi + window, WORD_BASES[1]) ^ left))
    return {c: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for c, v in out.items()}


def window_hashes(body: str, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    h = words([body]).hashes
    return tuple(mix64(range_hash(h, starts, starts + window, base)) for base in WORD_BASES)


def _covered(n: int, lo: np.ndarray, hi: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie under windows that start in lo..hi."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, np.minimum(hi + window, n), -1)
    return np.cumsum(step)[:n] > 0


def _report(doc_id, body: str, covered: np.ndarray | None) -> tuple:
    own = body.encode("utf-8").split()  # bytes.split() splits at the six white space bytes
    kept = own if covered is None else [w for w, gone in zip(own, covered.tolist(), strict=True) if not gone]
    return doc_id, len(own), len(own) - len(kept), b" ".join(kept).decode("utf-8")


def remove_repeats(
    docs: DataFrame, window: int = 50, k: int = 12, order: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space), kept_sha256."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.coalesce(F.col(order).cast("long"), F.lit(LAST)).alias("id"), F.hash(body).alias("tag"), body.alias("body"))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            e = edges_of(batch["body"].tolist(), k, window)
            yield pd.DataFrame({
                "id": batch["id"].to_numpy()[e["doc"]], "tag": batch["tag"].to_numpy()[e["doc"]],
                "lo": e["lo"].astype(np.int32), "hi": e["hi"].astype(np.int32),
                "edge": signed(e["edge"]), "path1": signed(e["path1"]), "path2": signed(e["path2"]),
            })

    edges_path = scratch_path(spark, f"edges-{uuid4().hex}")
    base.mapInPandas(emit, "id long, tag int, lo int, hi int, edge long, path1 long, path2 long").write.parquet(edges_path)
    edges = spark.read.parquet(edges_path)

    # Edges of one document alone drop out; a hot edge meets in map-side minima first.
    # The list is written, so that the join deals both sides anew and can split a hot edge.
    many_path = scratch_path(spark, f"many-{uuid4().hex}")
    (edges.groupBy("edge").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("edge")
     .write.parquet(many_path))
    many = spark.read.parquet(many_path)
    repeated_path = scratch_path(spark, f"repeated-{uuid4().hex}")
    edges.join(many, "edge", "left_semi").write.parquet(repeated_path)
    repeated = spark.read.parquet(repeated_path)
    paths = repeated.groupBy("edge", "path1", "path2").agg(F.min("id").alias("first"))
    branching = paths.groupBy("edge").agg(F.count("*").alias("paths")).where("paths > 1").withColumn("branches", F.lit(True)).drop("paths")
    known = paths.join(branching, "edge", "left").select("path1", "path2", "edge", "first", F.coalesce("branches", F.lit(False)).alias("branches"))
    decided = (
        repeated.join(known, ["edge", "path1", "path2"])
        .where((F.col("id") > F.col("first")) | F.col("branches"))
        .select("id", "tag", F.struct("lo", "hi", (F.col("id") > F.col("first")).alias("gone")).alias("reach"))
    )
    # What is decided or open in a document is bounded by the document.
    per_doc = decided.groupBy("id", "tag").agg(F.collect_set("reach").alias("reaches"))
    joined = base.join(per_doc, ["id", "tag"], "left")

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, tag, text_, reaches in zip(batch["id"], batch["tag"], batch["body"], batch["reaches"], strict=True):
                if reaches is None or len(reaches) == 0:
                    rows.append((doc_id, tag, *_report(doc_id, text_, None)[1:], None, None, None, None))
                    continue
                lo, hi, gone = (np.array([r[c] for r in reaches]) for c in ("lo", "hi", "gone"))
                n = len(text_.encode("utf-8").split())
                starts = np.zeros(n + 1, dtype=bool)  # windows known to be repeated
                starts[gather_ranges(lo[gone], hi[gone] - lo[gone] + 1)] = True
                open_ = np.zeros(n + 1, dtype=bool)
                open_[gather_ranges(lo[~gone], hi[~gone] - lo[~gone] + 1)] = True
                ask = np.flatnonzero(open_ & ~starts)
                sure = np.flatnonzero(starts).astype(np.int32)
                if len(ask):
                    h1, h2 = window_hashes(text_, ask, window)
                    rows.append((doc_id, tag, n, 0, text_, sure, ask.astype(np.int32), signed(h1), (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                else:
                    rows.append((doc_id, tag, *_report(doc_id, text_, _covered(n, sure, sure, window))[1:], None, None, None, None))
            yield pd.DataFrame(rows, columns=["id", "tag", "n_words", "n_removed", "body", "sure", "ask", "h1", "h2"])

    settled_path = scratch_path(spark, f"settled-{uuid4().hex}")
    (
        joined.mapInPandas(settle, "id long, tag int, n_words long, n_removed long, body string, sure array<int>, ask array<int>, h1 array<long>, h2 array<int>")
        .withColumn("row", F.monotonically_increasing_id()).write.parquet(settled_path)
    )
    settled = spark.read.parquet(settled_path)
    asked = settled.where(F.col("ask").isNotNull())
    windows = asked.select("id", "row", F.explode(F.arrays_zip("ask", "h1", "h2")).alias("w")).select(
        "id", "row", F.col("w.ask").alias("at"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    firsts = windows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("most")).where("first < most").drop("most")
    later = (
        windows.join(firsts, ["h1", "h2"]).where(F.col("id") > F.col("first"))
        .groupBy("row").agg(F.collect_list("at").alias("more"))
    )

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, n, text_, sure, more in zip(batch["id"], batch["n_words"], batch["body"], batch["sure"], batch["more"], strict=True):
                at = np.concatenate((np.asarray(sure, dtype=np.int64), np.asarray(more if more is not None else [], dtype=np.int64)))
                rows.append(_report(doc_id, text_, _covered(int(n), at, at, window)))
            yield pd.DataFrame(rows, columns=["id", "n_words", "n_removed", "body"])

    reopened = asked.select("row", "id", "n_words", "body", "sure").join(later, "row", "left").mapInPandas(
        finish, "id long, n_words long, n_removed long, body string")
    done = settled.where(F.col("ask").isNull()).select("id", "n_words", "n_removed", "body")
    return done.unionByName(reopened).select(
        F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "n_words", "n_removed", F.col("body").alias("kept"),
        F.sha2("body", 256).alias("kept_sha256"))
