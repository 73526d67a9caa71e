"""Document fingerprints: bottom-k sketches of word shingles.

A sketch holds the k smallest distinct 48-bit hashes of a text's shingles (five
words; a shorter text has one shingle, all its words).  Sketches of parts merge
into the sketch of the whole (union, then the k smallest again), and estimate
how many distinct shingles there are, how alike two texts are (resemblance) and
how much of one lies in the other (containment).  A text with fewer than k
shingles is held exactly, and so are its figures.

Nulls and edges: a null text counts as empty; a text without words has an empty
sketch (""), which is alike 1.0 to another empty sketch and 0.0 to all others.
Ties of the order key are ordered by text, repeated rows are neighbours of each
other, a null order key comes first, and in a one-row table the row is its own
successor.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.textops import runs, shingles, words

BITS = 48


def sketches(texts: list[str], k: int = 128, shingle: int = 5) -> list[np.ndarray]:
    """The sorted k smallest distinct shingle hashes of every text."""
    out = []
    for lo, hi in runs(texts):
        h, ptr = shingles(words(texts[lo:hi]), shingle)
        h = h >> np.uint64(64 - BITS)
        for a, b in zip(ptr[:-1], ptr[1:], strict=True):
            own, width = h[a:b], k
            # Repeats may fill the smallest places: widen until k distinct ones are found.
            while width < b - a and len(small := np.unique(np.partition(own, width)[:width])) < k:
                width *= 2
            out.append((np.unique(own) if width >= b - a else small)[:k])
    return out


def encode(sketch: np.ndarray) -> str:
    """A sketch as text: its hashes as big-endian 6-byte numbers, in base64."""
    wide = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)
    return base64.b64encode(wide[:, 2:].tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = 128) -> np.ndarray:
    """Sketch of the union of two shingle sets."""
    return np.union1d(a, b)[:k]


def distinct(a: np.ndarray, k: int = 128) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = 128) -> float:
    """Estimated Jaccard similarity of two shingle sets; exact if both have fewer than k."""
    if len(a) == 0 or len(b) == 0:
        return 1.0 if len(a) == len(b) else 0.0
    both = np.concatenate((a, b))
    both.sort()
    twice = both[1:] == both[:-1]
    if len(a) < k and len(b) < k:
        return float(twice.sum()) / (len(both) - int(twice.sum()))
    first = np.concatenate(([True], ~twice))
    at = np.flatnonzero(first)[:k]  # places of the smallest distinct hashes of the union
    return float(np.count_nonzero(np.concatenate((twice, [False]))[at])) / len(at)


def containment(a: np.ndarray, b: np.ndarray, k: int = 128) -> float:
    """Estimated share of a's shingles that b has too."""
    if len(a) == 0:
        return 1.0
    if len(a) < k and len(b) < k:
        return len(np.intersect1d(a, b, assume_unique=True)) / len(a)
    union = distinct(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct(a, k))


def fingerprint(docs: DataFrame, k: int = 128, shingle: int = 5, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``, the encoded sketch of every whole text."""

    @F.pandas_udf("string")
    def sketched(texts: pd.Series) -> pd.Series:
        return pd.Series([encode(s) for s in sketches(list(texts), k, shingle)], dtype=object)

    return docs.withColumn("fingerprint", sketched(F.coalesce(F.col(text), F.lit(""))))


def with_successor(docs: DataFrame, order: str, text: str, make, schema: str) -> DataFrame:
    """Apply ``make(ids, texts, carried)`` to runs of rows in order of ``order``, each run ending in a row to look at only.

    Rows are dealt by value ranges of the order key, one range per partition,
    and sorted there.  The first row of each range also goes to the range
    before it, the very first to the last, so every row meets its successor in
    its own partition and each text is shuffled once.  What the driver sees is
    one number per partition.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.col(order).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    keyed = keyed.withColumn("key", F.coalesce("id", F.lit(-(1 << 63))))
    cuts = keyed.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("c")).first()["c"]
    bounds = np.unique(np.array(cuts or [], dtype=np.int64)) if parts > 1 else np.zeros(0, dtype=np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(np.int64), side="left").astype(np.int32))

    dealt = keyed.withColumn("part", place("key")).withColumn("extra", F.lit(0))
    heads = sorted((r["part"], r["key"]) for r in dealt.groupBy("part").agg(F.min("key").alias("key")).collect())
    if not heads:
        return spark.createDataFrame([], schema)
    back = [(heads[i][1], heads[i - 1][0]) for i in range(len(heads))]
    goes = spark.createDataFrame(back, "key long, part int")
    again = (
        keyed.join(F.broadcast(goes), "key").groupBy("part", "key")
        .agg(F.min("body").alias("body"))
        .select(F.lit(None).cast("long").alias("id"), "body", "key", "part", F.lit(1).alias("extra"))
    )
    spread = dealt.unionByName(again).repartitionById(len(bounds) + 1, F.col("part"))
    ordered = spread.sortWithinPartitions("part", "extra", "key", "body").select("key", F.col("id").isNull().alias("missing"), "body", "part")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = None, None  # the row that waits for its successor, and its part
        for batch in batches:
            ids = [None if gone else key for key, gone in zip(batch["key"].tolist(), batch["missing"].tolist(), strict=True)]
            texts = batch["body"].tolist()
            for lo, hi in runs(texts, 1 << 22):
                at, end = lo, hi
                while at < end:  # parts are whole runs of rows
                    part = batch["part"].iat[at]
                    stop = at + int(np.searchsorted(batch["part"].to_numpy()[at:end], part, side="right"))
                    if last != part:
                        held, last = None, part
                    run_ids, run_texts = ids[at:stop], texts[at:stop]
                    if held is not None:
                        run_ids, run_texts = [held[0], *run_ids], [held[1], *run_texts]
                    out, carried = make(run_ids, run_texts, held[2] if held is not None else None)
                    held = (run_ids[-1], run_texts[-1], carried)
                    if len(out):
                        yield out
                    at = stop

    return ordered.mapInPandas(stream, schema)


def edited(text: str, successor: str) -> str:
    """The last half of the text (rounded down) replaced by the start of its successor."""
    m = len(text) // 2
    return text[: len(text) - m] + successor[:m]


def neighbour_report(docs: DataFrame, k: int = 128, shingle: int = 5, order: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_shingles (estimate), next_containment (share of
    this text's shingles in the next).
    """

    def make(ids, texts, carried):
        # All but the last row have their successor here; the first one's sketch may be known already.
        own = ([carried] if carried is not None else []) + sketches(texts[1 if carried is not None else 0:], k, shingle)
        n = len(texts) - 1
        changed = [edited(texts[i], texts[i + 1]) for i in range(n)]
        theirs = sketches(changed, k, shingle)
        return pd.DataFrame({
            "doc_id": pd.array(ids[:n], dtype="Int64") if n else pd.array([], dtype="Int64"),
            "n_chars": [len(t) for t in texts[:n]],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed],
            "fingerprint": [encode(s) for s in own[:n]],
            "edited_fingerprint": [encode(s) for s in theirs],
            "near_edited": [resemblance(own[i], theirs[i], k) for i in range(n)],
            "near_next": [resemblance(own[i], own[i + 1], k) for i in range(n)],
            "n_shingles": [distinct(s, k) for s in own[:n]],
            "next_containment": [containment(own[i], own[i + 1], k) for i in range(n)],
        }), own[-1]

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_shingles double, next_containment double"
    )
    return with_successor(docs, order, text, make, schema)
