"""LM scoring by context-tree weighting.

Every byte of a text (ASCII letters in lower case, then one end symbol, the
byte 0xFF that UTF-8 never has) is decomposed into eight binary decisions.  For
each context (the last 0 to 6 bytes; 0xFF before the start) and each decision
the corpus gives counts of zeros and ones.  A node's Krichevsky-Trofimov
estimate is weighted against the product over its longer contexts, from the
longest to the empty one, and the predictive probability of a bit mixes the
estimates of all depths with the resulting posterior weights.  A path ends at
the longest context in which the corpus met the decision; that node has no
child on the path and answers by its own estimate.  The code length of a text
is the sum over its bytes.

Nothing is capped: the counts are those of all grams (six bytes and the next)
of the whole corpus, summed by Spark, and the model is a table of the same
rows.  Grams that only held-out texts have stand in it with count zero, so
every gram of every text has its row.  The grams of one three-byte context lie
together (up to 2**32 of them, for the four bytes that follow; a hot context
is not split further); their part of the tree is weighted in the tasks, sorted, group after group.  What the driver holds are
the nodes of contexts of two bytes and less, at most 2**16 * 255.

Texts find their grams in a broadcast table of the ``max_grams`` most frequent
ones, and by a join for all others; both hold the same values.

Beside it stands a word unigram with add-one smoothing (``base_score``): the
counts of words are looked up in a broadcast table of the ``max_hot`` most
frequent words, and by a join for all others.  Words are known by 64-bit hash.

Nulls and edges: a null text counts as empty, whose only token is the end; a
null id is a document like others; repeated rows are counted and scored each; an
empty table gives an empty result; without training texts every decision is
even; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.textops import log_gamma, mix64, runs, signed, words
from ledgerflow.session import scratch_path

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Bytes of the longest context, and of the contexts whose part of the tree one task weighs whole.
DEPTH, GROUP = 6, 3
#: Key of the end token among the word hashes.
END_WORD = np.int64(0)
BYTES, WORDS = 0, 1


def gram_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Context << 8 | next byte of every position (the nearest byte of the context lowest), and its document."""
    raw = [t.encode("utf-8").translate(LOWER) for t in texts]
    start = b"\xff" * DEPTH
    data = np.frombuffer(start + start.join(raw) + b"\xff", dtype=np.uint8)
    lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    n = len(data) - DEPTH
    keys = np.zeros(n, dtype=np.int64)
    for i in range(DEPTH + 1):
        keys <<= 8
        keys |= data[i: i + n]
    # Between two documents stand DEPTH bytes: the end of the first, then the rest of the second one's start.
    before = np.cumsum(lengths + DEPTH - 1) - (lengths + DEPTH - 1)
    doc = np.repeat(np.arange(len(raw)), lengths)
    at = np.repeat(before - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return keys[at], doc


def _tally(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum both counts of equal keys; the list is emptied, so that its parts go before the sort."""
    keys, train, every = (np.concatenate([part[i] for part in parts]) for i in range(3))
    parts.clear()
    if not len(keys):
        return keys, train, every
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(train[order], first), np.add.reduceat(every[order], first)


def _tallied(keys: np.ndarray, train: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, n = np.unique(keys, return_counts=True)
    return keys, n if train else np.zeros_like(n), n


def corpus_counts(docs: DataFrame, text: str = "body", held: str = "held_out", most: int = 1 << 22) -> DataFrame:
    """kind, key, n, seen: counts of grams, and of words and ends, in training texts (n) and in all (seen).

    Words are counted in training texts alone.  A task holds about
    ``most`` keys and sends its sums on when three quarters of that are different ones.
    """
    def rows(kind: int, sums: tuple) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(sums[0]), 1 << 17):
            key, n, seen = (pa.array(x[lo: lo + (1 << 17)].astype(np.int64, copy=False)) for x in sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), kind, dtype=np.int32)), key, n, seen], names=["kind", "key", "n", "seen"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back = {BYTES: [], WORDS: []}  # of each kind the sums so far, then what is not yet added to them

        def add(kind: int, part: tuple) -> Iterator[pa.RecordBatch]:
            parts = held_back[kind]
            parts.append(part)
            if sum(len(p[0]) for p in parts) > most:
                parts[:] = [_tally(parts)]
                if 4 * len(parts[0][0]) > 3 * most:
                    yield from rows(kind, parts.pop())

        for batch in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
            for train in (True, False):
                texts = [t for t, out in zip(batch[text].to_pylist(), batch[held].to_pylist(), strict=True) if out != train]
                for lo, hi in runs(texts, 1 << 19):
                    yield from add(BYTES, _tallied(gram_keys(texts[lo:hi])[0], train))
                    if train:
                        yield from add(WORDS, _tallied(signed(words([_lower(t) for t in texts[lo:hi]]).hashes), True))
                if train and texts:
                    ends = np.array([len(texts)])
                    yield from add(WORDS, (np.array([END_WORD]), ends, ends))
        for kind, parts in held_back.items():
            if parts:
                yield from rows(kind, _tally(parts))

    counted = docs.select(text, held).mapInArrow(count, "kind int, key long, n long, seen long")
    # Tasks have summed already; a second map-side sum would only hold the same keys again.
    return counted.repartition("kind", "key").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


_ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def _ascii_lower(text: str) -> str:
    return text.translate(_ASCII_LOWER)


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else _ascii_lower(text)


# --- the tree ---------------------------------------------------------------
# A node is a context and one of its 255 decisions (1 is the first bit), context << 8 | decision.

_HALF = float(2 * log_gamma(np.array([0.5]))[0])


#: ln Gamma(c + 1/2) and ln Gamma(c + 1) of small counts c, which nearly all nodes have.
_HALVES, _WHOLES = log_gamma(np.arange(4096) + 0.5), log_gamma(np.arange(4096) + 1.0)


def _log_gamma(counts: np.ndarray, plus: float, small: np.ndarray) -> np.ndarray:
    out = small[np.minimum(counts, len(small) - 1).astype(np.int64)]
    large = counts >= len(small)
    out[large] = log_gamma(counts[large] + plus)
    return out


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Block probability of the counts under the Krichevsky-Trofimov estimate."""
    return _log_gamma(zeros, 0.5, _HALVES) + _log_gamma(ones, 0.5, _HALVES) - _log_gamma(zeros + ones, 1, _WHOLES) - _HALF


@dataclass
class Nodes:
    """Nodes of one depth: their counts, the sum of ln P_w over their children, and each one's place among its parents."""

    ids: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    below: np.ndarray | None = None  # None: the deepest
    up: np.ndarray | None = None

    def __post_init__(self) -> None:
        kt = _log_kt(self.zeros, self.ones)
        self.seen = self.zeros + self.ones > 0
        self.estimate = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        if self.below is None:
            self.weighted, self.own = kt, np.ones(len(kt))
        else:
            self.weighted = math.log(0.5) + np.logaddexp(kt, self.below)
            self.own = 1 / (1 + np.exp(np.clip(self.below - kt, -700, 700)))  # posterior weight of its own estimate

    def through(self, at, lower: np.ndarray, lower_seen: np.ndarray) -> np.ndarray:
        """Mixed probability of a one at nodes ``at``, given that of the next longer context."""
        own, estimate = self.own[at], self.estimate[at]
        return np.where(lower_seen, own * estimate + (1 - own) * lower, estimate)


def _parents(nodes: Nodes, depth: int) -> Nodes:
    """The nodes of ``depth``, one less than that of ``nodes``."""
    ids, nodes.up = np.unique((((nodes.ids >> 8) & ((1 << 8 * depth) - 1)) << 8) | (nodes.ids & 0xFF), return_inverse=True)
    total = lambda x: np.bincount(nodes.up, weights=x, minlength=len(ids))
    return Nodes(ids, total(nodes.zeros), total(nodes.ones), total(nodes.weighted))


_LEVEL = np.arange(8)


def _decisions(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions on the way to each byte, and the bit taken at each."""
    byte = byte[:, None]
    return (1 << _LEVEL) | (byte >> (8 - _LEVEL)), (byte >> (7 - _LEVEL)) & 1


def _weigh(keys: np.ndarray, n: np.ndarray) -> tuple[list[Nodes], np.ndarray, np.ndarray]:
    """Nodes of the depths DEPTH to GROUP over whole groups of grams; the node and bit of every gram's decisions."""
    decision, bit = _decisions(keys & 0xFF)
    ids, at = np.unique(((keys >> 8 << 8)[:, None] | decision).ravel(), return_inverse=True)
    at, times = at.reshape(-1), np.repeat(n.astype(np.float64), 8)
    ones = np.bincount(at, weights=times * bit.ravel(), minlength=len(ids))
    levels = [Nodes(ids, np.bincount(at, weights=times, minlength=len(ids)) - ones, ones)]
    for depth in range(DEPTH - 1, GROUP - 1, -1):
        levels.append(_parents(levels[-1], depth))
    return levels, at, bit


@dataclass
class Top:
    """The nodes of contexts of two bytes and less, as what they make of the probability q given by three bytes."""

    ids: np.ndarray  # two-byte nodes, sorted
    base: np.ndarray  # base + slope * q if the three-byte node was seen
    slope: np.ndarray
    last: np.ndarray  # if it was not
    short: np.ndarray  # by one-byte node, if the two-byte one was not seen

    def mix(self, ids: np.ndarray, q: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """ids: nodes of any longer context."""
        two = ids & 0xFFFFFF
        at = np.minimum(np.searchsorted(self.ids, two), max(0, len(self.ids) - 1))
        known = self.ids[at] == two if len(self.ids) else np.zeros(len(two), dtype=bool)
        out = self.short[ids & 0xFFFF]
        at = at[known]
        out[known] = np.where(seen[known], self.base[at] + self.slope[at] * q[known], self.last[at])
        return out


def top_of(ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> Top:
    """From the two-byte nodes that were seen."""
    order = np.argsort(ids)
    two = Nodes(ids[order], zeros[order], ones[order], below[order])

    def dense(nodes: Nodes, to: np.ndarray, size: int) -> Nodes:
        total = lambda x: np.bincount(to, weights=x, minlength=size).astype(np.float64)
        return Nodes(np.arange(size), total(nodes.zeros), total(nodes.ones), total(nodes.weighted))

    one = dense(two, two.ids & 0xFFFF, 1 << 16)
    root = dense(one, one.ids & 0xFF, 1 << 8)
    whole = lambda node, p: root.through(node & 0xFF, one.through(node & 0xFFFF, p, True), one.seen[node & 0xFFFF])
    base = whole(two.ids, two.own * two.estimate)
    return Top(two.ids, base, whole(two.ids, two.own * two.estimate + 1 - two.own) - base, whole(two.ids, two.estimate),
               root.through(one.ids & 0xFF, one.estimate, one.seen))


def log_probabilities(keys: np.ndarray, n: np.ndarray, top: Top) -> np.ndarray:
    """log10 probability of the last byte of every gram, given whole groups of grams with their counts."""
    levels, at, bit = _weigh(keys, n)
    deepest = levels[0]
    q, seen, place = deepest.estimate, deepest.seen, np.arange(len(deepest.ids))
    for lower, nodes in zip(levels, levels[1:], strict=False):
        place = lower.up[place]
        q, seen = nodes.through(place, q, seen), nodes.seen[place]
    p = top.mix(deepest.ids, q, seen)[at].reshape(-1, 8)
    return np.log10(np.where(bit, p, 1 - p)).sum(axis=1)


def _whole_groups(batches: Iterator[pd.DataFrame], least: int = 1 << 16) -> Iterator[pd.DataFrame]:
    """Rows ordered by group, in frames of at least ``least`` rows that end where a group ends."""
    held, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch)
        if size >= least:
            rows = pd.concat(held, ignore_index=True)
            group = rows["group"].to_numpy()
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield rows.iloc[:cut]
            held, size = [rows.iloc[cut:]], len(rows) - cut
            least = max(least, 2 * size) if not cut else 1 << 16
    if size:
        yield pd.concat(held, ignore_index=True)


def _columns(df: DataFrame) -> list[np.ndarray]:
    """The columns of a table of bounded size, sent to the driver as Arrow."""
    return [c.to_numpy() for c in df.toArrow().columns]


def gram_model(grams: DataFrame, folder: str) -> DataFrame:
    """key, seen, log_p of every gram (key, n, seen), written to ``folder``."""
    spark = grams.sparkSession
    group = F.shiftright("key", 8).bitwiseAND((1 << 8 * GROUP) - 1)
    grouped = grams.select("key", "n", "seen", group.alias("group")).repartition("group").sortWithinPartitions("group")

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_groups(batches):
            nodes = _weigh(rows["key"].to_numpy(), rows["n"].to_numpy())[0][-1]
            yield pd.DataFrame({"id": nodes.ids & 0xFFFFFF, "zeros": nodes.zeros, "ones": nodes.ones, "below": nodes.weighted})[nodes.seen]

    two = (
        grouped.mapInPandas(weigh, "id long, zeros double, ones double, below double")
        .groupBy("id").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below")))
    )
    top = spark.sparkContext.broadcast(top_of(*_columns(two)))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_groups(batches):
            keys = rows["key"].to_numpy()
            yield pd.DataFrame({"key": keys, "seen": rows["seen"].to_numpy(), "log_p": log_probabilities(keys, rows["n"].to_numpy(), top.value)})

    grouped.mapInPandas(finish, "key long, seen long, log_p double").write.parquet(folder)
    return spark.read.schema("key long, seen long, log_p double").parquet(folder)


class GramTable:
    """Hashed look-up of the most frequent grams: the first taker of a slot has it, the next ones a slot of a second
    table; the few that find neither are left to the join."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        """keys: the most frequent first."""
        self.tables = []
        for shift, bits in ((0, 2), (29, 1)):
            size = 1 << max(1, int(len(keys)).bit_length() + bits - 1)
            slot = self._slot(keys, shift, size)
            taken, first = np.unique(slot, return_index=True)
            table, value = np.full(size, -1, dtype=np.int64), np.zeros(size)
            table[taken], value[taken] = keys[first], values[first]
            self.tables.append((shift, table, value))
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]

    @staticmethod
    def _slot(keys: np.ndarray, shift: int, size: int) -> np.ndarray:
        return ((mix64(keys.view(np.uint64)) >> np.uint64(shift)) & np.uint64(size - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none), and the places without one."""
        out, left = np.zeros(len(keys)), np.arange(len(keys))
        for shift, table, value in self.tables:
            sought = keys[left]
            slot = self._slot(sought, shift, len(table))
            hit = table[slot] == sought
            out[left[hit]] = value[slot[hit]]
            left = left[~hit]
        return out, left


_TABLE: dict[str, GramTable] = {}


def _table(name: str, keys: np.ndarray, values: np.ndarray) -> GramTable:
    """The table of grams, built once per worker and model."""
    if name not in _TABLE:
        _TABLE.clear()
        _TABLE[name] = GramTable(keys, values)
    return _TABLE[name]


def _lists(values: np.ndarray, doc: np.ndarray, n: int) -> list[np.ndarray]:
    """values of each of n documents; doc ascends."""
    return np.split(values, np.searchsorted(doc, np.arange(1, n)))


def held_out(order: str = "doc_id", modulus: int = 7, remainder: int = 2):
    return F.crc32(F.coalesce(F.col(order).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """Rows with the largest counts, at most ``most``: all from the lowest eighth of a power of two that fits."""
    step = F.floor(F.log2(F.col(n)) * 8)  # null, and so left out, for a count of zero
    sizes = sorted(((r["step"], r["count"]) for r in counts.where(F.col(n) > 0).groupBy(step.alias("step")).count().collect()), reverse=True)
    least, total = None, 0
    for value, size in sizes:
        if (total := total + size) > most:
            break
        least = value
    return counts.where(F.lit(False) if least is None else step >= least)


def score(
    docs: DataFrame, max_grams: int = 1 << 21, max_hot: int = 1 << 18, order: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Scores of all whole texts under a model of those that are not held out.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, n_bytes (with the end symbol), bits_per_byte (code length per byte).
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col(order).alias("doc_id"), held_out(order).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    counts_path = scratch_path(spark, f"ctw-counts-{uuid4().hex}")
    corpus_counts(base).write.partitionBy("kind").parquet(counts_path)
    counts = spark.read.schema("key long, n long, seen long, kind int").parquet(counts_path)
    grams, vocabulary = counts.where(F.col("kind") == BYTES), counts.where(F.col("kind") == WORDS)
    ends = F.sum(F.when(F.col("key") == F.lit(int(END_WORD)), F.col("n")))
    total = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(ends, F.lit(0)).alias("ends")).first()
    n_all, n_distinct, n_ends = int(total["n"]), int(total["v"]), int(total["ends"])

    tree = gram_model(grams, scratch_path(spark, f"ctw-model-{uuid4().hex}"))
    gram, seen, log_p = _columns(most_frequent(tree, "seen", max_grams).select("key", "seen", "log_p"))
    by_count = np.lexsort((gram, -seen))
    word, times = _columns(most_frequent(vocabulary, "n", max_hot).select("key", "n"))
    by_key = np.argsort(word)
    model = spark.sparkContext.broadcast((gram[by_count], log_p[by_count], word[by_key], times[by_key]))
    name, log_all = uuid4().hex, math.log10(n_all + 1 * (n_distinct + 1))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, log_p, keys, n = model.value
        table = _table(name, frequent, log_p)
        logs = np.concatenate((np.log10(n + 1.0), [0.0]))
        for batch in batches:
            texts = batch["body"].tolist()
            for lo, hi in runs(texts):
                part = texts[lo:hi]
                w = words([_lower(t) for t in part])
                h, doc = signed(w.hashes), w.doc()
                at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
                known = keys[at] == h if len(keys) else np.zeros(len(h), dtype=bool)
                gram, gram_doc = gram_keys(part)
                value, left = table.find(gram)
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[lo:hi].array, "held_out": batch["held_out"].iloc[lo:hi].array,
                    "n_tokens": np.diff(w.ptr) + 1,
                    "n_hot": np.bincount(doc[known], minlength=len(part)) + int(n_ends > 0),
                    "log_hot": np.bincount(doc, weights=np.where(known, logs[at], 0.0), minlength=len(part))
                    + math.log10(n_ends + 1),
                    "score": np.bincount(gram_doc, weights=value, minlength=len(part)),
                    "n_bytes": [len(t.encode("utf-8")) + 1 for t in part],
                    "rare": _lists(h[~known], doc[~known], len(part)),
                    "grams": _lists(gram[left], gram_doc[left], len(part)),
                })

    schema = ("doc_id string, held_out boolean, n_tokens long, n_hot long, log_hot double, score double, n_bytes long,"
              " rare array<long>, grams array<long>")
    scored_path = scratch_path(spark, f"ctw-scored-{uuid4().hex}")
    (base.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(scored, schema)
     .withColumn("row", F.monotonically_increasing_id()).write.parquet(scored_path))
    done = spark.read.parquet(scored_path)
    # No hot word is among these, so no key is large; words unknown to the model have no partner and add log10(1).
    rare = (
        done.select("row", F.explode("rare").alias("key")).join(vocabulary.select("key", "n"), "key")
        .groupBy("row").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("n") + 1)).alias("log_rare"))
    )
    # Every gram has a partner.
    rest = (
        done.select("row", F.explode("grams").alias("key")).join(tree.select("key", "log_p"), "key")
        .groupBy("row").agg(F.sum("log_p").alias("log_rest"))
    )
    zero, total_score = F.lit(0), F.col("score") + F.coalesce("log_rest", F.lit(0.0))
    return done.drop("rare", "grams").join(rare, "row", "left").join(rest, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens",
        (F.col("n_hot") + F.coalesce("n_rare", zero)).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("log_hot") + F.coalesce("log_rare", F.lit(0.0)) - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        total_score.alias("score"), "n_bytes", (-total_score / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
