"""N-gram Jaccard join with a MinHash LSH forest.

A text's set of word five-grams gets, for every tree of the forest, a label of
``max_depth`` min-hashes (a byte of each).  The labels of a tree, sorted, are its
trie: texts whose labels begin alike stand side by side, and the longest prefix
that neighbours share is the depth at which they meet.  The sort is one range
shuffle over (tree, label, number), so a node that holds a third of all texts is
dealt over many tasks; each task compares neighbours and passes on only texts
that meet another, and a node cut by a range border is put together by its hash.

Matching begins at the full depth and is shortened level by level until the
chance that a pair at the threshold meets in some tree reaches the target
recall.  That level follows from threshold, trees and target and never from the
data, so no link is traded for speed.

Exact copies meet first, by content, and count as one text.  Texts that meet
are connected through the least member of their node.  A connected group of more
than ``block`` texts is cut into blocks, and a text is dealt to the block of
another only if the two blocks share a node that holds this text, so a group
that hangs together by chains costs what its candidates cost and not its size squared; a
dense group of any size is spread over many tasks.  A pair has one cell, that
of its two blocks, and is counted there once, however many trees it meets in.
In a cell, intersections of all pairs come from a product of incidence matrices
over the shingles that at least two texts share; the cell returns each text's
number of links and a spanning forest of the links, never the pairs.  Classes
are the connected components of the verified links.

Nulls and edges: a null text counts as empty; a text without words links to
nothing and is a class of its own; one of 1 to 4 words has one shingle, all its
words.  Exact copies are linked.  A class is named by its least doc_id that is
not null.  Repeated rows are copies.  An empty table gives an empty result.
Extra columns are carried; clashes with result columns raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.components import connected_components
from ledgerflow.llm.textops import mix64, runs, segments_min, shingles, signed, words
from ledgerflow.session import scratch_path


def recall(similarity: float, trees: int, depth: int) -> float:
    """Chance that a pair of this similarity shares a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def adapted_depth(threshold: float, trees: int, max_depth: int, target: float) -> int:
    """Shorten the matched prefix from the full depth until the target recall is reached."""
    depth = max_depth
    while depth > 1 and recall(threshold, trees, depth) < target:
        depth -= 1
    return depth


def labels_of(texts: list[str], trees: int, max_depth: int, shingle: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Labels (texts x trees x max_depth bytes) of every text, and the number of its shingles (with repeats)."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, trees * max_depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, trees * max_depth, dtype=np.uint64)
    labels, sizes = np.zeros((len(texts), trees * max_depth), dtype=np.uint8), np.zeros(len(texts), dtype=np.int64)
    for lo, hi in runs(texts, 1 << 18):  # small enough for the cache
        h, ptr = shingles(words(texts[lo:hi]), shingle)
        sizes[lo:hi] = np.diff(ptr)
        work = np.empty_like(h)
        for d in range(trees * max_depth):
            np.multiply(h, a[d], out=work)
            np.add(work, b[d], out=work)
            labels[lo:hi, d] = mix64(segments_min(work, ptr)).astype(np.uint8)
    return labels.reshape(len(texts), trees, max_depth), sizes


def shared_depth(tree: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Length of the prefix that each label shares with the next one (0 in another tree)."""
    alike = np.cumprod(labels[1:] == labels[:-1], axis=1).sum(axis=1)
    return np.where(tree[1:] == tree[:-1], alike, 0)


def node_keys(tree: np.ndarray, labels: np.ndarray, depth: int) -> np.ndarray:
    """Hash of the trie node of this depth that holds each label."""
    node = tree.astype(np.uint64) + np.uint64(1)
    for d in range(depth):
        node = mix64(node ^ (labels[:, d].astype(np.uint64) << np.uint64(8)))
    return node


def meetings(batches: Iterator[pd.DataFrame], depth: int) -> Iterator[pd.DataFrame]:
    """One part of the sorted labels (tree, label, no) to (no, node) of the texts that meet a neighbour at this depth.

    The first and the last text are always passed on, as their neighbours may lie in another part.
    """
    held = None  # the last text so far, and whether it is to be passed on whatever follows
    for batch in batches:
        if len(batch) == 0:
            continue
        tree, no = batch["tree"].to_numpy(np.int64), batch["no"].to_numpy(np.int64)
        labels = np.frombuffer(b"".join(batch["label"]), dtype=np.uint8).reshape(len(batch), -1)
        met = held[3] if held else True
        if held:
            tree, no, labels = np.append(held[0], tree), np.append(held[1], no), np.concatenate((held[2], labels))
        meets = shared_depth(tree, labels) >= depth
        keep = np.append(meets, False) | np.concatenate(([met], meets))
        held = tree[-1:], no[-1:], labels[-1:], bool(keep[-1])
        at = np.flatnonzero(keep[:-1])
        yield pd.DataFrame({"no": no[at], "node": signed(node_keys(tree[at], labels[at], depth))})
    if held:
        yield pd.DataFrame({"no": held[1], "node": signed(node_keys(held[0], held[2], depth))})


def verify_cell(first: list[np.ndarray], second: list[np.ndarray] | None, threshold: float, width: int = 4096) -> np.ndarray:
    """Which pairs of shingle sets reach the threshold: first x second, or first x first without the diagonal."""
    sets = first + (second or [])
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.concatenate(([True], flat[1:] != flat[:-1]))
    shared = np.concatenate((~start[1:], [False])) | ~start  # in at least two sets
    column = (np.cumsum(start & shared) - 1)[shared]
    owner = owner[shared]
    n, m = len(first), len(second) if second else len(first)
    common = np.zeros((n, m), dtype=np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, total, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((len(sets), min(width, total - lo)), dtype=np.float32)
        dense[owner[a:b], column[a:b] - lo] = 1
        common += dense[:n] @ (dense[n:] if second else dense).T
    one, two = sizes[:n, None], sizes[None, n:] if second else sizes[None, :]
    linked = common >= threshold * (one + two - common) - 1e-6
    if not second:
        np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray, square: bool) -> np.ndarray:
    """Least member of each member's component, for a matrix of links."""
    n = len(linked)
    if square:
        label, full = np.arange(n), linked
    else:
        m = linked.shape[1]
        full = np.zeros((n + m, n + m), dtype=bool)
        full[:n, n:] = linked
        full[n:, :n] = linked.T
        label = np.arange(n + m)
    while True:
        new = np.minimum(label, np.where(full, label[None, :], len(full)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def reached_blocks(members: DataFrame, blocked: DataFrame) -> DataFrame:
    """no, others: for a text of a group of several blocks, the blocks that share one of its nodes, its own among them."""
    spread = members.join(blocked.where("blocks > 1").select("no", "own"), "no")
    beside = spread.groupBy("node", F.col("own").alias("other")).agg(F.lit(1).alias("one")).drop("one")
    return spread.select("node", "no").join(beside, "node").groupBy("no").agg(F.collect_set("other").alias("others"))


def link_table(
    docs: DataFrame, threshold: float = 0.8, shingle: int = 5, trees: int = 32, max_depth: int = 10,
    target: float = 0.9999, block: int = 512, order: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per distinct text: digest, class_id, class_digest (the text that stands for the class), links, copies.

    links counts the other documents whose similarity to this text is at least
    the threshold, its own copies among them.
    """
    spark = docs.sparkSession
    depth = adapted_depth(threshold, trees, max_depth, target)
    body = docs.select(F.col(order).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))

    def signed_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels, sizes = labels_of(batch["body"].tolist(), trees, max_depth, shingle)
            yield pd.DataFrame({"id": batch["id"].array, "digest": batch["digest"].array, "size": sizes,
                                "labels": [x.tobytes() for x in labels]})

    # Written once: distinct texts with their labels, numbered.
    texts_path = scratch_path(spark, f"forest-texts-{uuid4().hex}")
    (
        body.select(F.col("id").cast("string").alias("id"), F.md5("body").alias("digest"), "body")
        .mapInPandas(signed_texts, "id string, digest string, size long, labels binary")
        .groupBy("digest").agg(F.min(F.col("id").cast("long")).alias("least"), F.count("*").alias("copies"),
                               F.first("size").alias("size"), F.first("labels").alias("labels"))
        .withColumn("no", F.monotonically_increasing_id())
        .write.parquet(texts_path)
    )
    texts = spark.read.parquet(texts_path)

    # The sorted tries, read from left to right by many tasks.
    label = F.expr(f"substring(labels, tree * {max_depth} + 1, {max_depth})").alias("label")
    branches = texts.where("size > 0").select("no", "labels", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    sorted_labels = (
        branches.select("tree", label, "no").repartitionByRange("tree", "label", "no").sortWithinPartitions("tree", "label", "no"))
    members_path = scratch_path(spark, f"forest-members-{uuid4().hex}")
    sorted_labels.mapInPandas(lambda batches: meetings(batches, depth), "no long, node long").write.parquet(members_path)
    members = spark.read.schema("no long, node long").parquet(members_path)

    # Written, so that the join deals both sides anew and can split a hot node.
    heads_path = scratch_path(spark, f"forest-heads-{uuid4().hex}")
    (members.groupBy("node").agg(F.min("no").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
     .write.parquet(heads_path))
    shared = spark.read.schema("node long, head long").parquet(heads_path)
    near = members.join(shared, "node").where("no != head").select(F.col("no").alias("a"), F.col("head").alias("b"))
    groups = connected_components(near)  # checkpointed: candidate groups

    parts = groups.groupBy("root").count().select("root", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("no"), F.col("blocks")).cast("int")
    blocked_path = scratch_path(spark, f"forest-blocks-{uuid4().hex}")
    groups.join(parts, "root").withColumnRenamed("node", "no").withColumn("own", own).write.parquet(blocked_path)
    blocked = spark.read.schema("root long, no long, blocks int, own int").parquet(blocked_path)
    placed = (
        blocked.join(reached_blocks(members, blocked), "no", "left").withColumn("others", F.coalesce("others", F.array("own")))
        .join(texts.select("no", "digest", "copies"), "no")
    )

    def as_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lo, hi in runs(batch["body"].tolist()):
                h, ptr = shingles(words(batch["body"].iloc[lo:hi].tolist()), shingle)
                out += [np.unique(h[a:b]).tobytes() for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
            yield batch.drop(columns="body").assign(grams=out)

    # Of a text's copies one is taken: that with the least id; the key spreads the other copies.
    none = F.lit(-(1 << 63))
    wanted = placed.join(texts.select("digest", F.coalesce("least", none).alias("key")), "digest")
    sets = (
        body.select(F.md5("body").alias("digest"), F.coalesce("id", none).alias("key"), "body")
        .join(wanted, ["digest", "key"]).select("root", "others", "own", "no", "copies", "body")
        .mapInPandas(as_sets, "root long, others array<int>, own int, no long, copies long, grams binary")
    )
    cells = (
        sets.withColumn("other", F.explode("others"))
        .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "no", "copies", "grams")
    )
    dealt = cells.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "no")

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def results(rows: pd.DataFrame) -> pd.DataFrame:
            no, links, root = [], [], []
            cut = (rows[["root", "i", "j"]] != rows[["root", "i", "j"]].shift()).any(axis=1).to_numpy()
            first = np.append(np.flatnonzero(cut), len(rows))
            nos, owns, copies, i, j = (rows[c].to_numpy() for c in ("no", "own", "copies", "i", "j"))
            grams = rows["grams"].tolist()
            for a, b in zip(first[:-1], first[1:], strict=True):
                at = a + np.flatnonzero(np.concatenate(([True], nos[a + 1: b] != nos[a: b - 1])))  # repeated rows once
                square = i[a] == j[a]
                left = at if square else at[owns[at] == i[a]]
                right = left if square else at[owns[at] == j[a]]
                if len(left) == 0 or len(right) == 0 or (square and len(left) < 2):
                    continue
                read = lambda xs: [np.frombuffer(grams[x], dtype=np.uint64) for x in xs]
                linked = verify_cell(read(left), None if square else read(right), threshold)
                whole = left if square else np.concatenate((left, right))
                label = _roots(linked, square)
                count = linked @ copies[right] if square else np.concatenate((linked @ copies[right], linked.T @ copies[left]))
                some = count > 0
                no += nos[whole][some].tolist()
                links += count[some].tolist()
                root += nos[whole][label][some].tolist()
            return pd.DataFrame({"no": pd.Series(no, dtype="int64"), "links": pd.Series(links, dtype="int64"), "head": pd.Series(root, dtype="int64")})

        held = None  # rows of the cell that may go on in the next batch
        for batch in batches:
            rows = batch if held is None else pd.concat((held, batch), ignore_index=True)
            last = rows[["root", "i", "j"]].iloc[-1]
            open_ = ((rows["root"] == last["root"]) & (rows["i"] == last["i"]) & (rows["j"] == last["j"])).to_numpy()
            held = rows[open_].reset_index(drop=True)
            if not open_.all():
                yield results(rows[~open_].reset_index(drop=True))
        if held is not None:
            yield results(held)

    found_path = scratch_path(spark, f"forest-links-{uuid4().hex}")
    dealt.mapInPandas(verified, "no long, links long, head long").write.parquet(found_path)
    found = spark.read.parquet(found_path)
    counts = found.groupBy("no").agg(F.sum("links").alias("others"))
    classes = connected_components(found.select(F.col("no").alias("a"), F.col("head").alias("b")))

    known = (
        texts.drop("labels").join(counts, "no", "left").join(classes.withColumnRenamed("node", "no"), "no", "left")
        .withColumn("root", F.coalesce("root", "no"))
        .withColumn("links", F.when(F.col("size") > 0, F.coalesce("others", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)))
    )
    head = known.groupBy("root").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), "least", "digest")).alias("head"))
    return known.join(head, "root").select(
        "digest", F.when(F.col("size") > 0, F.col("head.least")).alias("class_id"),
        F.when(F.col("size") > 0, F.col("head.digest")).alias("class_digest"), "links", "copies")


def near_duplicates(docs: DataFrame, order: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with class_id, n_links, and class_digest / own digest of the text (null class_digest: no words)."""
    if clash := {"class_id", "n_links", "class_digest", "digest"} & set(docs.columns):
        raise ValueError(f"input must not have columns named {sorted(clash)}")
    table = link_table(docs, order=order, text=text, **options)
    return (
        docs.withColumn("digest", F.md5(F.coalesce(F.col(text), F.lit("")))).join(
            table.select("digest", "class_id", "class_digest", F.col("links").alias("n_links")), "digest")
        # A text without words is a class of its own, in every row.
        .withColumn("class_id", F.when(F.col("class_digest").isNull(), F.col(order)).otherwise(F.col("class_id")))
    )


def one_of_each(docs: DataFrame, order: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows that stay: one of each class (its least id), and all rows without words; columns as in ``docs``."""
    seen = near_duplicates(docs, order, text, **options)
    wordless = F.col("class_digest").isNull()
    first = F.row_number().over(Window.partitionBy("digest").orderBy(F.col(order).asc_nulls_last()))
    chosen = (
        seen.where(~wordless & (F.col("digest") == F.col("class_digest")))
        .withColumn("__first", first).where(F.col("__first") == 1)
    )
    return chosen.select(docs.columns).unionByName(seen.where(wordless).select(docs.columns))
