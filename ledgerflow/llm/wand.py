"""Exact top-k search: BM25 over an inverted index with pruning by shard maxima and thresholds.

The index is built where the documents lie: every run of documents becomes one
shard, a row of packed arrays (terms, postings in order of document), written
to a shared folder without a shuffle.  Global statistics (documents, average
length, document frequencies of the queries' terms) are sums over the shards.

Each shard answers all queries of a block on its own, many at a time.  It is
skipped by queries whose bound there, the sum of its terms' highest impacts,
is under their threshold.  Whole documents as queries have hundreds of terms,
whose bounds together lie far above any threshold, so finer bounds save little
and the cost of a posting counts.  Terms in many of the shard's documents are a
dense matrix, and their part of all scores is one matrix product in 32-bit
floats; the postings of the others are added up in bulk.  These sums have a
known relative error.  The k-th best score so far is the threshold, and one
shard in eight answers first, so that the others start from its thresholds: only
documents whose sum reaches the threshold, less the error, are scored in full,
in 64-bit floats and a fixed order.  That never drops a document that could be
among the k best, ties included; Spark merges the shards' lists, so the result
is exact.

Queries are taken in blocks of bounded size (``block_terms``), each sent to all
shards; the number of blocks grows with the number of queries.

score = sum over the distinct words of the query of
ln(1 + (N - df + 0.5) / (df + 0.5)) * tf (k1 + 1) / (tf + k1 (1 - b + b len / avg len)),
added in a fixed order and rounded to 6 decimals; ties go to the smaller id.

Nulls and edges: a null text counts as empty and matches nothing; documents with
a null id can be found (null id, after all others in ties) but ask nothing; a
query without words has no result; repeated rows are found one by one, and every
row of queries is answered on its own, whatever ids or texts it shares with
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.textops import gather_ranges, runs, signed, words
from ledgerflow.session import scratch_path

NO_ID = (1 << 63) - 1
#: Terms in at least one of so many documents of a shard are a row of its matrix: there a cell of the product costs less than the postings.
COMMON = 24
#: A query takes part in the product if it has a posting in the matrix for each so many cells; else its postings are added up.
CELLS_PER_POSTING = 512
#: Most cells of a matrix, its queries' weights and its sums (4 bytes each), and most postings at hand, but for one term's.
CELLS, SUMS = 1 << 24, 1 << 17
#: One shard in so many answers first, to give the others their thresholds.
FIRST = 8
QUERIES = 1024  # queries of one matrix product, at most


def _narrow(x: np.ndarray) -> bytes:
    """Bytes of non-negative integers in the narrowest of 2, 4 and 8 bytes."""
    most = int(x.max()) if len(x) else 0
    return x.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    """The n integers of ``_narrow``."""
    return np.frombuffer(raw, dtype={2: np.uint16, 4: np.uint32, 8: np.uint64}[len(raw) // n] if n else np.uint16)


def pack_shard(ids: np.ndarray, texts: list[str]) -> dict:
    """One shard: documents in order of id, terms in order of hash, postings by term and document."""
    order = np.argsort(ids, kind="stable")
    ids, texts = ids[order], [texts[i] for i in order]
    terms, docs = [], []
    for lo, hi in runs(texts):
        w = words(texts[lo:hi])
        terms.append(signed(w.hashes))
        docs.append(w.doc().astype(np.int32) + lo)
    term, doc = np.concatenate(terms), np.concatenate(docs)
    lengths = np.bincount(doc, minlength=len(ids)).astype(np.int32)
    order = np.argsort(term, kind="stable")  # documents stay in order within a term
    term, doc = term[order], doc[order]
    new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])))) if len(term) else np.zeros(0, np.int64)
    tf = np.diff(np.append(new, len(term))).astype(np.int32)
    term, doc = term[new], doc[new]
    first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
    return {
        "n_docs": len(ids), "n_words": int(lengths.sum()), "ids": ids.astype(np.int64).tobytes(), "lengths": lengths.tobytes(),
        "terms": term[first].tobytes(), "dfs": _narrow(np.diff(np.append(first, len(term)))),
        "docs": _narrow(doc), "tfs": _narrow(tf),
    }


def _places(vocabulary: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the terms that the vocabulary has, and their places there; both are in order."""
    at = np.minimum(np.searchsorted(vocabulary, terms), max(0, len(vocabulary) - 1))
    known = np.flatnonzero(vocabulary[at] == terms) if len(vocabulary) else np.zeros(0, np.int64)
    return known, at[known]


POSTING = np.dtype([("doc", np.int32), ("impact", np.float32)])
SHARD = "n_docs long, n_words long, ids binary, lengths binary, terms binary, dfs binary, docs binary, tfs binary"


def build_index(docs: DataFrame, order: str = "doc_id", text: str = "text", shard_chars: int = 16_000_000, shard_docs: int = 1 << 13) -> DataFrame:
    """Write the index of all rows to the shared folder and return it (one row per shard)."""
    spark = docs.sparkSession

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch["id"].tolist(), batch["body"].tolist(), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t) + 1
                if size >= shard_chars or len(ids) == shard_docs:
                    yield pd.DataFrame([pack_shard(np.array(ids, dtype=np.int64), texts)])
                    ids, texts, size = [], [], 0
        if ids:
            yield pd.DataFrame([pack_shard(np.array(ids, dtype=np.int64), texts)])

    path = scratch_path(spark, f"wand-index-{uuid4().hex}")
    docs.select(
        F.coalesce(F.col(order).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")
    ).mapInPandas(pack, SHARD).write.option("parquet.block.size", 8 << 20).parquet(path)
    return spark.read.schema(SHARD).parquet(path)


class Shard:
    """A shard's arrays, with impacts and the matrix of its common terms."""

    def __init__(self, row: dict, average: float, k1: float, b: float):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.terms = np.frombuffer(row["terms"], dtype=np.int64)
        self.df = _wide(row["dfs"], len(self.terms)).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.df)))
        self.docs = _wide(row["docs"], int(self.starts[-1])).astype(np.int32)
        tf = _wide(row["tfs"], int(self.starts[-1])).astype(np.float64)
        lengths = np.frombuffer(row["lengths"], dtype=np.int32)
        norm = k1 * (1 - b + b * lengths / average)
        self.impacts = tf * (k1 + 1) / (tf + norm[self.docs])
        term_of = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.df)
        del tf, norm
        self.term_max = np.maximum.reduceat(self.impacts, self.starts[:-1]) if len(self.terms) else np.zeros(0)
        # The most frequent terms as rows over all documents.
        common = np.flatnonzero(self.df * COMMON >= len(self.ids))
        most = CELLS // max(1, len(self.ids))
        if len(common) > most:
            common = np.sort(common[np.argsort(-self.df[common], kind="stable")[:most]])
        self.row = np.full(len(self.terms), -1, dtype=np.int32)
        self.row[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), len(self.ids)), dtype=np.float32)
        at = gather_ranges(self.starts[common], self.df[common])
        self.matrix[np.repeat(np.arange(len(common)), self.df[common]), self.docs[at]] = self.impacts[at]
        self.postings = np.empty(len(self.docs), dtype=POSTING)
        self.postings["doc"], self.postings["impact"] = self.docs, self.impacts
        # The same postings by document, terms in order: for full scores.
        by_doc = np.argsort(self.docs, kind="stable")
        self.doc_terms, self.doc_impacts = term_of[by_doc], self.impacts[by_doc]
        self.doc_starts = np.concatenate(([0], np.cumsum(np.bincount(self.docs, minlength=len(self.ids)))))
        del self.docs, self.impacts
        self.weights = np.zeros(len(self.terms))  # of the query at hand

    def full(self, docs: np.ndarray) -> np.ndarray:
        """Whole scores of some documents under the query in ``weights``."""
        n = self.doc_starts[docs + 1] - self.doc_starts[docs]
        at = gather_ranges(self.doc_starts[docs], n)
        owner = np.repeat(np.arange(len(docs)), n)
        return np.bincount(owner, weights=self.weights[self.doc_terms[at]] * self.doc_impacts[at], minlength=len(docs))

    def sums(self, term: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of all documents (columns) under some queries (rows), in 32-bit floats; query q has the terms starts[q]:starts[q + 1]."""
        n, docs = len(starts) - 1, len(self.ids)
        owner = np.repeat(np.arange(n), np.diff(starts))
        row, df = self.row[term], self.df[term]
        product = np.bincount(owner[row >= 0], weights=df[row >= 0], minlength=n) * CELLS_PER_POSTING > self.matrix.size
        dense = (row >= 0) & product[owner]
        place = np.cumsum(product) - 1
        weights = np.zeros((int(product.sum()), len(self.matrix)), dtype=np.float32)
        weights[place[owner[dense]], row[dense]] = weight[dense]
        out = np.zeros((n, docs), dtype=np.float32)
        out[product] = weights @ self.matrix
        term, weight, owner, df = term[~dense], weight[~dense].astype(np.float32), owner[~dense] * docs, df[~dense]
        sums, both = out.reshape(-1), self.postings.view(np.int64)
        read = np.cumsum(df)
        at = 0
        while at < len(term):
            # Terms whose postings are few enough to hold; at least one.
            end = max(at + 1, int(np.searchsorted(read, read[at] - df[at] + SUMS, side="right")))
            count = df[at:end]
            own = both[gather_ranges(self.starts[term[at:end]], count)].view(POSTING)
            np.add.at(sums, np.repeat(owner[at:end], count) + own["doc"], np.repeat(weight[at:end], count) * own["impact"])
            at = end
        return out

    def top(self, term: np.ndarray, weight: np.ndarray, starts: np.ndarray, k: int, least: np.ndarray, slack: float = 1e-5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and score of the k best documents of each query of at least its ``least``, which rises to the k-th best found.

        ``term`` are places of the queries' terms here, those of query q at starts[q]:starts[q + 1], each once."""
        out = []
        n_docs = len(self.ids)
        step = max(1, min(QUERIES, CELLS // max(1, n_docs), CELLS // max(1, len(self.matrix))))
        # The shard's maxima bound what a query can reach here.
        bound = np.bincount(np.repeat(np.arange(len(least)), np.diff(starts)), weights=weight * self.term_max[term], minlength=len(least))
        asked = np.flatnonzero((bound > 0) & (bound + slack >= least))
        for lo in range(0, len(asked), step):
            mine = asked[lo: lo + step]
            n = starts[mine + 1] - starts[mine]
            at = gather_ranges(starts[mine], n)
            sums = self.sums(term[at], weight[at], np.concatenate(([0], np.cumsum(n))))
            # Terms are positive, so a sum of n of them is off by less than this share of it.
            error = (n + 8) * 2.0**-23
            reach = least[mine]
            unknown = np.flatnonzero(reach <= 0)
            if len(unknown) and n_docs > k:
                reach[unknown] = np.partition(sums[unknown], n_docs - k, axis=1)[:, n_docs - k] * (1 - error[unknown])
            cut = np.maximum(reach * (1 - error) - slack, np.finfo(np.float32).tiny)
            q, doc = np.divmod(np.flatnonzero(sums >= np.nextafter(cut.astype(np.float32), np.float32(0))[:, None]), n_docs)
            some = np.flatnonzero(np.diff(q, prepend=-1))
            for i, could in zip(q[some].tolist(), np.split(doc, some)[1:], strict=True):
                own = slice(starts[mine[i]], starts[mine[i] + 1])
                self.weights[term[own]] = weight[own]
                score = self.full(could)
                self.weights[term[own]] = 0.0
                enough = score + slack >= reach[i]
                could, score = could[enough], np.round(score[enough], 6)
                best = np.lexsort((self.ids[could], -score))[:k]
                out.append((np.full(len(best), mine[i]), could[best], score[best]))
                if len(best) == k:
                    least[mine[i]] = max(least[mine[i]], score[best[-1]])
        return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def search(
    docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75, block_terms: int = 4_000_000,
    order: str = "doc_id", text: str = "text",
) -> DataFrame:
    """query_id, doc_id, rank (from 1), score: the k best documents of every row of ``queries``, itself among them."""
    spark = docs.sparkSession
    index = build_index(docs, order, text)
    totals = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("w")).first()
    n_docs, average = int(totals["n"]), max(1.0, totals["w"] / max(1, totals["n"]))

    def terms_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["body"].tolist()
            for lo, hi in runs(texts):
                w = words(texts[lo:hi])
                own = [np.unique(signed(w.hashes[a:b])) for a, b in zip(w.ptr[:-1], w.ptr[1:], strict=True)]
                yield pd.DataFrame({"query_id": batch["query_id"].iloc[lo:hi].array, "terms": own, "n": [len(x) for x in own]})

    # Every row of queries has a number of its own, written once: ids may repeat.
    asked_path = scratch_path(spark, f"wand-queries-{uuid4().hex}")
    queries.where(F.col(order).isNotNull()).select(
        F.col(order).cast("long").alias("query_id"), F.coalesce(F.col(text), F.lit("")).alias("body")
    ).mapInPandas(terms_of, "query_id long, terms array<long>, n long").where("n > 0").withColumn(
        "query_row", F.monotonically_increasing_id()).write.parquet(asked_path)
    asked = spark.read.schema("query_id long, terms array<long>, n long, query_row long").parquet(asked_path)
    blocks = int(asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // block_terms + 1

    def one_block(number: int) -> DataFrame:
        mine = asked.where(F.pmod(F.xxhash64("query_row"), F.lit(blocks)) == number).select("query_row", "query_id", "terms").toPandas()
        rows, ids = mine["query_row"].to_numpy(np.int64), mine["query_id"].to_numpy(np.int64)
        flat = np.concatenate([np.asarray(t, dtype=np.int64) for t in mine["terms"]]) if len(mine) else np.zeros(0, np.int64)
        starts = np.concatenate(([0], np.cumsum([len(t) for t in mine["terms"]]))).astype(np.int64)
        vocabulary, where = np.unique(flat, return_inverse=True)
        sent = spark.sparkContext.broadcast((rows, ids, starts, vocabulary, where.astype(np.int32)))

        def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            vocabulary = sent.value[3]
            for batch in batches:
                for _, row in batch.iterrows():
                    terms = np.frombuffer(row["terms"], dtype=np.int64)
                    df = _wide(row["dfs"], len(terms))
                    known, at = _places(vocabulary, terms)
                    yield pd.DataFrame({"place": at, "df": df[known].astype(np.int64)})

        counted = (
            index.select("terms", "dfs").mapInPandas(frequencies, "place long, df long").groupBy("place").agg(F.sum("df").alias("df")).toPandas())
        df = np.zeros(len(vocabulary))
        df[counted["place"].to_numpy(np.int64)] = counted["df"].to_numpy(np.float64)
        idf = spark.sparkContext.broadcast(np.log(1 + (n_docs - df + 0.5) / (df + 0.5)))

        def answering(thresholds):
            def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                rows, ids, starts, vocabulary, where = sent.value
                # What a shard finds raises the thresholds of the next ones of the task.
                weight, least = idf.value, thresholds.value.copy()
                for batch in batches:
                    for _, row in batch.iterrows():
                        shard = Shard(row, average, k1, b)
                        known, at = _places(vocabulary, shard.terms)
                        place = np.full(len(vocabulary), -1, dtype=np.int32)
                        place[at] = known
                        term = place[where]
                        here = term >= 0
                        bounds = np.concatenate(([0], np.cumsum(here)))[starts]
                        q, found, score = shard.top(term[here], weight[where[here]], bounds, k, least)
                        yield pd.DataFrame({"query_row": rows[q], "query_id": ids[q], "id": shard.ids[found], "score": score})

            return answer

        schema, leads = "query_row long, query_id long, id long, score double", F.pmod(F.xxhash64("lengths"), F.lit(FIRST)) == 0
        least = spark.sparkContext.broadcast(np.zeros(len(ids)))
        first_path = scratch_path(spark, f"wand-first-{uuid4().hex}")
        index.where(leads).mapInPandas(answering(least), schema).write.parquet(first_path)
        first = spark.read.schema(schema).parquet(first_path)
        # The k-th best score among the first shards: nothing below it can be a result.
        kth = first.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score")))).where(F.col("rank") == k)
        reached = dict(kth.select("query_row", "score").toPandas().itertuples(index=False))
        least = spark.sparkContext.broadcast(np.array([reached.get(q, 0.0) for q in rows.tolist()]))
        return first.unionByName(index.where(~leads).mapInPandas(answering(least), schema))

    lists = one_block(0)
    for number in range(1, blocks):
        lists = lists.unionByName(one_block(number))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("id"))
    return (
        lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), F.col("rank").cast("int").alias("rank"), "score")
    )
