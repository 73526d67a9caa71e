"""Search answers the queries of a shard in bulk: no steps of its own for every query, and the same results as slow sums."""

import math
import sys

import numpy as np
import pytest

from ledgerflow.llm import wand
from ledgerflow.llm.textops import signed, words


def asked(shard, texts, df, n_docs):
    """Places, weights and starts of the texts' terms in a shard."""
    term, weight, starts = [], [], [0]
    for text in texts:
        own = [t for t in np.unique(signed(words([text]).hashes)).tolist() if t in df]
        at = np.searchsorted(shard.terms, own)
        here = [(p, t) for p, t in zip(at.tolist(), own, strict=True) if p < len(shard.terms) and shard.terms[p] == t]
        term += [p for p, _ in here]
        weight += [math.log(1 + (n_docs - df[t] + 0.5) / (df[t] + 0.5)) for _, t in here]
        starts.append(len(term))
    return np.array(term, dtype=np.int64), np.array(weight), np.array(starts)


def corpus(n, seed):
    """Texts of frequent and rare words, some of them copies."""
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, int(rng.integers(1, 120))) if x < 5000) for _ in range(n)]
    return [texts[i // 7 * 7] if i % 7 < 2 else texts[i] for i in range(n)]


@pytest.fixture(scope="module")
def shard():
    texts = corpus(600, 1)
    row = wand.pack_shard(np.arange(600)[::-1].copy(), texts)
    s = wand.Shard(row, row["n_words"] / 600, 1.2, 0.75)
    return s, texts, dict(zip(s.terms.tolist(), s.df.tolist(), strict=True))


def slow(shard, term, weight, starts, q, k, least):
    """The k best by plain sums over every document's terms."""
    mine = dict(zip(term[starts[q]:starts[q + 1]].tolist(), weight[starts[q]:starts[q + 1]].tolist(), strict=True))
    found = []
    for d in range(len(shard.ids)):
        own = range(shard.doc_starts[d], shard.doc_starts[d + 1])
        score = round(math.fsum(mine[t] * shard.doc_impacts[p] for p in own if (t := int(shard.doc_terms[p])) in mine), 6)
        if score > 0 and score >= least:
            found.append((-score, int(shard.ids[d])))
    return sorted(found)[:k]


@pytest.mark.parametrize("common,per_posting", [(24, 512), (1, 1 << 30), (1 << 30, 1), (24, 1 << 30)])
def test_matrix_and_postings_give_the_same_best(shard, monkeypatch, common, per_posting):
    monkeypatch.setattr(wand, "COMMON", common)
    monkeypatch.setattr(wand, "CELLS_PER_POSTING", per_posting)
    monkeypatch.setattr(wand, "QUERIES", 7)
    monkeypatch.setattr(wand, "SUMS", 500)
    s, texts, df = shard
    row = wand.pack_shard(np.arange(600)[::-1].copy(), texts)
    s = wand.Shard(row, row["n_words"] / 600, 1.2, 0.75)
    term, weight, starts = asked(s, [*texts[:10], "", "nowhere", "w1", "w1 w2 w4999"], df, 600)
    for share in (0, 1, 1.5):  # of the k-th best: a threshold that is met exactly, and one that fewer than k reach
        want = [slow(s, term, weight, starts, q, 10, 0) for q in range(14)]
        least = np.array([share * -w[-1][0] if len(w) == 10 else 0.0 for w in want])
        want = [[x for x in w if -x[0] >= t - 1e-9] for w, t in zip(want, least, strict=True)]
        q, doc, score = s.top(term, weight, starts, 10, least)
        got = [[(-float(x), int(s.ids[d])) for d, x in zip(doc[q == i], score[q == i], strict=True)] for i in range(14)]
        assert got == want and not got[10] and not got[11]
        assert all(t >= -w[-1][0] for t, w in zip(least, want, strict=True) if len(w) == 10)


def test_queries_of_a_shard_are_answered_in_bulk(shard):
    s, texts, df = shard
    long = [t for t in texts if len(set(t.split())) > 20]
    calls = []
    for n in (100, 400):
        term, weight, starts = asked(s, (long * 8)[:n], df, len(texts))
        bound = np.bincount(np.repeat(np.arange(n), np.diff(starts)), weights=weight * s.term_max[term], minlength=n)
        count = 0

        def counted(frame, event, arg):
            nonlocal count
            count += event in ("call", "c_call")

        sys.setprofile(counted)
        try:
            q, _, _ = s.top(term, weight, starts, 10, 0.98 * bound)  # in reach by the maxima, not by any document
        finally:
            sys.setprofile(None)
        assert len(q) == 0
        calls.append(count)
    assert 20 < calls[1] < calls[0] + 300  # less than a step for each further query


def test_a_shard_has_a_bounded_number_of_documents(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 5}") for i in range(50)], "doc_id long, text string").coalesce(1)
    assert sorted(r["n_docs"] for r in wand.build_index(docs, shard_docs=20).select("n_docs").collect()) == [10, 20, 20]
    assert wand.search(docs, docs.where("doc_id = 7"), k=3).select("doc_id").collect()[0][0] is not None
