"""Toxicity by weak supervision.

Voters are lexicon entries (words and word stems) mined from labelled training
rows, and fixed patterns; each votes or abstains on a text.  A generative label
model treats the true class as hidden: by expectation maximisation it estimates
how often each voter fires on either class, and from the posterior it estimates
the correlations between voters, by which the votes of voters that repeat each
other are discounted.  The annotator's label is one more voter, of estimated
accuracy.  A logistic regression is then trained on the posterior labels, and
scores every whole text in Spark.

Labels are learned only from rows whose crc32(doc_id as text) mod ``folds`` is
not 0.  The model is fitted on at most about ``max_labelled`` labelled rows, a
sample by hash of the id; mining counts run in Spark, and what reaches the driver is
that sample's vote matrix (max_labelled x voters bits).  Near copies teach once, or the
words of one text copied many times would crowd out all other voters: of the
sampled rows of one label whose least shingle hash is the same, the one of the
least id teaches, and those with a five-word Jaccard of 0.8 or more to it do
not; all others do.  Only the text is an input of a score.

Nulls and edges: a null text counts as empty and is scored; labels without an
id or a value teach nothing; of several labels of one id the largest holds; a
null id is held out or not by the hash of ""; repeated rows are scored each; an
empty table gives an empty result, and without labels of both classes the score
is the smoothed share of toxic labels.  Extra columns of documents are carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.textops import runs, segments_min, shingles, signed, words
from ledgerflow.session import scratch_path

WORD = regex.compile(r"\p{L}+")
STEMS = (3, 4, 5, 6)
# Patterns that vote "toxic" whatever the language.
PATTERNS = (r"[!?]{3,}", r"\p{L}\*{2,}\p{L}?", r"(?:\b\p{Lu}{4,}\b[\s,!]*){4,}")
_PATTERNS = tuple(regex.compile(p) for p in PATTERNS)


def features(text: str) -> set[str]:
    """Words ("=word") and stems ("stem") of a text."""
    out: set[str] = set()
    for w in set(WORD.findall(text.lower())):
        out.add("=" + w)
        for n in STEMS:
            if len(w) > n:
                out.add(w[:n])
    return out


def fires(text: str, stems: dict[str, int], whole: dict[str, int], lengths: tuple[int, ...]) -> list[int]:
    """Numbers of the voters that fire on a text."""
    hit: set[int] = set()
    for w in set(WORD.findall(text.lower())):
        if (v := whole.get(w)) is not None:
            hit.add(v)
        for n in lengths:
            if len(w) > n and (v := stems.get(w[:n])) is not None:
                hit.add(v)
    first = len(stems) + len(whole)
    hit.update(first + i for i, p in enumerate(_PATTERNS) if p.search(text))
    return sorted(hit)


def is_held_out(folds: int, order: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(order).cast("string"), F.lit("")).cast("binary")) % folds == 0


@dataclass
class LabelModel:
    """P(voter fires | class), corrected for correlated voters."""

    prior: float
    rate: np.ndarray  # 2 x voters
    discount: np.ndarray  # voters
    annotator: float

    @staticmethod
    def evidence(votes: np.ndarray, rate: np.ndarray, discount: np.ndarray) -> np.ndarray:
        """Log odds from voters that fire; silence counts only by all voters together (see ``fit``)."""
        return votes @ (discount * (np.log(rate[1]) - np.log(rate[0]))).astype(np.float32)

    @classmethod
    def fit(cls, votes: np.ndarray, label: np.ndarray, rounds: int = 15) -> tuple[LabelModel, np.ndarray]:
        """votes: rows x voters of 0/1 (the last column: no other voter fired).  Returns the model and posteriors."""
        n, m = votes.shape
        posterior = np.where(label == 1, 0.95, 0.05)
        discount, annotator = np.ones(m), 0.95
        for _ in range(rounds):
            weight = np.stack((1 - posterior, posterior))  # 2 x rows
            total = weight.sum(axis=1, keepdims=True)
            rate = (weight.astype(np.float32) @ votes + 0.5) / (total + 1)
            prior = float((total[1, 0] + 1) / (n + 2))
            # Correlation of votes within the classes: what two voters share beyond the class.
            cov = np.zeros((m, m))
            for c in (0, 1):
                scaled = votes * np.sqrt(weight[c])[:, None].astype(np.float32)
                cov += scaled.T @ scaled - total[c, 0] * np.outer(rate[c], rate[c])
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = np.clip(cov / np.outer(sd, sd), 0, 1)
            discount = 1 / np.maximum(corr.sum(axis=1), 1.0)
            agree = float((posterior * (label == 1) + (1 - posterior) * (label == 0)).sum())
            annotator = min(0.99, max(0.6, (agree + 9) / (n + 10)))
            odds = np.log(prior / (1 - prior)) + cls.evidence(votes, rate, discount)
            odds += np.where(label == 1, 1, -1) * np.log(annotator / (1 - annotator))
            new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            moved, posterior = float(np.abs(new - posterior).max()), new
            if moved < 1e-4:
                break
        return cls(prior, rate, discount, annotator), posterior


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 0.3, rounds: int = 25) -> np.ndarray:
    """Weights (bias last) of a logistic regression on soft labels, by Newton steps."""
    x = np.hstack((x, np.ones((len(x), 1), dtype=x.dtype))).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-4:
            break
    return w


@dataclass
class Classifier:
    stems: dict[str, int]
    whole: dict[str, int]
    weights: np.ndarray  # voters, then "nothing fired", then bias

    def scores(self, texts: list[str]) -> np.ndarray:
        lengths = tuple(sorted({len(s) for s in self.stems}))
        m = len(self.weights) - 2
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            hit = fires(t, self.stems, self.whole, lengths)
            odds = self.weights[-1] + (self.weights[hit].sum() if hit else self.weights[m])
            out[i] = 1 / (1 + np.exp(-odds))
        return out


def without_near_copies(body: DataFrame, taught: DataFrame) -> DataFrame:
    """The rows of ``taught`` (__id, __label; bounded) but for near copies of a row with the same label and a smaller id."""
    spark = body.sparkSession

    def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["body"].tolist()
            for lo, hi in runs(texts):
                values, ptr = shingles(words(texts[lo:hi]), 5)
                own = [np.unique(signed(values[a:b])) for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
                part = batch.iloc[lo:hi]
                yield pd.DataFrame({
                    "__id": part["__id"].array, "__label": part["__label"].array, "least": signed(segments_min(values, ptr)), "own": own})

    # At most about max_labelled pairs of numbers are broadcast: a bound, so the texts need no shuffle.
    schema, path = "__id long, __label int, least long, own array<long>", scratch_path(spark, f"toxicity-shingles-{uuid4().hex}")
    body.join(F.broadcast(taught), "__id").select("__id", "__label", "body").mapInPandas(shingled, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    first = rows.groupBy("__label", "least").agg(F.min(F.struct("__id", "own")).alias("first"))
    common = F.size(F.array_intersect("own", "first.own"))
    differs = 5 * common < 4 * (F.size("own") + F.size("first.own") - common)
    kept = rows.join(first, ["__label", "least"]).where((F.col("__id") == F.col("first.__id")) | differs)
    return taught.join(kept.select("__id").distinct(), "__id")


def sample_by_id(rows: DataFrame, share: float) -> DataFrame:
    """About this share of the rows, by hash of __id; steps of 2**-20 of a millionth, so a share of any large table is not rounded to none."""
    h = F.xxhash64("__id")
    place = F.pmod(h, F.lit(1_000_000)) + F.pmod(F.shiftright(h, 20), F.lit(1 << 20)) / (1 << 20)
    return rows.where(place < 1e6 * share)


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 5, max_labelled: int = 20_000, max_voters: int = 384,
    least_support: int = 4, order: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Classifier:
    spark = docs.sparkSession
    taught = (
        labels.where(F.col(order).isNotNull() & F.col(label).isin(0, 1) & ~is_held_out(folds, order))
        .groupBy(F.col(order).cast("long").alias("__id")).agg(F.max(F.col(label).cast("int")).alias("__label"))
    )
    have = taught.count()
    if have > max_labelled:
        taught = sample_by_id(taught, max_labelled / have)
    body = docs.select(F.col(order).cast("long").alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    ids_path = scratch_path(spark, f"toxicity-sample-{uuid4().hex}")
    without_near_copies(body, taught).write.parquet(ids_path)
    taught = spark.read.parquet(ids_path)
    sample = body.join(F.broadcast(taught), "__id").select("body", F.col("__label").alias("label"))

    def mine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for t, y in zip(batch["body"].tolist(), batch["label"].tolist(), strict=True):
                for f in (*features(t), ""):  # "": the number of documents
                    seen.setdefault(f, [0, 0])[y] += 1
            yield pd.DataFrame([(f, c[0], c[1]) for f, c in seen.items()], columns=["feature", "clean", "bad"])

    # In the driver's order: the totals first, then the strongest features; each needs few rows.
    counted = sample.mapInPandas(mine, "feature string, clean long, bad long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).where(F.col("bad") >= F.when(F.col("feature") == "", 0).otherwise(least_support))
    total = F.col("feature") == ""
    # A feature's log odds ratio in standard errors, from counts per class; totals come in as literals below.
    sizes = sample.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in sizes}
    if not n.get(0) or not n.get(1):
        share = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
        return Classifier({}, {}, np.array([0.0] * (len(PATTERNS) + 1) + [float(np.log(share / (1 - share)))]))
    odds = F.log((F.col("bad") + 0.5) / (n[1] - F.col("bad") + 0.5)) - F.log((F.col("clean") + 0.5) / (n[0] - F.col("clean") + 0.5))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("clean") + 0.5))
    chosen = (
        counted.where(~total).withColumn("odds", odds).where("odds > 1.5")
        .orderBy(F.desc(F.col("odds") / error), "feature").limit(max_voters).select("feature").collect()
    )
    names = [r["feature"] for r in chosen]
    stem_names = [f for f in names if not f.startswith("=")]
    stems = {f: i for i, f in enumerate(stem_names)}
    whole = {f[1:]: len(stems) + i for i, f in enumerate(f for f in names if f.startswith("="))}
    lengths = tuple(sorted({len(s) for s in stems}))
    m = len(names) + len(PATTERNS)
    sent = spark.sparkContext.broadcast((stems, whole))

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stems, whole = sent.value
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"].to_numpy(np.int32), "hits": [fires(t, stems, whole, lengths) for t in batch["body"]]})

    cast = sample.mapInPandas(vote, "label int, hits array<int>").toPandas()
    votes = np.zeros((len(cast), m + 1), dtype=np.float32)
    for i, h in enumerate(cast["hits"]):
        votes[i, np.asarray(h, dtype=np.int64) if len(h) else [m]] = 1
    # A fixed order of rows, so that sums do not depend on which task ended first.
    label_of = cast["label"].to_numpy()
    fixed = np.lexsort((*votes.T[:16], votes.sum(axis=1), label_of))
    votes, label_of = votes[fixed], label_of[fixed]
    _, posterior = LabelModel.fit(votes, label_of)
    return Classifier(stems, whole, logistic(votes, posterior))


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, order: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with held_out, score and predicted of every whole text."""
    if clash := {"held_out", "score", "predicted"} & set(docs.columns):
        raise ValueError(f"input must not have columns named {sorted(clash)}")
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds, order=order, text=text, **options))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.value.scores(texts.tolist()))

    return (
        docs.withColumn("held_out", is_held_out(folds, order))
        .withColumn("score", scored(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
