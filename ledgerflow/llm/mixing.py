"""Mixing sources to target weights by temperature.

A source's share of the tokens is raised to an exponent between 0 (all sources
alike) and 1 (as they are) and normalised.  The exponent is found by bisection:
the smallest one at which no source is repeated more than ``repeats`` times
over the least repeated one, or the largest one whose weights still have
the target ``entropy`` (a share of the entropy of equal weights).

The weights are realised as budgeted block permutations.  A source's documents
are hashed into blocks of about ``block_tokens``; each pass over the source
takes its blocks in another permutation and the documents of a block in order
of their hash, until the source's budget is spent: a document is taken if it
starts within the budget.  The stream of each source is then cut so that every
output block gets each source's tokens in the target proportion, and an
output block is permuted by hash.  Without a ``budget`` the least repeated
source is taken exactly once, so every document is kept.

A token is a word, plus one for the end of a document.  Only DataFrame
functions run.  What is gathered is one row per source (their token counts, in
one array); documents are ranked within blocks, and block sums are added up
over the blocks, so a source with a third of all rows is spread over many tasks.

Nulls and edges: a null source is a source of its own; a null text counts as
empty and weighs one token; a null id is hashed as ""; documents with equal ids
are ordered by text; repeated rows are taken each; an empty table gives an
empty result.  Extra columns are carried; clashes with result columns raise.
"""

from __future__ import annotations

import math
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path

ROUNDS = 50


def word_tokens(text: str = "text") -> Column:
    """Words and the end."""
    return (F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def exponent(tokens: Column, repeats: float | None, entropy: float | None) -> Column:
    """The exponent for an array of token counts (double), by bisection within one expression."""
    total = F.aggregate(tokens, F.lit(0.0), lambda a, t: a + t)
    logs = F.transform(tokens, lambda t: F.ln(t / total))

    def fits(alpha: Column) -> Column:
        if repeats is not None:  # passes differ by the factor (largest / smallest) ** (1 - alpha)
            return F.exp((F.array_max(logs) - F.array_min(logs)) * (1 - alpha)) <= F.lit(repeats)
        mass = F.aggregate(logs, F.lit(0.0), lambda a, x: a + F.exp(alpha * x))
        spread = F.ln(mass) - F.aggregate(logs, F.lit(0.0), lambda a, x: a + F.exp(alpha * x) * alpha * x) / mass
        return spread <= F.lit(entropy) * F.ln(F.size(tokens))

    def halve(acc: Column, _: Column) -> Column:
        middle = (acc["lo"] + acc["hi"]) / 2
        ok = fits(middle)
        return F.struct(F.when(ok, acc["lo"]).otherwise(middle).alias("lo"), F.when(ok, middle).otherwise(acc["hi"]).alias("hi"))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, halve)["hi"]
    return F.when(fits(F.lit(0.0)), F.lit(0.0)).otherwise(F.round(found, 9))


def source_plan(
    sources: DataFrame, repeats: float | None = 2.0, entropy: float | None = None, budget: int | None = None,
) -> DataFrame:
    """key, tokens -> key, tokens, alpha, weight, quota (tokens to take), passes."""
    if (repeats is None) == (entropy is None):
        raise ValueError("give either repeats or entropy")
    # One row: an array with one entry per source.
    whole = sources.agg(F.array_sort(F.collect_list(F.struct("key", "tokens"))).alias("all"))
    counts = F.transform("all", lambda s: s["tokens"].cast("double"))
    planned = (
        whole.withColumn("alpha", exponent(counts, repeats, entropy))
        .withColumn("total", F.aggregate(counts, F.lit(0.0), lambda a, t: a + t))
        .withColumn("powers", F.transform(counts, lambda t: F.exp(F.col("alpha") * F.ln(t / F.col("total")))))
        .withColumn("mass", F.aggregate("powers", F.lit(0.0), lambda a, x: a + x))
        .withColumn("weights", F.transform("powers", lambda x: F.round(x / F.col("mass"), 12)))
    )
    need = F.array_max(F.transform(F.arrays_zip("all", "weights"), lambda z: z["all"]["tokens"] / z["weights"]))
    planned = planned.withColumn("budget", need if budget is None else F.lit(float(budget)))
    rows = planned.select("alpha", "budget", F.explode(F.arrays_zip("all", "weights")).alias("z")).select(
        F.col("z.all.key").alias("key"), F.col("z.all.tokens").alias("tokens"), "alpha", F.col("z.weights").alias("weight"), "budget")
    quota = F.round(F.col("weight") * F.col("budget")).cast("long")
    if budget is None:
        quota = F.greatest(quota, F.col("tokens"))  # rounding never costs a document
    return rows.withColumn("quota", quota).withColumn(
        "passes", F.greatest(F.lit(1), F.ceil(F.col("quota") / F.col("tokens")).cast("int"))).drop("budget")


def mix(
    docs: DataFrame, repeats: float | None = 2.0, entropy: float | None = None, budget: int | None = None,
    block_tokens: int = 1 << 18, seed: str = "mix", positions: bool = True,
    order: str = "doc_id", source: str = "source", text: str = "text", keep_text: bool = True,
) -> DataFrame:
    """Rows taken, with n_tokens, pass (0, 1, ..), stream_start (tokens of its source before it), block and position.

    ``keep_text`` False leaves the text out of the shuffles and the result.
    """
    results = {"n_tokens", "pass", "stream_start", "block", "position"}
    if clash := results & set(docs.columns):
        raise ValueError(f"input must not have columns named {sorted(clash)}")
    spark = docs.sparkSession
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(order).cast("string"), F.lit(""))))
    sized = docs.select(
        *[c for c in docs.columns if keep_text or c != text], word_tokens(text).alias("n_tokens"),
        F.struct(named.alias("key"), digest.alias("hash"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie")).alias("__mix"))

    slim_path = scratch_path(spark, f"mix-sizes-{uuid4().hex}")
    sized.select(F.col("__mix.key").alias("key"), F.col("__mix.hash").alias("hash"), "n_tokens").write.parquet(slim_path)
    slim = spark.read.parquet(slim_path)
    total = slim.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_tokens))
    block_of = lambda h: F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(blocks))

    plan_path = scratch_path(spark, f"mix-plan-{uuid4().hex}")
    source_plan(slim.groupBy("key").agg(F.sum("n_tokens").alias("tokens")), repeats, entropy, budget).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    taken = int(plan.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    out_blocks = max(1, math.ceil(taken / block_tokens))

    sums = slim.groupBy("key", block_of(F.col("hash")).alias("own")).agg(F.sum("n_tokens").alias("size"))
    permuted = F.md5(F.concat_ws("|", F.lit(seed), "key", F.col("pass").cast("string"), F.col("own").cast("string")))
    before = Window.partitionBy("key", "pass").orderBy("shuffled", "own").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.join(plan.select("key", "tokens", "quota", "passes"), "key")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1))).withColumn("shuffled", permuted)
        .withColumn("start", F.col("pass") * F.col("tokens") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        .where(F.col("start") < F.col("quota")).select("key", "own", "pass", "start", "quota")
    )
    inside = Window.partitionBy("key", "own").orderBy("hash", "tie").rowsBetween(Window.unboundedPreceding, -1)
    columns = [c for c in sized.columns if c != "__mix"]
    ranked = (
        sized.select(F.struct(*columns).alias("row"), F.col("__mix.key").alias("key"), F.col("__mix.hash").alias("hash"),
                     F.col("__mix.tie").alias("tie"), block_of(F.col("__mix.hash")).alias("own"), "n_tokens")
        .withColumn("offset", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    )
    at = F.col("start") + F.col("offset")
    out = (
        ranked.join(starts, ["key", "own"]).where(at < F.col("quota"))
        .select("row", "pass", at.cast("long").alias("stream_start"), "hash", "tie",
                F.floor(at.cast("double") * out_blocks / F.col("quota")).cast("long").alias("block"))
    )
    if positions:
        turn = F.md5(F.concat_ws("|", "hash", F.col("pass").cast("string")))
        out = out.withColumn("position", F.row_number().over(Window.partitionBy("block").orderBy(turn, "stream_start", "tie")))
    return out.select("row.*", "pass", "stream_start", "block", *(["position"] if positions else []))
