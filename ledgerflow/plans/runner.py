"""The model graph, run level by level.

Models that do not wait for each other run side by side (as many as
``threads``); each is written once and read back by the models that need it.
Every raw input is read by one node: what several models take from it (the
newest load per transaction, balance and pension month) is a node of its own.
A failed model stops the run after its level; nothing that is written is lost.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.dates import parse_statement_date, year_month
from ledgerflow.operators import rules
from ledgerflow.plans import models as m


@dataclass(frozen=True)
class Node:
    """A model: the inputs and models that it reads, and how it is built from them."""

    needs: tuple[str, ...]
    build: Callable[..., DataFrame]


def newest_transactions(raw: DataFrame, keys: Sequence[str] = (), rule_list=rules.DEFAULT_RULES,
                        excluded=rules.EXCLUDED_CATEGORIES) -> DataFrame:
    """(keys, transaction_id, newest, kept): per id the newest load, and the newest of those that the rules keep, in one pass.

    Both are kept while aggregating, so an id that was loaded many times sends
    one row per task.  ``kept`` is NULL where the rules exclude every load.
    """
    d = parse_statement_date("date")
    cleaned = F.struct("etl_time", "source_file", "transaction_type", d.alias("transaction_date"), year_month(d).alias("year_month"),
                       "description", "amount", "currency", "category")
    own = raw.withColumn("__raw_category", F.col("category"))
    own = rules.apply_rules(own, rule_list)
    raw_row = F.struct(*[F.col("__raw_category").alias("category") if c == "category" else F.col(c) for c in raw.columns])
    rows = own.select(
        *keys, m.tx_id(own).alias("transaction_id"), raw_row.alias("newest"), F.struct("etl_time", "__raw_category").alias("at"),
        cleaned.alias("kept"), F.when(~F.col("category").isin(*excluded), F.struct("etl_time", "category")).alias("kept_at"))
    return rows.groupBy(*keys, "transaction_id").agg(F.max_by("newest", "at").alias("newest"), F.max_by("kept", "kept_at").alias("kept"))


def graph(keys: Sequence[str] = (), as_of: _dt.date | str | None = None, position_tiebreak=(), balance_tiebreak=(),
          pension_tiebreak=()) -> dict[str, Node]:
    """All models over the raw inputs ``tx``, ``positions``, ``balances`` and ``pension``."""
    feeds = ("dwd_positions", "balances_newest", "pension_newest", "tx_newest")
    ties = {"keys": keys, "balance_tiebreak": balance_tiebreak, "pension_tiebreak": pension_tiebreak}
    return {
        "transactions": Node(("tx",), lambda tx: newest_transactions(tx, keys)),
        "dwd_positions": Node(("positions",), lambda p: m.dwd_positions(p, keys, position_tiebreak)),
        "balances_newest": Node(("balances",), lambda b: m.latest_balances(b, keys, balance_tiebreak)),
        "pension_newest": Node(("pension",), lambda p: m.latest_pension(p, keys, pension_tiebreak)),
        "tx_newest": Node(("transactions",), lambda t: t.select("newest.*")),
        "dwd_transactions": Node(("transactions",), lambda t: t.filter("kept IS NOT NULL").select(*keys, "transaction_id", "kept.*")),
        "monthly_spend": Node(("dwd_transactions",), lambda t: m.monthly_spend(t, keys)),
        "savings_rate": Node(("dwd_transactions",), lambda t: m.savings_rate(t, keys)),
        "net_worth_history": Node(feeds, lambda p, b, n, t: m.net_worth_history(p, b, n, t, **ties)),
        "net_worth_daily": Node(feeds, lambda p, b, n, t: m.net_worth_daily(p, b, n, t, **ties)),
        "net_worth_monthly": Node(("net_worth_history",), lambda h: m.net_worth_monthly(h, keys)),
        "spend_mom": Node(("monthly_spend",), lambda s: m.spend_mom(s, as_of, keys)),
    }


#: Nodes that only take columns or rows of another one: not worth writing again.
VIEWS = frozenset({"tx_newest"})


def levels(nodes: Mapping[str, Node], names: Sequence[str]) -> list[list[str]]:
    """The models that ``names`` need, by the number of models before them."""
    depth: dict[str, int] = {}

    def visit(name: str) -> int:
        if name not in nodes:
            return 0  # a raw input
        if name not in depth:
            depth[name] = 1 + max(map(visit, nodes[name].needs))
        return depth[name]

    for name in names:
        if name not in nodes:
            raise KeyError(f"unknown model {name!r}; known: {sorted(nodes)}")
        visit(name)
    return [[n for n in nodes if depth.get(n) == level] for level in range(1, max(depth.values(), default=0) + 1)]


def run_graph(spark: SparkSession, nodes: Mapping[str, Node], inputs: Mapping[str, DataFrame], names: Sequence[str], folder: str,
              threads: int = 4) -> dict[str, DataFrame]:
    """Run ``names`` and what they need; every model is written below ``folder`` and read back."""
    built: dict[str, DataFrame] = dict(inputs)

    def run(name: str) -> DataFrame:
        made = nodes[name].build(*(built[need] for need in nodes[name].needs))
        if name in VIEWS:
            return made
        made.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(made.schema).parquet(f"{folder}/{name}")

    with ThreadPoolExecutor(threads) as pool:
        for level in levels(nodes, names):
            waiting = [(name, pool.submit(run, name)) for name in level]
            done = {name: (w.exception(), w) for name, w in waiting}  # the whole level ends first
            if failed := [name for name, (error, _) in done.items() if error is not None]:
                raise RuntimeError(f"models failed: {failed}") from done[failed[0]][0]
            built.update((name, w.result()) for name, (_, w) in done.items())
    return {name: built[name] for name in names}
