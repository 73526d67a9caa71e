"""Aggregations, pivots, unpivots and unions.

All aggregations are plain ``groupBy().agg()``: Spark runs a partial
(map-side) aggregate before the shuffle, so a hot key (one owner or month
holding a third of all rows) is collapsed per map task before it moves.
Literal output columns are added *after* the aggregation so they can never
bind to an input column of the same name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_start, month_start_of_ym
from ledgerflow.functions.money import money, money_sum, ratio_pct, round_money
from ledgerflow.operators.dedup import dedup_latest


def _zero() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def _debit(amount: str = "amount") -> Column:
    return F.when(F.col(amount) < 0, F.abs(money(amount))).otherwise(_zero())


def _credit(amount: str = "amount") -> Column:
    return F.when(F.col(amount) > 0, money(amount)).otherwise(_zero())


def monthly_spend(df: DataFrame, keys: Sequence[str] = (), month: str = "year_month", category: str = "category") -> DataFrame:
    """Debit, credit, net spend and row count per (keys, month, category)."""
    return df.groupBy(*keys, month, category).agg(
        round_money(F.sum(_debit())).alias("total_debit"),
        round_money(F.sum(_credit())).alias("total_credit"),
        round_money(F.sum(_debit()) - F.sum(_credit())).alias("net_spend"),
        F.count(F.lit(1)).alias("tx_count"),
    )


def savings_rate(df: DataFrame, keys: Sequence[str] = (), month: str = "year_month") -> DataFrame:
    """Income, spend, net savings and savings rate (1 dp; NULL unless income > 0)."""
    inc, spend = "__inc", "__spend"
    agg = df.groupBy(*keys, month).agg(
        F.round(F.sum(_credit()), 2).alias(inc),
        F.round(F.sum(_debit()), 2).alias(spend),
    )
    return agg.select(
        *keys,
        month,
        F.col(inc).cast("double").alias("total_income"),
        F.col(spend).cast("double").alias("total_spend"),
        round_money(F.col(inc) - F.col(spend)).alias("net_savings"),
        F.when(F.col(inc) > 0, ratio_pct(F.col(inc) - F.col(spend), F.col(inc))).alias("savings_rate_pct"),
    )


def statement_totals(df: DataFrame, keys: Sequence[str] = ("source_file",)) -> DataFrame:
    """Per statement: total debits, total credits, row count."""
    return df.groupBy(*keys).agg(
        round_money(F.sum(_debit())).alias("total_debits"),
        round_money(F.sum(_credit())).alias("total_credits"),
        F.count(F.lit(1)).alias("tx_count"),
    )


def pivot_classes(
    df: DataFrame,
    mapping: Mapping[str, Sequence[str]],
    date: str = "date",
    keys: Sequence[str] = (),
    value: str = "market_value_sgd",
    class_col: str = "asset_class",
    zero_as_null: Sequence[str] = (),
) -> DataFrame:
    """One column per target: round(sum(value where class in classes), 2).

    Conditional sums over a fixed mapping (not ``pivot()``), so there is no
    extra job to discover pivot values.  Targets in ``zero_as_null`` turn a
    zero total into NULL (it is then carried forward downstream).
    """
    aggs = []
    for target, classes in mapping.items():
        s = F.round(F.sum(F.when(F.col(class_col).isin(list(classes)), money(value)).otherwise(_zero())), 2)
        if target in zero_as_null:
            s = F.nullif(s, _zero())
        aggs.append(s.cast("double").alias(target))
    return df.groupBy(*keys, date).agg(*aggs)


def monthly_balance(
    df: DataFrame,
    ym: str = "statement_date",
    value: str = "balance",
    keys: Sequence[str] = (),
    out: str = "cash_sgd",
) -> DataFrame:
    """Sum of balances per month start (month given as 'YYYY-MM')."""
    return df.groupBy(*keys, month_start_of_ym(ym).alias("date")).agg(money_sum(value).alias(out))


def calendar_bounded(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Broadcast hint for a per-date/per-month aggregate *without* owner keys:
    its size is bounded by the calendar (one row per month or day), not by the
    data.  With owner keys the size grows with the owners, so the choice is
    left to the planner and AQE's runtime statistics."""
    return F.broadcast(df) if not keys else df


def month_end_rows(df: DataFrame, date: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """Rows on the last date present within their month (per owner).

    The correlated "max date in the same month" subquery becomes one partial
    aggregate per (keys, month) and a left-semi join back; without owner keys
    the aggregate is calendar-bounded and broadcast, so the big side is not
    shuffled again.
    """
    last = df.groupBy(*keys, month_start(date).alias("__m")).agg(F.max(date).alias(date)).drop("__m")
    return df.join(calendar_bounded(last, keys), on=[*keys, date], how="left_semi")


def month_end_by_class(
    df: DataFrame,
    date: str = "date",
    keys: Sequence[str] = (),
    by: Sequence[str] = ("source", "asset_class"),
    value: str = "market_value_sgd",
) -> DataFrame:
    """Month-start date, ``by`` columns and the summed value on the month's last date.

    One pass: sum per (keys, date, by) first (partial aggregation; the result
    is bounded by dates x classes per owner), then keep each month's last
    date with a window over that small aggregate.  Equal to filtering rows to
    the month's last date and summing, because every date with a row appears
    in the aggregate.
    """
    daily = df.groupBy(*keys, F.col(date).alias("__d"), *by).agg(F.sum(money(value)).alias("__v"))
    w = Window.partitionBy(*keys, month_start("__d"))
    last = daily.withColumn("__last", F.max("__d").over(w)).filter(F.col("__d") == F.col("__last"))
    return last.select(*keys, month_start("__d").alias("date"), *by, round_money(F.col("__v")).alias(value))


def monthly_contributions(
    df: DataFrame,
    category: str = "Endowus",
    pattern: str = "%UOB KAY HIAN%",
    date_col: str = "transaction_date",
    keys: Sequence[str] = (),
    out: str = "monthly_sgd",
) -> DataFrame:
    """Sum of |amount| of debits that carry ``category`` or whose text matches ``pattern``.

    Filter uses the raw category (no overrides), as the contribution feed does.
    """
    hit = (F.col("category") == F.lit(category)) | F.upper(F.col("description")).like(pattern)
    return (
        df.filter(hit & (F.col("amount") < 0))
        .groupBy(*keys, month_start(date_col).alias("month"))
        .agg(round_money(F.sum(F.abs(money("amount")))).alias(out))
    )


def portfolio_summary(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Row count and distinct sources."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_positions"), F.countDistinct("source").alias("n_sources")
    )


def row_total(cols: Sequence[str], scale: int = 2) -> Column:
    """round(coalesce(c1,0) + coalesce(c2,0) + ..., scale) computed exactly."""
    total = None
    for c in cols:
        term = F.coalesce(money(c), _zero())
        total = term if total is None else total + term
    return round_money(total, scale)


def unpivot_accounts(
    df: DataFrame,
    id_cols: Sequence[str],
    mapping: Mapping[str, str],
    var: str = "asset_class",
    value: str = "market_value_sgd",
) -> DataFrame:
    """Wide account columns -> (id_cols, var, value) rows in one scan (``unpivot``).

    ``mapping`` is column -> label.
    """
    renamed = df.select(*id_cols, *[round_money(money(c)).alias(label) for c, label in mapping.items()])
    return renamed.unpivot(list(id_cols), list(mapping.values()), var, value)


def union_feeds(*dfs: DataFrame) -> DataFrame:
    """Union by column name (feeds must share a schema)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def statement_month(df: DataFrame, keys: Sequence[str] = ("source_file",), date: str = "transaction_date", position: str = "position") -> DataFrame:
    """Statement month = month of the *first* parsed transaction of each statement."""
    return df.groupBy(*keys).agg(F.date_format(F.min_by(F.col(date), F.col(position)), "yyyy-MM").alias("statement_month"))


def top_merchants(df: DataFrame, month: str, k: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Top-``k`` descriptions by total debit in ``month`` (per owner).

    Partial aggregation first, then a per-owner top-k window (WindowGroupLimit),
    never a global sort of raw rows.
    """
    agg = (
        df.filter((F.col("year_month") == F.lit(month)) & (F.col("amount") < 0))
        .groupBy(*keys, "description", "category")
        .agg(F.round(F.sum(F.abs(money("amount"))), 2).alias("__total"), F.count(F.lit(1)).alias("tx_count"))
    )
    w = Window.partitionBy(*keys).orderBy(F.col("__total").desc(), F.col("description"), F.col("category"))
    return (
        agg.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(*keys, "rank", "description", "category", F.col("__total").cast("double").alias("total_spend"), "tx_count")
    )


def recent_transactions(df: DataFrame, k: int = 10, keys: Sequence[str] = (), order: Sequence[str] = ("transaction_date", "transaction_id")) -> DataFrame:
    """Newest ``k`` transactions (per owner), deterministic order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


__all__ = [
    "monthly_spend", "savings_rate", "statement_totals", "pivot_classes", "monthly_balance",
    "month_end_rows", "month_end_by_class", "monthly_contributions", "portfolio_summary", "row_total",
    "unpivot_accounts", "union_feeds", "statement_month", "top_merchants", "recent_transactions",
    "dedup_latest",
]
