"""Composite models: raw (ods) -> cleaned (dwd) -> aggregated (dws) -> dashboard (ads).

Each model is a function of DataFrames.  ``keys`` (owner/account columns
present in every input) partition every window and join; ``keys=()`` is the
single-owner book.  Shared sub-results (deduplicated feeds) are built by one
function each and reused, so a plan scans each input once per use.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_start, parse_statement_date, year_month
from ledgerflow.functions.money import money, round_money
from ledgerflow.functions.text import record_id
from ledgerflow.operators import dedup, rollup, rules, timeline
from ledgerflow.session import cut_lineage

# Labels the history feed gives the non-broker sources.
BANK_SOURCE = "uob_savings"
PENSION_SOURCE = "cpf"
CONTRIB_SOURCE = "endowus"
PENSION_CLASSES = {"ordinary_account": "cpf_oa", "special_account": "cpf_sa", "medisave_account": "cpf_ma"}

MONTHLY_CLASSES = {
    "stocks_sgd": ("stock", "etf"),
    "crypto_sgd": ("crypto",),
    "cash_sgd": ("cash",),
    "cpf_oa_sgd": ("cpf_oa",),
    "cpf_sa_sgd": ("cpf_sa",),
    "cpf_ma_sgd": ("cpf_ma",),
    "endowus_principal_sgd": ("endowus",),
}
DAILY_CLASSES = {"stocks_sgd": ("stock", "etf"), "crypto_sgd": ("crypto",)}
CARRIED = ["cash_sgd", "cpf_oa_sgd", "cpf_sa_sgd", "cpf_ma_sgd", "endowus_principal_sgd"]

TX_ID_COLS = ("source_file", "date", "description", "amount")


# --------------------------------------------------------------------- dwd

def tx_id(df: DataFrame) -> Column:
    return record_id(*TX_ID_COLS)


def dwd_transactions(raw: DataFrame, keys: Sequence[str] = (), rule_list=rules.DEFAULT_RULES,
                     excluded=rules.EXCLUDED_CATEGORIES, on_bad_date: str = "error") -> DataFrame:
    """Overrides -> id -> exclusion -> keep newest load per id (in that order)."""
    over = rules.apply_rules(raw, rule_list)
    d = parse_statement_date("date", on_bad=on_bad_date)
    cleaned = over.select(
        *keys,
        tx_id(over).alias("transaction_id"),
        "etl_time", "source_file", "transaction_type",
        d.alias("transaction_date"),
        year_month(d).alias("year_month"),
        "description", "amount", "currency", "category",
    )
    cleaned = rules.exclude(cleaned, "category", excluded)
    return dedup.dedup_latest(cleaned, [*keys, "transaction_id"], tiebreak=[F.col("category").desc_nulls_last()])


POSITION_COLS = ["etl_time", "date", "source", "symbol", "asset_class", "quantity", "price", "market_value",
                 "currency", "fx_rate_to_sgd", "market_value_sgd"]


def dwd_positions(raw: DataFrame, keys: Sequence[str] = (), tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    """Newest load per (date, source, symbol), typed and pruned."""
    latest = dedup.dedup_latest(raw, [*keys, "date", "source", "symbol"], tiebreak=tiebreak)
    return latest.select(*keys, F.col("etl_time"), F.col("date").cast("date").alias("date"), *POSITION_COLS[2:])


# --------------------------------------------------------------- shared feeds

def latest_balances(raw_balances: DataFrame, keys: Sequence[str] = (), tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    return dedup.dedup_latest(raw_balances, [*keys, "statement_date", "source_file"], tiebreak=tiebreak)


def latest_pension(raw_pension: DataFrame, keys: Sequence[str] = (), tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    return dedup.latest_in_month(raw_pension, "statement_date", keys=keys, tiebreak=tiebreak)


def raw_tx_latest(raw_tx: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Newest load per transaction id, before overrides and filters."""
    with_id = raw_tx.withColumn("transaction_id", tx_id(raw_tx))
    return dedup.dedup_latest(with_id, [*keys, "transaction_id"], tiebreak=[F.col("category").desc_nulls_last()])


def contributions_cumulative(raw_tx: DataFrame, keys: Sequence[str] = (), out: str = "market_value_sgd") -> DataFrame:
    """Running total of monthly contributions: (keys, date=month, out)."""
    latest = raw_tx_latest(raw_tx, keys).withColumn("transaction_date", parse_statement_date("date"))
    monthly = rollup.monthly_contributions(latest, keys=keys)
    return timeline.running_total(monthly, "monthly_sgd", order=["month"], keys=keys, out=out).select(
        *keys, F.col("month").alias("date"), out)


# --------------------------------------------------------------------- dws

def monthly_spend(dwd_tx: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rollup.monthly_spend(dwd_tx, keys)


def savings_rate(dwd_tx: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rollup.savings_rate(dwd_tx, keys)


def net_worth_history(dwd_pos: DataFrame, raw_balances: DataFrame, raw_pension: DataFrame, raw_tx: DataFrame,
                      keys: Sequence[str] = (), balance_tiebreak=(), pension_tiebreak=()) -> DataFrame:
    """(keys, date, source, asset_class, market_value_sgd) from four feeds."""
    cols = [*keys, "date", "source", "asset_class", "market_value_sgd"]
    inv = rollup.month_end_by_class(dwd_pos, keys=keys).select(*cols)
    bank = rollup.monthly_balance(latest_balances(raw_balances, keys, balance_tiebreak), keys=keys, out="market_value_sgd")
    bank = bank.select(*keys, "date", F.lit(BANK_SOURCE).alias("source"), F.lit("cash").alias("asset_class"), "market_value_sgd")
    pen = latest_pension(raw_pension, keys, pension_tiebreak).withColumn("date", month_start("statement_date"))
    pen = rollup.unpivot_accounts(pen, [*keys, "date"], PENSION_CLASSES)
    pen = pen.select(*keys, "date", F.lit(PENSION_SOURCE).alias("source"), "asset_class", "market_value_sgd")
    contrib = contributions_cumulative(raw_tx, keys).select(
        *keys, "date", F.lit(CONTRIB_SOURCE).alias("source"), F.lit(CONTRIB_SOURCE).alias("asset_class"), "market_value_sgd")
    return rollup.union_feeds(inv, bank, pen, contrib)


# --------------------------------------------------------------------- ads

def _finalize(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return df.select(
        *keys, "date", "stocks_sgd", "crypto_sgd",
        rollup.row_total(["stocks_sgd", "crypto_sgd"]).alias("investment_sgd"),
        z("cash_sgd"), z("endowus_principal_sgd"), z("cpf_oa_sgd"), z("cpf_sa_sgd"), z("cpf_ma_sgd"),
        rollup.row_total(["cpf_oa_sgd", "cpf_sa_sgd", "cpf_ma_sgd"]).alias("total_cpf_sgd"),
        rollup.row_total(["stocks_sgd", "crypto_sgd", "cash_sgd", "endowus_principal_sgd"]).alias("total_net_worth_excl_cpf_sgd"),
        rollup.row_total(["stocks_sgd", "crypto_sgd", "cash_sgd", "endowus_principal_sgd",
                          "cpf_oa_sgd", "cpf_sa_sgd", "cpf_ma_sgd"]).alias("total_net_worth_sgd"),
    )


def net_worth_monthly(history: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Monthly dashboard: class pivot (zero balances -> NULL), carry-forward, totals."""
    piv = rollup.pivot_classes(history, MONTHLY_CLASSES, keys=keys, zero_as_null=CARRIED)
    filled = timeline.fill_forward(piv, CARRIED, order=["date"], keys=keys)
    return _finalize(filled, keys)


def net_worth_daily(dwd_pos: DataFrame, raw_balances: DataFrame, raw_pension: DataFrame, raw_tx: DataFrame,
                    keys: Sequence[str] = (), balance_tiebreak=(), pension_tiebreak=()) -> DataFrame:
    """Daily dashboard: investments per day; bank cash by as-of month; pension and
    contributions by exact month; carry-forward; totals; day-over-day change."""
    inv = rollup.pivot_classes(dwd_pos, DAILY_CLASSES, keys=keys)
    bank = rollup.monthly_balance(latest_balances(raw_balances, keys, balance_tiebreak), keys=keys, out="cash_sgd")
    pen = latest_pension(raw_pension, keys, pension_tiebreak).select(
        *keys, month_start("statement_date").alias("date"),
        *[round_money(money(c)).alias(f"{lbl}_sgd") for c, lbl in PENSION_CLASSES.items()])
    contrib = contributions_cumulative(raw_tx, keys, out="endowus_principal_sgd")
    j = timeline.month_asof_join(inv, bank, "date", "date", ["cash_sgd"], keys=keys)
    j = timeline.month_join(j, pen, "date", keys=keys)
    j = timeline.month_join(j, contrib, "date", keys=keys)
    filled = timeline.fill_forward(j, CARRIED, order=["date"], keys=keys)
    out = _finalize(filled, keys)
    return timeline.period_change(out, "total_net_worth_sgd", order=["date"], keys=keys,
                                  prev_col=None, delta_col="day_over_day_change_sgd", pct_col=None)


def spend_mom(monthly: DataFrame, as_of: _dt.date | str, keys: Sequence[str] = ()) -> DataFrame:
    """Monthly spend with previous-month flag, previous value, delta and % change per category."""
    flagged = timeline.flag_previous_month(monthly, as_of)
    return timeline.period_change(flagged, "net_spend", order=["year_month"], keys=[*keys, "category"],
                                  prev_col="prev_month_spend", delta_col="mom_delta", pct_col="mom_pct")


# ---------------------------------------------------------------- runner

MODEL_NAMES = ("dwd_transactions", "dwd_positions", "monthly_spend", "savings_rate", "net_worth_history",
               "net_worth_monthly", "net_worth_daily", "spend_mom")


# Which requested models read each shared intermediate.
CONSUMERS = {
    "dwd_transactions": ("monthly_spend", "savings_rate", "spend_mom"),
    "dwd_positions": ("net_worth_history", "net_worth_monthly", "net_worth_daily"),
    "monthly_spend": ("spend_mom",),
    "net_worth_history": ("net_worth_monthly",),
}


def run_models(inputs: dict[str, DataFrame], names: Sequence[str], keys: Sequence[str] = (),
               as_of: _dt.date | str | None = None, position_tiebreak=(), balance_tiebreak=(),
               pension_tiebreak=(), checkpoint_shared: bool = False) -> dict[str, DataFrame]:
    """Build the requested models from raw inputs ``tx, positions, balances, pension``.

    Model-to-model references resolve to the same lazy DataFrame.  With
    ``checkpoint_shared`` an intermediate read by two or more of the requested
    models is written once with a reliable ``checkpoint()`` into the folder
    named by ``spark.checkpoint.dir``: later actions start from it, and a lost
    executor does not send them back to the raw inputs.
    """
    built: dict[str, DataFrame] = {}
    wanted = set(names)

    def shared(name: str) -> bool:
        return checkpoint_shared and len(wanted.intersection(CONSUMERS.get(name, ()))) >= 2

    def get(name: str) -> DataFrame:
        if name in built:
            return built[name]
        v = _build(name)
        if shared(name):
            v = cut_lineage(v)
        built[name] = v
        return v

    def _build(name: str) -> DataFrame:
        if name == "dwd_transactions":
            v = dwd_transactions(inputs["tx"], keys)
        elif name == "dwd_positions":
            v = dwd_positions(inputs["positions"], keys, position_tiebreak)
        elif name == "monthly_spend":
            v = monthly_spend(get("dwd_transactions"), keys)
        elif name == "savings_rate":
            v = savings_rate(get("dwd_transactions"), keys)
        elif name == "net_worth_history":
            v = net_worth_history(get("dwd_positions"), inputs["balances"], inputs["pension"], inputs["tx"], keys,
                                  balance_tiebreak, pension_tiebreak)
        elif name == "net_worth_monthly":
            v = net_worth_monthly(get("net_worth_history"), keys)
        elif name == "net_worth_daily":
            v = net_worth_daily(get("dwd_positions"), inputs["balances"], inputs["pension"], inputs["tx"], keys,
                                balance_tiebreak, pension_tiebreak)
        elif name == "spend_mom":
            if as_of is None:
                raise ValueError("spend_mom needs an explicit as_of date")
            v = spend_mom(get("monthly_spend"), as_of, keys)
        else:
            raise KeyError(f"unknown model {name!r}; known: {MODEL_NAMES}")
        return v

    return {n: get(n) for n in names}
