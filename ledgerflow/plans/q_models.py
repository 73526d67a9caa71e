"""Queries for the cleaned / aggregated / dashboard models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_start
from ledgerflow.operators import dedup, rollup, rules, timeline
from ledgerflow.plans import fixtures as fx
from ledgerflow.plans import models as m
from ledgerflow.plans import runner
from ledgerflow.plans.catalog import query
from ledgerflow.plans.oracle_views import CARRIED, OVERRIDE, fill_sql, money, pct, row_total_sql, with_views
from ledgerflow.session import scratch_path

# Reports that need "today" take an explicit date (never the wall clock).
AS_OF = "1998-09-15"


def pos_tb():
    return [F.col(c).desc() for c in fx.POSITION_TIEBREAK]


def bal_tb():
    return [F.col("o_orderkey").desc()]


def _dwd_pos(spark, d):
    return m.dwd_positions(fx.positions(spark, d), tiebreak=pos_tb())


def _dwd_tx(spark, d):
    return m.dwd_transactions(fx.tx(spark, d))


def _history(spark, d):
    return m.net_worth_history(_dwd_pos(spark, d), fx.balances(spark, d), fx.pension(spark, d), fx.tx(spark, d),
                               balance_tiebreak=bal_tb(), pension_tiebreak=bal_tb())


def _monthly_spend(spark, d):
    return m.monthly_spend(_dwd_tx(spark, d))


# ------------------------------------------------------------------ phase 1

@query("dedup_positions", with_views(f"""
SELECT date, source, symbol, etl_time, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY date, source, symbol
    ORDER BY etl_time DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn
  FROM positions) WHERE rn = 1""", ["positions"]))
def q_dedup_positions(spark, d):
    latest = dedup.dedup_latest(fx.positions(spark, d), ["date", "source", "symbol"], tiebreak=pos_tb())
    return latest.select("date", "source", "symbol", "etl_time", "l_orderkey", "l_linenumber")


@query("dwd_positions", with_views("SELECT * FROM dwd_pos", ["dwd_pos"]))
def q_dwd_positions(spark, d):
    return _dwd_pos(spark, d)


@query("month_end_snapshot", with_views("""
SELECT date, source, symbol, market_value_sgd FROM dwd_pos
WHERE date IN (SELECT max(date) FROM dwd_pos GROUP BY date_trunc('month', date))""", ["dwd_pos"]))
def q_month_end_snapshot(spark, d):
    # Keeping the newest load drops no date, so only rows of month ends are compared.
    rows = rollup.month_end_rows(fx.positions(spark, d))
    return m.dwd_positions(rows, tiebreak=pos_tb()).select("date", "source", "symbol", "market_value_sgd")


@query("month_end_by_class", with_views("SELECT * FROM inv_month_end", ["inv_month_end"]))
def q_month_end_by_class(spark, d):
    return rollup.month_end_by_class(_dwd_pos(spark, d))


# ------------------------------------------------------------------ phase 2

@query("category_override", with_views(f"""
SELECT etl_time, source_file, transaction_type, date, description, amount, {OVERRIDE} AS category FROM tx""", ["tx"]))
def q_category_override(spark, d):
    return rules.apply_rules(fx.tx(spark, d)).select(
        "etl_time", "source_file", "transaction_type", "date", "description", "amount", "category")


@query("exclude_categories", with_views(f"""
SELECT * FROM (SELECT etl_time, source_file, description, amount, {OVERRIDE} AS category FROM tx)
WHERE category NOT IN ('Transfer', 'Income', 'Reimbursement', 'Endowus')""", ["tx"]))
def q_exclude_categories(spark, d):
    over = rules.apply_rules(fx.tx(spark, d)).select("etl_time", "source_file", "description", "amount", "category")
    return rules.exclude(over, "category")


@query("dedup_transactions", with_views("SELECT transaction_id, etl_time, category FROM raw_tx_latest", ["raw_tx_latest"]))
def q_dedup_transactions(spark, d):
    return m.raw_tx_latest(fx.tx(spark, d)).select("transaction_id", "etl_time", "category")


@query("dwd_transactions", with_views("SELECT * FROM dwd_tx", ["dwd_tx"]))
def q_dwd_transactions(spark, d):
    return _dwd_tx(spark, d)


@query("dwd_transactions_reload", with_views("SELECT * FROM dwd_tx_b7", ["dwd_tx_b7"]))
def q_dwd_transactions_reload(spark, d):
    """A re-delivered copy whose category became excluded: the older copy survives."""
    return m.dwd_transactions(fx.tx(spark, d, copy_category="Transfer"))


@query("monthly_spend", with_views("SELECT * FROM m_spend", ["m_spend"]))
def q_monthly_spend(spark, d):
    return _monthly_spend(spark, d)


@query("savings_rate", with_views(f"""
SELECT year_month, cast(inc AS double) AS total_income, cast(spend AS double) AS total_spend,
       cast(round(inc - spend, 2) AS double) AS net_savings,
       CASE WHEN inc > 0 THEN {pct('inc - spend', 'inc')} END AS savings_rate_pct
FROM (SELECT year_month,
        round(sum(CASE WHEN amount > 0 THEN {money('amount')} ELSE 0 END), 2) AS inc,
        round(sum(CASE WHEN amount < 0 THEN abs({money('amount')}) ELSE 0 END), 2) AS spend
      FROM dwd_tx GROUP BY year_month)""", ["dwd_tx"]))
def q_savings_rate(spark, d):
    return m.savings_rate(_dwd_tx(spark, d))


@query("previous_month_flag", with_views(f"""
SELECT year_month, category, year_month = strftime(date_trunc('month', DATE '{AS_OF}') - INTERVAL 1 MONTH, '%Y-%m')
  AS is_previous_month FROM m_spend""", ["m_spend"]))
def q_previous_month_flag(spark, d):
    return timeline.flag_previous_month(_monthly_spend(spark, d), AS_OF).select("year_month", "category", "is_previous_month")


_MOM = f"""
SELECT *, cast(round({money('net_spend')} - {money('prev_month_spend')}, 2) AS double) AS mom_delta,
       CASE WHEN prev_month_spend <> 0 THEN {pct('net_spend - prev_month_spend', 'prev_month_spend')} END AS mom_pct
FROM (SELECT *, lag(net_spend) OVER (PARTITION BY category ORDER BY year_month) AS prev_month_spend FROM m_spend)"""


@query("month_over_month", with_views(f"SELECT year_month, category, net_spend, prev_month_spend, mom_delta, mom_pct FROM ({_MOM})",
                                      ["m_spend"]))
def q_month_over_month(spark, d):
    out = timeline.period_change(_monthly_spend(spark, d), "net_spend", order=["year_month"], keys=["category"],
                                 prev_col="prev_month_spend", delta_col="mom_delta", pct_col="mom_pct")
    return out.select("year_month", "category", "net_spend", "prev_month_spend", "mom_delta", "mom_pct")


@query("spend_mom", with_views(f"""
SELECT year_month, category, total_debit, total_credit, net_spend, tx_count,
       year_month = strftime(date_trunc('month', DATE '{AS_OF}') - INTERVAL 1 MONTH, '%Y-%m') AS is_previous_month,
       prev_month_spend, mom_delta, mom_pct
FROM ({_MOM})""", ["m_spend"]))
def q_spend_mom(spark, d):
    return m.spend_mom(_monthly_spend(spark, d), AS_OF)


# ------------------------------------------------------------------ phase 3

@query("dedup_balances", with_views("SELECT statement_date, source_file, balance, o_orderkey FROM bal_latest", ["bal_latest"]))
def q_dedup_balances(spark, d):
    return m.latest_balances(fx.balances(spark, d), tiebreak=bal_tb()).select("statement_date", "source_file", "balance", "o_orderkey")


@query("monthly_balance", with_views("SELECT * FROM bank_monthly", ["bank_monthly"]))
def q_monthly_balance(spark, d):
    return rollup.monthly_balance(m.latest_balances(fx.balances(spark, d), tiebreak=bal_tb()))


@query("latest_in_month", with_views("""
SELECT statement_date, source_file, ordinary_account, special_account, medisave_account FROM pen_latest""", ["pen_latest"]))
def q_latest_in_month(spark, d):
    return m.latest_pension(fx.pension(spark, d), tiebreak=bal_tb()).select(
        "statement_date", "source_file", "ordinary_account", "special_account", "medisave_account")


@query("unpivot_accounts", with_views("SELECT date, asset_class, market_value_sgd FROM pen_unpivot", ["pen_unpivot"]))
def q_unpivot_accounts(spark, d):
    pen = m.latest_pension(fx.pension(spark, d), tiebreak=bal_tb()).withColumn("date", month_start("statement_date"))
    return rollup.unpivot_accounts(pen, ["date"], m.PENSION_CLASSES)


@query("monthly_contributions", with_views("SELECT * FROM contrib_monthly", ["contrib_monthly"]))
def q_monthly_contributions(spark, d):
    latest = m.raw_tx_latest(fx.tx(spark, d))
    from ledgerflow.functions.dates import parse_statement_date
    return rollup.monthly_contributions(latest.withColumn("transaction_date", parse_statement_date("date")))


@query("running_total", with_views("SELECT * FROM contrib_cum", ["contrib_cum"]))
def q_running_total(spark, d):
    return m.contributions_cumulative(fx.tx(spark, d))


@query("pivot_classes", with_views("SELECT * FROM nw_pivot", ["nw_pivot"]))
def q_pivot_classes(spark, d):
    return rollup.pivot_classes(_history(spark, d), m.MONTHLY_CLASSES, zero_as_null=m.CARRIED)


@query("fill_forward", with_views(f"SELECT date, stocks_sgd, crypto_sgd, {fill_sql(CARRIED)} FROM nw_pivot", ["nw_pivot"]))
def q_fill_forward(spark, d):
    piv = rollup.pivot_classes(_history(spark, d), m.MONTHLY_CLASSES, zero_as_null=m.CARRIED)
    return timeline.fill_forward(piv, m.CARRIED, order=["date"])


@query("account_total", with_views(f"""
SELECT source_file, statement_date, {row_total_sql(['ordinary_account', 'special_account', 'medisave_account'])} AS total_sgd
FROM pension""", ["pension"]))
def q_account_total(spark, d):
    p = fx.pension(spark, d)
    return p.select("source_file", "statement_date",
                    rollup.row_total(["ordinary_account", "special_account", "medisave_account"]).alias("total_sgd"))


@query("net_worth_history", with_views("SELECT * FROM nw_history", ["nw_history"]))
def q_net_worth_history(spark, d):
    return _history(spark, d)


@query("net_worth_monthly", with_views("SELECT * FROM nw_monthly", ["nw_monthly"]))
def q_net_worth_monthly(spark, d):
    return m.net_worth_monthly(_history(spark, d))


@query("flagship_net_worth", with_views("SELECT * FROM nw_monthly", ["nw_monthly"]))
def q_flagship_net_worth(spark, d):
    """The model DAG run by name (model-to-model references resolved lazily)."""
    inputs = {"tx": fx.tx(spark, d), "positions": fx.positions(spark, d),
              "balances": fx.balances(spark, d), "pension": fx.pension(spark, d)}
    return m.run_models(inputs, ["net_worth_monthly"], position_tiebreak=pos_tb(),
                        balance_tiebreak=bal_tb(), pension_tiebreak=bal_tb())["net_worth_monthly"]


# ------------------------------------------------------------------ phase 4

@query("validity_ranges", with_views("SELECT * FROM bank_ranged", ["bank_ranged"]))
def q_validity_ranges(spark, d):
    bank = rollup.monthly_balance(m.latest_balances(fx.balances(spark, d), tiebreak=bal_tb()))
    return timeline.to_ranges(bank, "date")


@query("interval_join", with_views("""
SELECT i.date, i.stocks_sgd, b.cash_sgd FROM inv_daily i
LEFT JOIN bank_ranged b ON cast(date_trunc('month', i.date) AS date) >= b.date
                        AND cast(date_trunc('month', i.date) AS date) < b.next_date""", ["inv_daily", "bank_ranged"]))
def q_interval_join(spark, d):
    inv = rollup.pivot_classes(_dwd_pos(spark, d), m.DAILY_CLASSES)
    bank = rollup.monthly_balance(m.latest_balances(fx.balances(spark, d), tiebreak=bal_tb()))
    ranged = timeline.to_ranges(bank.withColumnRenamed("date", "from_date"), "from_date")
    joined = timeline.interval_join(inv, ranged, month_start("date"), "from_date", "next_date")
    return joined.select("date", "stocks_sgd", "cash_sgd")


_ACCOUNT = "'acct_' || cast(o_custkey % 3 AS varchar) || '.pdf'"


@query("interval_join_owners", with_views(f"""
SELECT o.k, o.account, o.day, r.from_date, r.next_date, r.balance FROM (
  SELECT o_orderkey AS k, {_ACCOUNT} AS account, cast(o_orderdate AS date) AS day FROM orders) o
LEFT JOIN (
  SELECT account, from_date, balance, lead(from_date, 1, DATE '9999-12-31') OVER (PARTITION BY account ORDER BY from_date) AS next_date FROM (
    SELECT {_ACCOUNT} AS account, cast(o_orderdate AS date) AS from_date, cast(max({money('o_totalprice')}) AS double) AS balance
    FROM orders WHERE day(o_orderdate) % 13 = 5 AND year(o_orderdate) > 1992 GROUP BY 1, 2)) r
  ON o.account = r.account AND o.day >= r.from_date AND o.day < r.next_date"""))
def q_interval_join_owners(spark, d):
    """Every order's day within its account's balance that held on it: ranges of some days that cross months, the last one
    open, none before the first; three accounts hold all rows."""
    o = fx.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"), F.concat(F.lit("acct_"), (F.col("o_custkey") % 3).cast("string"), F.lit(".pdf")).alias("account"),
        F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    known = o.filter((F.day("day") % 13 == 5) & (F.year("day") > 1992))
    balance = known.groupBy("account", F.col("day").alias("from_date")).agg(F.max(rollup.money("o_totalprice")).cast("double").alias("balance"))
    ranged = timeline.to_ranges(balance, "from_date", keys=["account"])
    return timeline.interval_join(o.drop("o_totalprice"), ranged, "day", "from_date", "next_date", keys=["account"]).select(
        "k", "account", "day", "from_date", "next_date", "balance")


@query("month_join", with_views("""
SELECT i.date, i.crypto_sgd, c.cpf_oa_sgd, c.cpf_sa_sgd, c.cpf_ma_sgd FROM inv_daily i
LEFT JOIN pen_monthly c ON c.date = cast(date_trunc('month', i.date) AS date)""", ["inv_daily", "pen_monthly"]))
def q_month_join(spark, d):
    inv = rollup.pivot_classes(_dwd_pos(spark, d), m.DAILY_CLASSES)
    pen = m.latest_pension(fx.pension(spark, d), tiebreak=bal_tb()).select(
        month_start("statement_date").alias("date"),
        *[rollup.round_money(rollup.money(c)).alias(f"{lbl}_sgd") for c, lbl in m.PENSION_CLASSES.items()])
    return timeline.month_join(inv, pen, "date").select("date", "crypto_sgd", "cpf_oa_sgd", "cpf_sa_sgd", "cpf_ma_sgd")


def _daily(spark, d):
    return m.net_worth_daily(_dwd_pos(spark, d), fx.balances(spark, d), fx.pension(spark, d), fx.tx(spark, d),
                             balance_tiebreak=bal_tb(), pension_tiebreak=bal_tb())


@query("day_over_day", with_views("SELECT date, total_net_worth_sgd, day_over_day_change_sgd FROM nw_daily", ["nw_daily"]))
def q_day_over_day(spark, d):
    return _daily(spark, d).select("date", "total_net_worth_sgd", "day_over_day_change_sgd")


@query("net_worth_daily", with_views("SELECT * FROM nw_daily", ["nw_daily"]))
def q_net_worth_daily(spark, d):
    return _daily(spark, d)


# ------------------------------------------------------------------ owners with a large share of all rows

_OWNED = """SELECT o_orderkey AS k, CASE WHEN o_custkey % 3 = 0 THEN 'hot' ELSE 'c' || cast(o_custkey % 50 AS varchar) END AS owner,
  cast(o_orderdate AS date) AS day, o_totalprice AS amount, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice END AS known FROM orders"""


def _owned(spark, d):
    """Raw rows of owners, one of whom has a third of them; a balance is known on a seventh of the rows."""
    o = fx.table(spark, d, "orders")
    owner = F.when(F.col("o_custkey") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("o_custkey") % 50).cast("string")))
    return o.select(F.col("o_orderkey").alias("k"), owner.alias("owner"), F.col("o_orderdate").cast("date").alias("day"),
                    F.col("o_totalprice").alias("amount"), F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice")).alias("known"))


@query("fill_forward_owners", f"""
SELECT k, owner, day, amount, last_value(known IGNORE NULLS) OVER (PARTITION BY owner ORDER BY day, k
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known FROM ({_OWNED})""")
def q_fill_forward_owners(spark, d):
    return timeline.fill_forward(_owned(spark, d), ["known"], order=["day", "k"], keys=["owner"], bucket=F.trunc("day", "MM"))


@query("running_total_owners", f"""
SELECT k, owner, day, amount, cast(sum({money('amount')}) OVER (PARTITION BY owner ORDER BY day, k
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS double) AS total FROM ({_OWNED})""")
def q_running_total_owners(spark, d):
    return timeline.running_total(_owned(spark, d).drop("known"), "amount", order=["day", "k"], keys=["owner"], out="total",
                                  bucket=F.trunc("day", "MM"))


# ------------------------------------------------------------------ the whole model graph

# What is added up over each model's rows.
_MODEL_VALUES = {
    "dwd_transactions": "amount", "dwd_positions": "market_value_sgd", "monthly_spend": "net_spend", "savings_rate": "net_savings",
    "net_worth_history": "market_value_sgd", "net_worth_monthly": "total_net_worth_sgd", "net_worth_daily": "total_net_worth_sgd",
    "spend_mom": "mom_delta"}
_MODEL_VIEWS = {"dwd_transactions": "dwd_tx", "dwd_positions": "dwd_pos", "monthly_spend": "m_spend", "net_worth_history": "nw_history",
                "net_worth_monthly": "nw_monthly", "net_worth_daily": "nw_daily",
                "savings_rate": f"(SELECT sum({money('amount')}) AS net_savings FROM dwd_tx GROUP BY year_month)",
                "spend_mom": f"({_MOM})"}


@query("model_graph", with_views("\nUNION ALL\n".join(
    f"SELECT '{name}' AS model, count(*) AS n_rows, cast(sum({money(_MODEL_VALUES[name])}) AS double) AS total FROM {_MODEL_VIEWS[name]}"
    for name in _MODEL_VALUES), ["dwd_tx", "dwd_pos", "m_spend", "nw_history", "nw_monthly", "nw_daily"]))
def q_model_graph(spark, d):
    """All eight models from one run, level by level; each model's rows and total."""
    inputs = {"tx": fx.tx(spark, d), "positions": fx.positions(spark, d), "balances": fx.balances(spark, d), "pension": fx.pension(spark, d)}
    nodes = runner.graph(as_of=AS_OF, position_tiebreak=pos_tb(), balance_tiebreak=bal_tb(), pension_tiebreak=bal_tb())
    built = runner.run_graph(spark, nodes, inputs, list(_MODEL_VALUES), scratch_path(spark, f"models-{uuid.uuid4().hex[:12]}"))
    parts = [built[name].agg(F.count("*").alias("n_rows"), F.sum(rollup.money(value)).cast("double").alias("total"))
             .select(F.lit(name).alias("model"), "n_rows", "total") for name, value in _MODEL_VALUES.items()]
    return rollup.union_feeds(*parts)
