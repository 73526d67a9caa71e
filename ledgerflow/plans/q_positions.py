"""Queries for positions and FX."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ledgerflow.operators import dedup, fx as fxops, rollup
from ledgerflow.plans import fixtures as fx
from ledgerflow.plans import runs
from ledgerflow.plans.catalog import query
from ledgerflow.plans.oracle_views import with_views
from ledgerflow.session import scratch_path
from ledgerflow.sources.payloads import explode_balances


def pos_tb():
    return [F.col(c).desc() for c in fx.POSITION_TIEBREAK]


POS_TB_SQL = "etl_time DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC"
LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
RUN_DATE, RUN_TIME = "1998-12-01", "1998-12-01 22:00:00"


@query("invert_rates", with_views("SELECT * FROM rates", ["rates"]))
def q_invert_rates(spark, d):
    return fx.rates(spark, d)


@query("fx_lookup", with_views("""
SELECT p.l_orderkey, p.l_linenumber, p.l_partkey, p.l_suppkey, p.currency, coalesce(r.fx_rate_to_base, 1.0) AS fx_rate_to_sgd
FROM positions_raw p LEFT JOIN rates r ON p.currency = r.currency""", ["positions_raw", "rates"]))
def q_fx_lookup(spark, d):
    r = fx.rates(spark, d).withColumnRenamed("fx_rate_to_base", "fx_rate_to_sgd")
    res = fxops.lookup(fx.positions_raw(spark, d), r, "currency", "fx_rate_to_sgd", 1.0)
    return res.select(*LI_KEYS, "currency", "fx_rate_to_sgd")


@query("convert_to_base", with_views(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, currency, market_value, fx_rate_to_sgd, market_value_sgd FROM positions",
    ["positions"]))
def q_convert_to_base(spark, d):
    return fx.positions(spark, d).select(*LI_KEYS, "currency", "market_value", "fx_rate_to_sgd", "market_value_sgd")


@query("latest_snapshot", with_views("""
SELECT source, date, symbol, l_orderkey, l_linenumber, l_partkey FROM positions p
WHERE date = (SELECT max(date) FROM positions q WHERE q.source = p.source)""", ["positions"]))
def q_latest_snapshot(spark, d):
    snap = dedup.latest_snapshot(fx.positions(spark, d), "date", keys=["source"])
    return snap.select("source", "date", "symbol", "l_orderkey", "l_linenumber", "l_partkey")


@query("latest_rates", with_views("""
SELECT currency, fx_rate_to_sgd AS fx_rate_to_base FROM (
  SELECT *, row_number() OVER (PARTITION BY currency ORDER BY etl_time DESC, fx_rate_to_sgd DESC) AS rn
  FROM positions WHERE date = (SELECT max(date) FROM positions)) WHERE rn = 1""", ["positions"]))
def q_latest_rates(spark, d):
    return fxops.rates_from_history(fx.positions(spark, d))


_LATEST_POS = f"""
SELECT source, symbol, date, quantity, market_value_sgd, l_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY source, symbol ORDER BY {POS_TB_SQL}) AS rn
  FROM positions p WHERE date = (SELECT max(date) FROM positions q WHERE q.source = p.source)) WHERE rn = 1"""


@query("latest_positions", with_views(_LATEST_POS, ["positions"]))
def q_latest_positions(spark, d):
    latest = dedup.latest_per_key_in_snapshot(fx.positions(spark, d), ["symbol"], keys=["source"], tiebreak=pos_tb())
    return latest.select("source", "symbol", "date", "quantity", "market_value_sgd", "l_orderkey")


@query("rates_with_fallback", with_views("""
SELECT currency, fx_rate_to_base, 'fallback' AS status FROM (
  SELECT currency, fx_rate_to_sgd AS fx_rate_to_base FROM (
    SELECT *, row_number() OVER (PARTITION BY currency ORDER BY etl_time DESC, fx_rate_to_sgd DESC) AS rn
    FROM positions WHERE date = (SELECT max(date) FROM positions)) WHERE rn = 1 AND currency <> 'SGD'
  UNION ALL SELECT 'SGD', 1.0)""", ["positions"]))
def q_rates_with_fallback(spark, d):
    """The live fetch failed (``live=None``): newest stored rates per currency, base forced to 1.0."""
    rates, status = fxops.rates_with_fallback(None, fx.positions(spark, d))
    return rates.withColumn("status", F.lit(status))


def _per_source(spark, d):
    raw = fx.positions_raw(spark, d)
    reported = raw.withColumn("market_value", F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(F.col("market_value")))
    ib = fxops.market_value(raw.filter(F.col("source") == "ibkr"), "rounded")
    tg = fxops.market_value(reported.filter(F.col("source") == "tiger"), "reported")
    gm = fxops.market_value(raw.filter(F.col("source") == "gemini"), "raw")
    return ib, tg, gm


@query("source_union", with_views("""
SELECT source, symbol, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       cast(round(cast(quantity AS decimal(19,8)) * cast(price AS decimal(19,8)), 2) AS double) AS market_value
FROM positions_raw WHERE source = 'ibkr'
UNION ALL
SELECT source, symbol, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       coalesce(nullif(CASE WHEN l_linenumber = 1 THEN 0.0 ELSE market_value END, 0.0), quantity * price)
FROM positions_raw WHERE source = 'tiger'
UNION ALL
SELECT source, symbol, l_orderkey, l_linenumber, l_partkey, l_suppkey, quantity * price
FROM positions_raw WHERE source = 'gemini'""", ["positions_raw"]))
def q_source_union(spark, d):
    cols = ["source", "symbol", *LI_KEYS, "market_value"]
    ib, tg, gm = _per_source(spark, d)
    return rollup.union_feeds(ib.select(*cols), tg.select(*cols), gm.select(*cols))


@query("market_value", with_views("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       cast(round(cast(quantity AS decimal(19,8)) * cast(price AS decimal(19,8)), 2) AS double) AS mv_rounded,
       coalesce(nullif(CASE WHEN l_linenumber = 1 THEN 0.0 ELSE market_value END, 0.0), quantity * price) AS mv_reported,
       quantity * price AS mv_raw
FROM positions_raw""", ["positions_raw"]))
def q_market_value(spark, d):
    raw = fx.positions_raw(spark, d).withColumn(
        "market_value", F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(F.col("market_value")))
    out = fxops.market_value(raw, "rounded", out="mv_rounded")
    out = fxops.market_value(out, "reported", out="mv_reported")
    out = fxops.market_value(out, "raw", out="mv_raw")
    return out.select(*LI_KEYS, "mv_rounded", "mv_reported", "mv_raw")


# live = even suppliers, stored history = odd suppliers; the tiger fetch failed.
OUTCOME = [("ibkr", True), ("tiger", False), ("gemini", True)]
OUTCOME_SQL = "SELECT * FROM (VALUES ('ibkr', true), ('tiger', false), ('gemini', true)) t(source, ok)"


def _fallback(spark, d):
    pos = fx.positions(spark, d)
    live = pos.filter(F.col("l_suppkey") % 2 == 0)
    hist = pos.filter(F.col("l_suppkey") % 2 == 1)
    outcome = spark.createDataFrame(OUTCOME, "source string, ok boolean")
    return fxops.positions_with_fallback(live, outcome, hist, tiebreak=pos_tb()), outcome


_FALLBACK_SQL = f"""
SELECT source, symbol, date, l_orderkey, l_linenumber, market_value_sgd FROM positions
WHERE l_suppkey % 2 = 0 AND source IN (SELECT source FROM outcome WHERE ok)
UNION ALL
SELECT source, symbol, date, l_orderkey, l_linenumber, market_value_sgd FROM (
  SELECT *, row_number() OVER (PARTITION BY source, symbol ORDER BY {POS_TB_SQL}) AS rn
  FROM hist h WHERE date = (SELECT max(date) FROM hist q WHERE q.source = h.source)) WHERE rn = 1"""
_FALLBACK_CTES = {
    "outcome": OUTCOME_SQL,
    "hist": "SELECT * FROM positions WHERE l_suppkey % 2 = 1 AND source IN (SELECT source FROM outcome WHERE NOT ok)",
}


@query("source_fallback", with_views(_FALLBACK_SQL, ["positions"], _FALLBACK_CTES))
def q_source_fallback(spark, d):
    res, _ = _fallback(spark, d)
    return res.select("source", "symbol", "date", "l_orderkey", "l_linenumber", "market_value_sgd")


@query("run_status", with_views(f"""
SELECT DATE '{RUN_DATE}' AS run_date, TIMESTAMP '{RUN_TIME}' AS run_time, 'investment' AS pipeline, o.source,
       CASE WHEN o.ok THEN 'live' ELSE 'fallback' END AS status, cast(coalesce(c.n, 0) AS bigint) AS row_count, '' AS message
FROM outcome o LEFT JOIN (SELECT source, count(*) AS n FROM result GROUP BY source) c ON o.source = c.source
UNION ALL
SELECT DATE '{RUN_DATE}', TIMESTAMP '{RUN_TIME}', 'investment', 'fx', 'fallback', NULL, ''""",
    ["positions"], {**_FALLBACK_CTES, "result": _FALLBACK_SQL}))
def q_run_status(spark, d):
    res, outcome = _fallback(spark, d)
    statuses = fxops.source_status(outcome, res)
    return fxops.run_status(statuses, "fallback", RUN_DATE, RUN_TIME)


_CODE_SQL = ("CASE p_type WHEN 'ECONOMY' THEN 'STK' WHEN 'SMALL' THEN 'ETF' WHEN 'MEDIUM' THEN 'CRYPTO' "
             "WHEN 'PROMO' THEN 'CASH' WHEN 'STANDARD' THEN 'OPT' ELSE 'WAR' END")


@query("asset_class_map", with_views(f"""
SELECT p_partkey, code,
  CASE code WHEN 'STK' THEN 'stock' WHEN 'ETF' THEN 'etf' WHEN 'OPT' THEN 'option' WHEN 'FUT' THEN 'future'
            WHEN 'CASH' THEN 'cash' WHEN 'CRYPTO' THEN 'crypto' ELSE lower(code) END AS asset_class,
  CASE code WHEN 'STK' THEN 'stock' WHEN 'ETF' THEN 'etf' WHEN 'OPT' THEN 'option' WHEN 'FUT' THEN 'future'
            WHEN 'CASH' THEN 'cash' WHEN 'CRYPTO' THEN 'crypto' ELSE 'stock' END AS asset_class_default
FROM (SELECT p_partkey, {_CODE_SQL} AS code FROM part)"""))
def q_asset_class_map(spark, d):
    part = fx.table(spark, d, "part").select("p_partkey", F.expr(_CODE_SQL).alias("code"))
    out = fxops.map_class(part, "code", out="asset_class")
    return fxops.map_class(out, "code", unknown="stock", out="asset_class_default")


def _quantity_text(spark, d, with_bad: bool):
    li = fx.table(spark, d, "lineitem").select(*LI_KEYS, "l_quantity")
    txt = (F.col("l_quantity").cast("int") - F.lit(25)).cast("string")
    if with_bad:
        txt = F.when(F.col("l_linenumber") == 7, F.lit("")).when(F.col("l_linenumber") == 6, F.lit("n/a")).otherwise(txt)
    return li.select(*LI_KEYS, txt.alias("quantity"))


_QTY_SQL = "cast(cast(l_quantity AS integer) - 25 AS varchar)"


@query("position_filter", with_views(f"""
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         try_cast(coalesce(nullif(trim(CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN 'n/a' ELSE {_QTY_SQL} END), ''), '0')
                  AS double) AS quantity
  FROM lineitem) WHERE quantity IS NOT NULL AND quantity <> 0"""))
def q_position_filter(spark, d):
    """Empty -> 0, unparseable rows skipped, zero dropped."""
    return fxops.filter_positions(_quantity_text(spark, d, True), "skip_zero")


@query("position_filter_strict", with_views(f"""
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast({_QTY_SQL} AS double) AS quantity FROM lineitem)
WHERE quantity > 0"""))
def q_position_filter_strict(spark, d):
    """Strict parse (a bad number fails the job), non-positive dropped."""
    return fxops.filter_positions(_quantity_text(spark, d, False), "positive")


@query("json_balances", with_views("SELECT * FROM exchange_balances", ["exchange_balances"]))
def q_json_balances(spark, d):
    return explode_balances(fx.exchange_payloads(spark, d), keep=["user_id", "event_id"])


def _coins(spark, d):
    bal = explode_balances(fx.exchange_payloads(spark, d), keep=["user_id", "event_id"])
    bal = fxops.filter_positions(bal, "positive", q="amount").withColumnRenamed("amount", "quantity")
    from ledgerflow.operators.rules import exclude
    return exclude(bal, "currency", fxops.FIAT)


@query("exclude_fiat", with_views("""
SELECT user_id, event_id, currency, quantity FROM (
  SELECT user_id, event_id, currency, cast(trim(amount) AS double) AS quantity FROM exchange_balances)
WHERE quantity > 0 AND currency NOT IN ('USD', 'SGD', 'EUR', 'GBP')""", ["exchange_balances"]))
def q_exclude_fiat(spark, d):
    return _coins(spark, d)


@query("price_lookup", with_views("""
SELECT c.user_id, c.event_id, c.currency AS symbol, c.quantity, coalesce(p.price, 0.0) AS price,
       c.quantity * coalesce(p.price, 0.0) AS market_value
FROM (SELECT user_id, event_id, currency, cast(trim(amount) AS double) AS quantity FROM exchange_balances) c
LEFT JOIN spot_prices p ON c.currency = p.currency
WHERE c.quantity > 0 AND c.currency NOT IN ('USD', 'SGD', 'EUR', 'GBP')""", ["exchange_balances", "spot_prices"]))
def q_price_lookup(spark, d):
    """Exchange balances -> coins -> spot price (missing -> 0.0) -> unrounded value."""
    priced = fxops.lookup(_coins(spark, d), fx.spot_prices(spark, d), "currency", "price", 0.0)
    priced = fxops.market_value(priced, "raw")
    return priced.select("user_id", "event_id", F.col("currency").alias("symbol"), "quantity", "price", "market_value")


@query("portfolio_summary", with_views(
    "SELECT count(*) AS n_positions, count(DISTINCT source) AS n_sources FROM dwd_pos", ["dwd_pos"]))
def q_portfolio_summary(spark, d):
    from ledgerflow.plans.q_models import _dwd_pos
    return rollup.portfolio_summary(_dwd_pos(spark, d))


# ------------------------------------------------------------------ whole runs

_RUNS = [dt.datetime(2024, 1, 14, 22), dt.datetime(2024, 1, 15, 22), dt.datetime(2024, 1, 16, 22)]
_SNAPSHOT_ORDER = ("market_value_sgd", "market_value", "quantity", "price", "currency", "asset_class")


def _position_runs(spark, d) -> str:
    """Three runs: all sources live; one source's fetch failed; all live but empty.  The second is repeated.  Returns the target."""
    target = scratch_path(spark, f"positions-{uuid.uuid4().hex[:12]}")
    pos, rates = fx.positions_raw(spark, d), fx.rates(spark, d)
    pos = pos.select("source", "symbol", "asset_class", "quantity", "price", "market_value", "currency", "l_suppkey")
    ok = spark.createDataFrame([(s, True) for s, _ in OUTCOME], "source string, ok boolean")
    ties = [F.col(c).desc() for c in _SNAPSHOT_ORDER]
    runs.positions_run(spark, pos.filter("l_suppkey % 2 = 0"), ok, target, _RUNS[0], rates, tiebreak=ties)
    for _ in range(2):
        runs.positions_run(spark, pos.filter("l_suppkey % 2 = 1"), spark.createDataFrame(OUTCOME, "source string, ok boolean"), target, _RUNS[1], rates, tiebreak=ties)
    runs.positions_run(spark, pos.limit(0), ok, target, _RUNS[2], None, tiebreak=ties)
    return target


_RUN_COLS = "source, symbol, asset_class, quantity, price, market_value, currency, fx_rate_to_sgd, market_value_sgd"
_RUNS_SQL = f"""
SELECT DATE '2024-01-15' AS date, {_RUN_COLS} FROM positions WHERE l_suppkey % 2 = 0
UNION ALL
SELECT DATE '2024-01-16', {_RUN_COLS} FROM positions WHERE l_suppkey % 2 = 1 AND source <> 'tiger'
UNION ALL
SELECT DATE '2024-01-16', {_RUN_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY source, symbol ORDER BY {", ".join(c + " DESC" for c in _SNAPSHOT_ORDER)}) AS rn
  FROM positions WHERE l_suppkey % 2 = 0 AND source = 'tiger') WHERE rn = 1"""


@query("positions_run", with_views(_RUNS_SQL, ["positions"]))
def q_positions_run(spark, d):
    """Stored positions after three runs: the failed source has its newest stored snapshot, the empty run adds nothing."""
    return runs.stored(spark, _position_runs(spark, d), runs.POSITIONS).drop("etl_time")


@query("positions_run_status", with_views(f"""
SELECT date AS run_date, source, CASE WHEN source = 'tiger' AND date = DATE '2024-01-16' THEN 'fallback' ELSE 'live' END AS status, count(*) AS row_count
FROM ({_RUNS_SQL}) GROUP BY date, source
UNION ALL
SELECT DATE '2024-01-17', source, 'live', 0 FROM outcome
UNION ALL
SELECT * FROM (VALUES (DATE '2024-01-15', 'fx', 'live', NULL), (DATE '2024-01-16', 'fx', 'live', NULL), (DATE '2024-01-17', 'fx', 'fallback', NULL)) t""",
    ["positions"], {"outcome": OUTCOME_SQL}))
def q_positions_run_status(spark, d):
    """Status rows of the three runs; the empty one wrote its status alone, with the rates of stored rows."""
    return runs.stored(spark, _position_runs(spark, d), runs.STATUS).select("run_date", "source", "status", "row_count")
