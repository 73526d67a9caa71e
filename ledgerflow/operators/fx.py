"""Positions and FX: class maps, market value, rate inversion, base-currency
conversion, live-or-fallback snapshots and run-status rows.

Rate and price tables have one row per currency or coin.  Lookups are plain
left joins: Spark broadcasts a side only under its own size threshold
(``spark.sql.autoBroadcastJoinThreshold``), checked on statistics or, under
AQE, on the bytes that a stage has really written; building a query runs no job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.money import money
from ledgerflow.operators.dedup import latest_per_key_in_snapshot

# Broker asset-class codes -> our classes.
ASSET_CLASS_CODES: dict[str, str] = {
    "STK": "stock",
    "ETF": "etf",
    "OPT": "option",
    "FUT": "future",
    "CASH": "cash",
    "CRYPTO": "crypto",
}
# Fiat currencies dropped from exchange balance lists.
FIAT: tuple[str, ...] = ("USD", "SGD", "EUR", "GBP")
BASE_CURRENCY = "SGD"
# Exact product of an unrounded value and a rate: 22 + 14 + 1 digits fit a decimal.
UNROUNDED, RATE_FACTOR = "decimal(22,8)", "decimal(14,6)"


def map_class(df: DataFrame, col: str = "asset_class", mapping: Mapping[str, str] = ASSET_CLASS_CODES,
              unknown: str = "lower", out: str | None = None) -> DataFrame:
    """Code -> class via a literal map; unknown codes become lower-case ('lower')
    or a fixed label (any other string, e.g. 'stock')."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    fallback = F.lower(F.col(col)) if unknown == "lower" else F.lit(unknown)
    return df.withColumn(out or col, F.coalesce(m[F.col(col)], fallback))


def market_value(df: DataFrame, mode: str = "rounded", q: str = "quantity", p: str = "price",
                 reported: str = "market_value", out: str = "market_value") -> DataFrame:
    """'rounded': round(q*p, 2); 'reported': reported value unless NULL/0, else q*p;
    'raw': q*p unrounded."""
    prod = F.col(q) * F.col(p)
    if mode == "rounded":
        expr = F.round(money(q, "decimal(19,8)") * money(p, "decimal(19,8)"), 2).cast("double")
    elif mode == "reported":
        expr = F.coalesce(F.nullif(F.col(reported), F.lit(0.0)), prod)
    elif mode == "raw":
        expr = prod
    else:
        raise ValueError(f"unknown market value mode {mode!r}")
    return df.withColumn(out, expr)


def invert_rates(quoted: DataFrame, base: str = BASE_CURRENCY, currency: str = "currency",
                 rate: str = "rate", out: str = "fx_rate_to_base") -> DataFrame:
    """Quoted 'units per 1 base' -> 'base per 1 unit' = round(1/r, 6); 0 or NULL -> 0.0.

    The base currency itself is forced to 1.0 (added when absent).
    """
    inv = F.when(F.coalesce(F.col(rate), F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.round(F.lit(1.0) / F.col(rate), 6))
    rates = quoted.filter(F.col(currency) != base).select(F.col(currency).alias("currency"), inv.alias(out))
    base_row = quoted.sparkSession.range(1).select(F.lit(base).alias("currency"), F.lit(1.0).alias(out))
    return rates.unionByName(base_row)


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], value: str, default,
           out: str | None = None) -> DataFrame:
    """Left lookup join with a default for misses.  ``dim`` must be unique on
    ``on`` (a currency or price table)."""
    keys = [on] if isinstance(on, str) else list(on)
    d = dim.select(*keys, F.col(value).alias("__v"))
    res = df.join(d, on=keys, how="left")
    return res.withColumn(out or value, F.coalesce(F.col("__v"), F.lit(default))).drop("__v")


def convert_to_base(df: DataFrame, rates: DataFrame, currency: str = "currency", value: str = "market_value",
                    rate: str = "fx_rate_to_base", out_rate: str = "fx_rate_to_sgd",
                    out_value: str = "market_value_sgd", default_rate: float = 1.0) -> DataFrame:
    """Attach the rate (unknown currency -> ``default_rate``) and round(value*rate, 2).

    The value is not rounded before it is multiplied: it keeps eight decimals
    (coin amounts have them), and the one rounding is at the end.
    """
    r = rates.select(F.col("currency").alias(currency), F.col(rate).alias(out_rate))
    res = lookup(df, r, currency, out_rate, default_rate)
    return res.withColumn(out_value, F.round(F.col(value).cast(UNROUNDED) * F.col(out_rate).cast(RATE_FACTOR), 2).cast("double"))


def rates_from_history(history: DataFrame, date: str = "date", rate: str = "fx_rate_to_sgd") -> DataFrame:
    """Newest stored rate per currency from the position history (newest date, newest load)."""
    latest = latest_per_key_in_snapshot(history, ["currency"], date=date, tiebreak=[F.col(rate).desc()])
    return latest.select("currency", F.col(rate).alias("fx_rate_to_base"))


def rates_with_fallback(live: DataFrame | None, history: DataFrame | None, base: str = BASE_CURRENCY) -> tuple[DataFrame | None, str]:
    """Live rates if the fetch succeeded (even if empty), else the newest stored
    ones, else nothing (conversion then uses the 1.0 default) with status 'failed'."""
    if live is not None:
        return live, "live"
    if history is not None:
        stored = rates_from_history(history)
        spark = history.sparkSession
        base_row = spark.range(1).select(F.lit(base).alias("currency"), F.lit(1.0).alias("fx_rate_to_base"))
        return stored.filter(F.col("currency") != base).unionByName(base_row), "fallback"
    return None, "failed"


def positions_with_fallback(live: DataFrame, outcome: DataFrame, history: DataFrame | None,
                            date: str = "date", tiebreak: Sequence[Column | str] = ()) -> DataFrame:
    """Per source: live rows when its fetch succeeded, else its newest stored snapshot.

    ``outcome`` has one row per source: (source, ok boolean).  Sources whose
    fetch failed take the newest stored snapshot (newest date for that source,
    newest load per symbol).  A successful empty fetch stays live with 0 rows.
    """
    # One row per source: broadcast, so that the positions are not dealt by their few sources.
    ok = F.broadcast(outcome.filter(F.col("ok")).select("source"))
    failed = F.broadcast(outcome.filter(~F.col("ok")).select("source"))
    live_rows = live.join(ok, "source", "left_semi")
    if history is None:
        return live_rows
    hist = history.join(failed, "source", "left_semi")
    fallback = latest_per_key_in_snapshot(hist, ["symbol"], date=date, keys=["source"], tiebreak=tiebreak, few_keys=True)
    return live_rows.unionByName(fallback.select(*live_rows.columns))


def source_status(outcome: DataFrame, rows: DataFrame, history_available: bool = True) -> DataFrame:
    """Status per source: live / fallback / failed, with its row count.

    A failed fetch is 'fallback' when a history store is configured (even if
    it yields 0 rows), 'failed' otherwise.
    """
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))
    status = F.when(F.col("ok"), F.lit("live")).otherwise(F.lit("fallback" if history_available else "failed"))
    return (
        outcome.join(counts, "source", "left")
        .select("source", status.alias("status"), F.coalesce(F.col("row_count"), F.lit(0)).cast("long").alias("row_count"))
    )


def run_status(statuses: DataFrame, fx_status: str, run_date, run_time, pipeline: str = "investment",
               ts_type: str = "timestamp_ntz") -> DataFrame:
    """Status rows: one per source plus one for fx (row_count NULL); missing status -> 'unknown'."""
    src = statuses.select(
        F.lit(run_date).cast("date").alias("run_date"), F.lit(run_time).cast(ts_type).alias("run_time"),
        F.lit(pipeline).alias("pipeline"), "source",
        F.coalesce(F.col("status"), F.lit("unknown")).alias("status"),
        F.col("row_count").cast("long").alias("row_count"), F.lit("").alias("message"),
    )
    fx = statuses.sparkSession.range(1).select(
        F.lit(run_date).cast("date").alias("run_date"), F.lit(run_time).cast(ts_type).alias("run_time"),
        F.lit(pipeline).alias("pipeline"), F.lit("fx").alias("source"),
        F.lit(fx_status or "unknown").alias("status"), F.lit(None).cast("long").alias("row_count"), F.lit("").alias("message"),
    )
    return src.unionByName(fx)


def filter_positions(df: DataFrame, mode: str, q: str = "quantity") -> DataFrame:
    """Quantity filters of the three feeds (``q`` is text as received):

    'skip_zero': empty -> 0, unparseable row skipped, zero dropped;
    'positive': unparseable fails the job (strict cast), <= 0 dropped;
    'none': no filter (the value is cast strictly).
    """
    text = F.trim(F.col(q).cast("string"))
    if mode == "skip_zero":
        num = F.coalesce(F.nullif(text, F.lit("")), F.lit("0")).try_cast("double")
        return df.withColumn(q, num).filter(F.col(q).isNotNull() & (F.col(q) != 0))
    if mode == "positive":
        return df.withColumn(q, text.cast("double")).filter(F.col(q) > 0)
    if mode == "none":
        return df.withColumn(q, text.cast("double"))
    raise ValueError(f"unknown filter mode {mode!r}")
