"""Whole ingest runs: positions of all sources, and pension letters.

Every run writes to folders of its own name (``load=...``) and replaces what is
there, so a run that is repeated or cut short leaves one copy of its rows; it
never counts its own earlier attempt as stored history.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import dedup, fx, statements
from ledgerflow.schemas import INVESTMENT_POSITIONS, PENSION_BALANCES, RUN_STATUS
from ledgerflow.session import scratch_path
from ledgerflow.sources import tables

POSITIONS, PENSION, STATUS = "ods_investment_positions_df", "ods_cpf_balances_df", "pipeline_run_status"
SCHEMAS = {POSITIONS: INVESTMENT_POSITIONS, PENSION: PENSION_BALANCES, STATUS: RUN_STATUS}


def load_name(as_of: dt.datetime) -> str:
    return as_of.strftime("%Y%m%dT%H%M%S")


def stored(spark: SparkSession, target: str, table: str, other_than: str | None = None) -> DataFrame:
    """Rows of a table in its schema; ``other_than``: without those of one load."""
    schema, path = SCHEMAS[table], f"{target}/{table}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).parquet(path)
    if other_than is not None:
        rows = rows.filter(F.col("load") != other_than)  # a partition: its files are not read
    return rows.select(*schema.names)


def _append(rows: DataFrame, target: str, table: str, load: str) -> DataFrame:
    path = f"{target}/{table}/load={load}"
    tables.conform(rows, SCHEMAS[table]).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(SCHEMAS[table]).parquet(path)


def positions_run(spark: SparkSession, live: DataFrame, outcome: DataFrame, target: str, as_of: dt.datetime,
                  live_rates: DataFrame | None = None, tz: str = "Asia/Singapore", tiebreak: Sequence[Column | str] = ()) -> None:
    """Sources -> conversion -> landing and append, and a status row per source and one for the rates.

    ``live`` has what the sources gave (source, symbol, asset_class, quantity,
    price, market_value, currency), ``outcome`` whether each fetch succeeded
    (source, ok).  A source that failed gives its newest stored snapshot.  The
    rows are dated by the local day, and landed under the UTC day.  A run
    without any position writes its status alone.
    """
    load = load_name(as_of)
    history = stored(spark, target, POSITIONS, other_than=load)
    known = not history.isEmpty()
    rates, rates_status = fx.rates_with_fallback(live_rates, history if known else None)
    if rates is None:
        rates = spark.createDataFrame([], "currency string, fx_rate_to_base double")
    converted = tables.conform(fx.convert_to_base(live, rates), INVESTMENT_POSITIONS).drop("etl_time", "date")
    rows = fx.positions_with_fallback(converted, outcome, history, tiebreak=tiebreak)
    staged = scratch_path(spark, f"positions-{load}-{hashlib.sha256(target.encode()).hexdigest()[:16]}")
    tables.stamp(rows, as_of, tz).write.mode("overwrite").parquet(staged)  # evaluated once, and before anything is appended
    rows = spark.read.parquet(staged)
    if not rows.isEmpty():
        tables.land_raw(rows, f"{target}/raw_positions", ["landing_date"])
        _append(rows, target, POSITIONS, load)
    day = tables.stamp(spark.range(1), as_of, tz).first()["date"]
    _append(fx.run_status(fx.source_status(outcome, rows), rates_status, day, as_of), target, STATUS, load)


def pension_run(spark: SparkSession, letters: DataFrame, target: str, as_of: dt.datetime, currency: str = "SGD") -> DataFrame:
    """Parse -> skip dates that are loaded -> land by month -> append.  Returns the letters that could not be read, with the reason.

    Of several letters of one date in a run, the first by name is loaded.
    """
    load = load_name(as_of)
    good, rejects = tables.split_rejects(statements.checked_balances(letters), f"{target}/checked_letters/load={load}")
    rows = good.select(
        F.lit(as_of).cast("timestamp_ntz").alias("etl_time"), "source_file", "statement_date", "ordinary_account", "special_account",
        "medisave_account", F.col("total").alias("total_cpf"), F.lit(currency).alias("currency"))
    rows = dedup.dedup_latest(rows, ["statement_date"], tiebreak=[F.col("source_file").asc()])
    new = tables.skip_loaded(rows, stored(spark, target, PENSION, other_than=load))
    appended = _append(new, target, PENSION, load)
    # Each load has a part of a month's folder to itself: a later letter of the month leaves the earlier ones.
    landed = appended.withColumn("month", F.date_format("statement_date", "yyyy-MM")).withColumn("load", F.lit(load))
    tables.land_raw(landed, f"{target}/raw_pension", ["month", "load"])
    return rejects
