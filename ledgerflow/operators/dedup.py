"""Keep-latest operators (snapshot history -> current rows).

Top-1 per key is a ``row_number`` window filtered to 1.  Spark plans it with a
partial ``WindowGroupLimit`` before the shuffle and a final one after, so a
key that holds a third of all rows ships only one row per map partition.
Every ordering ends with a caller-supplied total tie-break so results are
deterministic (ties on ``etl_time`` alone are not).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_start

_RN = "__rn"


def _order(order: Sequence[Column | str], tiebreak: Sequence[Column | str]) -> list[Column]:
    cols = []
    for c in [*order, *tiebreak]:
        cols.append(F.col(c).desc() if isinstance(c, str) else c)
    return cols


def dedup_latest(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[Column | str] = ("etl_time",),
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (string = descending), then ``tiebreak``."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*parts).orderBy(*_order(order, tiebreak))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_in_month(
    df: DataFrame,
    date: str,
    keys: Sequence[str] = (),
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """Latest row (by ``date``) within each calendar month (per owner ``keys``)."""
    return dedup_latest(df, [*keys, month_start(date)], order=[date], tiebreak=tiebreak)


def latest_snapshot(
    df: DataFrame,
    date: str = "date",
    keys: Sequence[str] = (),
    few_keys: bool = False,
) -> DataFrame:
    """Rows whose ``date`` equals the newest ``date`` (per ``keys``, or globally).

    The newest date is a one-row-per-key aggregate joined back (a left-semi
    join on key and date): one partial+final aggregation and one broadcast
    join, no correlated subquery.
    """
    newest = df.groupBy(*keys).agg(F.max(date).alias(date))
    # Without keys the newest date is one row: broadcast it so the big side is
    # not shuffled.  With keys its size follows the key set, so AQE decides
    # from runtime statistics (it broadcasts a small key set such as sources).
    # ``few_keys``: the caller knows that there are few, so the rows are never
    # dealt by them (a join by few keys has as many tasks).
    return df.join(F.broadcast(newest) if few_keys or not keys else newest, on=[*keys, date], how="left_semi")


def latest_per_key_in_snapshot(
    df: DataFrame,
    item_keys: Sequence[str],
    date: str = "date",
    keys: Sequence[str] = (),
    order: Sequence[Column | str] = ("etl_time",),
    tiebreak: Sequence[Column | str] = (),
    few_keys: bool = False,
) -> DataFrame:
    """Newest snapshot (per ``keys``), then the newest row per item inside it."""
    snap = latest_snapshot(df, date=date, keys=keys, few_keys=few_keys)
    return dedup_latest(snap, [*keys, *item_keys], order=order, tiebreak=tiebreak)
