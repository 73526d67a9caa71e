"""Time-ordered operators: validity ranges, interval/as-of joins, carry-forward,
running totals and period-over-period change.

All windows are partitioned by the owner ``keys``.  With ``keys=[]`` they run
over one ordered series; callers only do that on already-aggregated input
(one row per date or month), whose size is bounded by the calendar, never on
raw rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_start
from ledgerflow.functions.money import money, pct_change

OPEN_END = _dt.date(9999, 12, 31)


def _running(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def to_ranges(
    df: DataFrame,
    date: str = "date",
    keys: Sequence[str] = (),
    next_col: str = "next_date",
    open_end: _dt.date = OPEN_END,
) -> DataFrame:
    """Add ``next_col`` = the next ``date`` of the same owner, or ``open_end``."""
    w = Window.partitionBy(*keys).orderBy(date)
    return df.withColumn(next_col, F.lead(F.col(date), 1, open_end).over(w))


def _joined_by(left: DataFrame, right: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """``left`` with ``value`` of the one ``right`` row of equal ``on`` (NULL equals NULL, as in a window's partitions)."""
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"__l.{c}").eqNullSafe(F.col(f"__r.{c}"))
    return left.alias("__l").join(right.alias("__r"), same, "left").select("__l.*", f"__r.{value}")


def fill_forward(df: DataFrame, cols: Sequence[str], order: Sequence[str] = ("date",), keys: Sequence[str] = (),
                 bucket: Column | None = None) -> DataFrame:
    """Replace NULLs by the latest earlier non-NULL value (per owner).

    With ``bucket``, an expression that never falls along ``order`` (such as the
    month of a leading date), an owner is carried in two levels, so that no
    task holds a whole owner: along each (owner, bucket), and from the last
    values of the buckets before it, one row per bucket.
    """
    if bucket is None:
        w = _running(keys, order)
        return df.select(
            *[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in cols else F.col(c) for c in df.columns]
        )
    b, own = "__bucket", [*keys, "__bucket"]
    rows = df.withColumn(b, bucket)
    at = F.struct(*order)
    ends = rows.groupBy(*own).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols])
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*own, F.struct(*[F.last(c, ignorenulls=True).over(before).alias(c) for c in cols]).alias("__in"))
    w = _running(own, order)
    inside = rows.select(b, *[F.last(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c) for c in df.columns])
    return _joined_by(inside, carried, own, "__in").select(
        *[F.coalesce(F.col(c), F.col(f"__in.{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def running_total(
    df: DataFrame,
    value: str,
    order: Sequence[str] = ("date",),
    keys: Sequence[str] = (),
    out: str | None = None,
    scale: int = 2,
    bucket: Column | None = None,
) -> DataFrame:
    """Cumulative sum (rows unbounded preceding..current), exact decimal, DOUBLE out.

    ``bucket``: as in :func:`fill_forward`; the totals of earlier buckets are added to the sum along the row's own.
    """
    if bucket is None:
        w = _running(keys, order)
        return df.withColumn(out or value, F.round(F.sum(money(value)).over(w), scale).cast("double"))
    b, own = "__bucket", [*keys, "__bucket"]
    rows = df.withColumn(b, bucket)
    sums = rows.groupBy(*own).agg(F.sum(money(value)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    earlier = sums.select(*own, F.sum("__n").over(before).alias("__in"))
    inside = rows.withColumn("__own", F.sum(money(value)).over(_running(own, order)))
    # A sum is NULL only where nothing but NULLs came before.
    total = F.coalesce(F.col("__own") + F.col("__in"), F.col("__own"), F.col("__in"))
    name = out or value
    joined = _joined_by(inside, earlier, own, "__in").withColumn("__total", F.round(total, scale).cast("double"))
    kept = [F.col("__total").alias(name) if c == name else F.col(c) for c in df.columns]
    return joined.select(*kept, *([] if name in df.columns else [F.col("__total").alias(name)]))


def period_change(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    keys: Sequence[str] = (),
    prev_col: str | None = "prev_value",
    delta_col: str | None = "delta",
    pct_col: str | None = "pct",
    delta_scale: int = 2,
    pct_scale: int = 1,
) -> DataFrame:
    """Previous row's value, rounded delta, and percent change (NULL if previous is 0/NULL).

    "Previous" is the previous existing row of the owner's series, not the
    previous calendar period.  The lag is computed once and reused.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    prev = "__prev"
    out = df.withColumn(prev, F.lag(F.col(value)).over(w))
    cur_d, prev_d = money(value), money(prev)
    if prev_col:
        out = out.withColumn(prev_col, F.col(prev))
    if delta_col:
        out = out.withColumn(delta_col, F.round(cur_d - prev_d, delta_scale).cast("double"))
    if pct_col:
        out = out.withColumn(pct_col, pct_change(cur_d, prev_d, pct_scale))
    return out.drop(prev)


def _bin(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day.cast("date")) / F.lit(days)).cast("long")


def interval_join(
    left: DataFrame,
    ranges: DataFrame,
    point: Column | str,
    lo: str = "date",
    hi: str = "next_date",
    keys: Sequence[str] = (),
    how: str = "left",
    bin_days: int = 32,
) -> DataFrame:
    """Left rows joined to every range with ``lo <= point < hi`` (same owner keys), by range binning.

    The calendar is cut into bins of ``bin_days`` days.  A left row lies in one
    bin; a range becomes one row per bin that it touches, so the join is an
    equi-join on (keys, bin) with the exact range as a residual condition, and
    an owner with a huge share of the rows is spread over its bins.  Ranges are
    first clipped to the span of the left points (read in one pass over the
    point column), so an open end costs no bins beyond the data.  A range
    touches each bin once, so no match appears twice; a point in no range, or
    a NULL one, stays (``how='left'``) with NULLs.  ``how``: any type of
    join that keeps the left rows' side ('inner', 'left', 'left_semi', 'left_anti').

    Columns: the left ones, then those of ``ranges`` without the keys.  Dates
    and timestamps may be mixed.
    """
    p = F.col(point) if isinstance(point, str) else point
    b, at = "__bin", "__point"
    own = left.withColumn(at, p).withColumn(b, _bin(F.col(at), bin_days))
    span = own.agg(F.min(b).alias("first"), F.max(b).alias("last"))
    first, last = (span.select(c).scalar() for c in ("first", "last"))
    touched = F.sequence(F.greatest(_bin(F.col(lo), bin_days), first), F.least(_bin(F.col(hi), bin_days), last))
    reached = (_bin(F.col(lo), bin_days) <= last) & (_bin(F.col(hi), bin_days) >= first) & (F.col(lo) < F.col(hi))
    # Without a span (no left row) the condition is NULL and no range is left.
    binned = ranges.filter(reached).withColumn(b, F.explode(touched)).alias("__r")
    own = own.alias("__l")
    cond = (F.col(f"__l.{b}") == F.col(f"__r.{b}")) & (F.col(f"__l.{at}") >= F.col(f"__r.{lo}")) & (F.col(f"__l.{at}") < F.col(f"__r.{hi}"))
    for k in keys:
        cond = cond & (F.col(f"__l.{k}") == F.col(f"__r.{k}"))
    extra = [] if how in ("left_semi", "left_anti") else [F.col(f"__r.{c}") for c in ranges.columns if c not in keys]
    return own.join(binned, cond, how).select(*[F.col(f"__l.{c}") for c in left.columns], *extra)


def month_asof_join(
    left: DataFrame,
    right: DataFrame,
    left_date: str,
    right_date: str,
    value_cols: Sequence[str],
    keys: Sequence[str] = (),
    strategy: str = "carry",
) -> DataFrame:
    """Attach to each left row the ``right`` values of the latest ``right_date <= month(left_date)``.

    Equivalent to the range join ``month(l) >= r.date and month(l) < next(r.date)``
    when ``right`` has one row per (keys, month); no non-equi join is used.

    ``strategy='carry'`` (for calendar-bounded left sides such as one row per
    day): left and right rows are unioned into one series per owner, the
    right values are carried forward along it and the left rows kept -- one
    pass over each side, one shuffle on ``keys``.
    ``strategy='months'`` (for raw-row left sides): only the distinct
    (keys, month) of the left side enter the carry-forward, and the values
    are attached back with an equi-join on (keys, month), so a hot owner's
    rows never meet in one window.
    """
    mcol, tag = "__month", "__is_left"
    typed_nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in value_cols]
    r = right.select(*keys, F.col(right_date).alias(mcol), *value_cols, F.lit(False).alias(tag))
    w = Window.partitionBy(*keys).orderBy(F.col(mcol), F.col(tag)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if strategy == "carry":
        extra = [c for c in left.columns if c not in keys]
        lrows = left.select(*keys, month_start(left_date).alias(mcol), *typed_nulls, F.lit(True).alias(tag),
                            F.struct(*extra).alias("__row"))
        both = r.withColumn("__row", F.lit(None).cast(lrows.schema["__row"].dataType)).unionByName(lrows)
        carried = both.select(*keys, tag, "__row", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in value_cols])
        return carried.filter(F.col(tag)).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in extra], *value_cols)
    if strategy != "months":
        raise ValueError(f"unknown strategy {strategy!r}")
    months = left.select(*keys, month_start(left_date).alias(mcol)).distinct()
    lm = months.select(*keys, mcol, *typed_nulls, F.lit(True).alias(tag))
    carried = (
        r.unionByName(lm)
        .select(*keys, mcol, tag, *[F.last(c, ignorenulls=True).over(w).alias(c) for c in value_cols])
        .filter(F.col(tag))
        .drop(tag)
    )
    return left.withColumn(mcol, month_start(left_date)).join(carried, on=[*keys, mcol], how="left").drop(mcol)


def month_join(
    left: DataFrame,
    right: DataFrame,
    left_date: str,
    right_date: str = "date",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Left join on the left date's month start == ``right_date`` (plus owner keys)."""
    mcol = "__month"
    r = right.withColumnRenamed(right_date, mcol)
    return left.withColumn(mcol, month_start(left_date)).join(r, on=[*keys, mcol], how="left").drop(mcol)


def flag_previous_month(df: DataFrame, as_of: _dt.date | str, ym: str = "year_month", out: str = "is_previous_month") -> DataFrame:
    """``ym`` equals the calendar month before ``as_of`` (explicit date, never the wall clock)."""
    as_of_d = F.lit(as_of).cast("date")
    prev = F.date_format(F.add_months(F.trunc(as_of_d, "MM"), -1), "yyyy-MM")
    return df.withColumn(out, F.col(ym) == prev)
