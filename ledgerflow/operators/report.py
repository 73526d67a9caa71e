"""Pipeline-health reporting and dashboard summaries.

Reports are small (a handful of sources and tables per run date) but are
computed as DataFrames keyed by run date, so a history of runs (or many
owners) is reported in one distributed job instead of a driver loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.money import money, pct_change, ratio_pct
from ledgerflow.operators.timeline import period_change

# Status icons and report texts.
STATUS_ICONS = {"live": "✅", "fallback": "⚠️", "failed": "❌"}
UNKNOWN_ICON = "❓"
VERDICTS = {
    "action": "❌ <b>Action needed</b> — check Cloud Run logs",
    "warn": "⚠️ Some sources used fallback data — live APIs may be down",
    "unknown": "❓ No pipeline status found — investment job may not have run",
    "clear": "✅ All clear — dashboard is up to date",
}
LOCAL_TZ = "Asia/Singapore"
# The parts of the daily message.
REPORT_TITLE = "📊 <b>Daily Report</b>"
SOURCES_HEADING = "<b>Investment Positions</b>"
TABLES_HEADING = "<b>dbt Build &amp; Dashboard</b>"
NO_STATUS = "❓ No status recorded — pipeline may not have run"
NO_TABLES = "❓ Could not check table freshness"
RULE = "──────────────────────"


def status_icon(status: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in STATUS_ICONS.items() for x in kv])
    return F.coalesce(m[status], F.lit(UNKNOWN_ICON))


def source_status(run_status: DataFrame, run_date=None, pipeline: str = "investment") -> DataFrame:
    """Status rows of one pipeline (optionally one run date), ordered by source."""
    df = run_status.filter(F.col("pipeline") == pipeline)
    if run_date is not None:
        df = df.filter(F.col("run_date") == F.lit(run_date).cast("date"))
    return df.select("run_date", "source", "status", "row_count", "message").orderBy("run_date", "source")


def _utc_to_local(ts: Column, tz: str) -> Column:
    """UTC wall-clock (TIMESTAMP_NTZ) -> wall-clock in ``tz``; independent of the session time zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz"))


def local_midnight_utc(as_of: Column, tz: str = LOCAL_TZ) -> Column:
    """UTC wall-clock of local midnight of the local day containing ``as_of`` (a UTC wall-clock)."""
    midnight = F.to_date(_utc_to_local(as_of, tz)).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), midnight)


def freshness(tables: DataFrame, as_of: Column, tz: str = LOCAL_TZ) -> DataFrame:
    """Per table: fresh when modified since local midnight of ``as_of``; else age in whole hours.

    ``tables`` has (table, last_modified) and may carry grouping columns;
    times are UTC wall-clock timestamps, so results do not depend on the
    session time zone.
    """
    lm = F.col("last_modified").cast("timestamp_ntz")
    start = local_midnight_utc(as_of, tz)
    age = F.floor(F.timestamp_diff("MICROSECOND", lm, as_of.cast("timestamp_ntz")) / F.lit(3_600_000_000)).cast("long")
    return tables.select(
        "*",
        (lm >= start).alias("fresh"),
        F.when(lm >= start, F.date_format(_utc_to_local(lm, tz), "HH:mm")).alias("updated_local"),
        F.when(lm < start, age).alias("age_hours"),
    )


def overall_verdict(status: DataFrame, fresh: DataFrame, keys: Sequence[str] = ("run_date",)) -> DataFrame:
    """Verdict per key: failed source or stale/missing table -> 'action';
    else fallback -> 'warn'; else no status -> 'unknown'; else 'clear'."""
    s = status.groupBy(*keys).agg(
        F.max((F.col("status") == "failed").cast("int")).alias("has_failed"),
        F.max((F.col("status") == "fallback").cast("int")).alias("has_fallback"),
        F.count(F.lit(1)).alias("n_status"))
    t = fresh.groupBy(*keys).agg(F.min(F.col("fresh").cast("int")).alias("all_fresh"), F.count(F.lit(1)).alias("n_tables"))
    j = s.join(t, list(keys), "full")
    stale = F.coalesce(F.col("n_tables"), F.lit(0)).eqNullSafe(0) | (F.col("all_fresh") == 0)
    verdict = (F.when((F.col("has_failed") == 1) | stale, F.lit("action"))
               .when(F.col("has_fallback") == 1, F.lit("warn"))
               .when(F.coalesce(F.col("n_status"), F.lit(0)) == 0, F.lit("unknown"))
               .otherwise(F.lit("clear")))
    return j.select(*keys, verdict.alias("verdict"))


def report_lines(status: DataFrame, fresh: DataFrame, verdicts: DataFrame, labels: Mapping[str, str] | None = None,
                 key: str = "run_date") -> DataFrame:
    """Message lines per run date with an explicit ``line_no`` order."""
    labels = labels or {}
    brokers = status.filter(F.col("source") != "fx")
    count = F.when(F.col("row_count").isNotNull(), F.concat(F.lit(" — "), F.col("row_count").cast("string"), F.lit(" positions"))).otherwise(F.lit(""))
    broker_lines = brokers.select(
        key, F.lit(10).alias("section"), F.col("source").alias("sort"),
        F.concat(status_icon(F.col("status")), F.lit(" "), F.upper("source"), count, F.lit(" ("), F.col("status"), F.lit(")")).alias("line"))
    fx_lines = status.filter(F.col("source") == "fx").groupBy(key).agg(F.min("status").alias("status")).select(
        key, F.lit(20).alias("section"), F.lit("").alias("sort"),
        F.concat(status_icon(F.col("status")), F.lit(" FX Rates ("), F.col("status"), F.lit(")")).alias("line"))
    lab = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]) if labels else None
    label = F.coalesce(lab[F.col("table")], F.col("table")) if lab is not None else F.col("table")
    table_lines = fresh.select(
        key, F.lit(30).alias("section"), F.col("table").alias("sort"),
        F.when(F.col("fresh"), F.concat(F.lit("✅ "), label, F.lit(" — updated "), F.col("updated_local"), F.lit(" SGT")))
         .otherwise(F.concat(F.lit("❌ "), label, F.lit(" — stale ("), F.col("age_hours").cast("string"), F.lit("h old)"))).alias("line"))
    vm = F.create_map(*[F.lit(x) for kv in VERDICTS.items() for x in kv])
    verdict_lines = verdicts.select(key, F.lit(40).alias("section"), F.lit("").alias("sort"), vm[F.col("verdict")].alias("line"))
    allx = broker_lines.unionByName(fx_lines).unionByName(table_lines).unionByName(verdict_lines)
    w = Window.partitionBy(key).orderBy("section", "sort", "line")
    return allx.withColumn("line_no", F.row_number().over(w).cast("long")).select(key, "line_no", "line")


def report_message(days: DataFrame, status: DataFrame, fresh: DataFrame, labels: Mapping[str, str] | None = None,
                   title: str = REPORT_TITLE, key: str = "run_date") -> DataFrame:
    """The whole daily message of every day in ``days``: (key, verdict, message).

    Parts in order, separated by blank lines: the title with the day; the
    sources (by name) or a note that no status was recorded, and the rates;
    the tables (by name) or a note that none could be checked; the verdict.
    A day that ``days`` lists and that neither input knows gets both notes.
    Everything is grouped by day, and a day has one line per source and table.
    """
    wanted = days.select(key).distinct()
    count = F.when(F.col("row_count").isNotNull(), F.concat(F.lit(" — "), F.col("row_count").cast("string"), F.lit(" positions"))).otherwise(F.lit(""))
    of_source = F.concat(status_icon(F.col("status")), F.lit(" "), F.upper("source"), count, F.lit(" ("), F.col("status"), F.lit(")"))
    is_rates = F.col("source") == "fx"
    rates = F.min(F.when(is_rates, F.col("status")))
    per_day = status.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(~is_rates, F.struct("source", of_source.alias("line"))))).alias("sources"),
        F.concat(status_icon(rates), F.lit(" FX Rates ("), rates, F.lit(")")).alias("rates"),
        F.max((F.col("status") == "failed").cast("int")).alias("has_failed"),
        F.max((F.col("status") == "fallback").cast("int")).alias("has_fallback"))
    lab = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]) if labels else None
    label = F.coalesce(lab[F.col("table")], F.col("table")) if lab is not None else F.col("table")
    of_table = (F.when(F.col("fresh"), F.concat(F.lit("✅ "), label, F.lit(" — updated "), F.col("updated_local"), F.lit(" SGT")))
                .otherwise(F.concat(F.lit("❌ "), label, F.lit(" — stale ("), F.col("age_hours").cast("string"), F.lit("h old)"))))
    tables = fresh.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("table", of_table.alias("line")))).alias("tables"),
        F.min(F.col("fresh").cast("int")).alias("all_fresh"))
    j = wanted.join(per_day, key, "left").join(tables, key, "left")
    none = F.array().cast("array<string>")
    lines = lambda c: F.coalesce(F.transform(c, lambda x: x["line"]), none)
    or_note = lambda found, note: F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(note)))
    verdict = (F.when((F.col("has_failed") == 1) | (F.coalesce(F.col("all_fresh"), F.lit(0)) == 0), F.lit("action"))
               .when(F.col("has_fallback") == 1, F.lit("warn"))
               .when(F.col("has_failed").isNull(), F.lit("unknown"))
               .otherwise(F.lit("clear")))
    texts = F.create_map(*[F.lit(x) for kv in VERDICTS.items() for x in kv])
    head = F.concat(F.lit(f"{title} — "), F.date_format(key, "EEE dd MMM yyyy"))
    parts = F.concat(
        F.array(head, F.lit(""), F.lit(SOURCES_HEADING)), or_note(lines("sources"), NO_STATUS),
        F.when(F.col("rates").isNotNull(), F.array("rates")).otherwise(none),
        F.array(F.lit(""), F.lit(TABLES_HEADING)), or_note(lines("tables"), NO_TABLES),
        F.array(F.lit(""), F.lit(RULE), texts[F.col("verdict")]))
    return j.withColumn("verdict", verdict).select(key, "verdict", F.array_join(parts, "\n").alias("message"))


# ------------------------------------------------------------------ dashboard summaries

def kpis(monthly: DataFrame, metrics: Sequence[str] = ("total_net_worth_sgd", "investment_sgd", "cash_sgd", "total_cpf_sgd"),
         keys: Sequence[str] = ()) -> DataFrame:
    """Latest month's totals with month-over-month % change (per owner)."""
    df = monthly
    for m in metrics:
        df = period_change(df, m, order=["date"], keys=keys, prev_col=None, delta_col=None, pct_col=f"{m}_mom_pct")
    w = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    latest = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
    return latest.select(*keys, "date", *[c for m in metrics for c in (m, f"{m}_mom_pct")])


def share_of_total(df: DataFrame, value: str = "value", keys: Sequence[str] = (), out: str = "share_pct", scale: int = 1) -> DataFrame:
    """value / sum(value) over the owner's rows, as a percentage (exact decimal)."""
    total = F.sum(money(value)).over(Window.partitionBy(*keys))
    return df.withColumn(out, ratio_pct(money(value), total, scale))


def latest_rows(df: DataFrame, date: str = "date", keys: Sequence[str] = (), bounded: bool = True) -> DataFrame:
    """Rows on each owner's newest date.

    ``bounded`` (a calendar-bounded series such as a monthly dashboard): one
    pass, the newest date as a window maximum per owner.  Otherwise the
    newest dates are an aggregate joined back (left semi), which never puts
    an owner's raw rows in one window.
    """
    if bounded:
        newest = F.max(date).over(Window.partitionBy(*keys))
        return df.withColumn("__newest", newest).filter(F.col(date) == F.col("__newest")).drop("__newest")
    agg = df.groupBy(*keys).agg(F.max(date).alias(date))
    return df.join(F.broadcast(agg) if not keys else agg, [*keys, date], "left_semi")


def allocation(monthly: DataFrame, classes: Mapping[str, Sequence[str]], keys: Sequence[str] = ()) -> DataFrame:
    """Latest month split by asset class with its share of the total."""
    latest = latest_rows(monthly, keys=keys)
    cols = [F.struct(F.lit(name).alias("asset_class"),
                     sum((F.coalesce(money(c), F.lit(0).cast("decimal(18,2)")) for c in src), F.lit(0).cast("decimal(18,2)")).alias("v"))
            for name, src in classes.items()]
    rows = latest.select(*keys, "date", F.explode(F.array(*cols)).alias("a"))
    rows = rows.select(*keys, "date", "a.asset_class", F.col("a.v").cast("double").alias("value"))
    return share_of_total(rows, "value", keys=[*keys, "date"])


def breakdown(history: DataFrame, by: str = "source", keys: Sequence[str] = ()) -> DataFrame:
    """Latest month's value per ``by`` with its share of the month's total."""
    latest = latest_rows(history, keys=keys, bounded=False)
    g = latest.groupBy(*keys, "date", by).agg(F.round(F.sum(money("market_value_sgd")), 2).cast("double").alias("value"))
    return share_of_total(g, "value", keys=[*keys, "date"])


__all__ = ["source_status", "freshness", "overall_verdict", "report_lines", "report_message", "kpis", "allocation", "breakdown",
           "share_of_total", "status_icon", "pct_change"]
