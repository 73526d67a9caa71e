"""Queries for categorisation, reporting, dashboard summaries and streaming ingest."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import labels as lb
from ledgerflow.operators import report as rp
from ledgerflow.operators import rollup, rules
from ledgerflow.plans import fixtures as fx
from ledgerflow.plans import models as m
from ledgerflow.plans.catalog import query
from ledgerflow.plans.oracle_views import OVERRIDE, TX_ID, pct, view, with_views
from ledgerflow.plans.q_models import _dwd_tx, _history
from ledgerflow.plans.q_parsing import TRANSACTIONS_SQL
from ledgerflow.schemas import BANK_TRANSACTIONS
from ledgerflow.session import scratch_path
from ledgerflow.sources import payloads
from ledgerflow.sources.tables import split_rejects
from ledgerflow.streaming.ingest import idempotent_append, ingest_stream
from ledgerflow.streaming.statements import landed, stream_statements

STATUS_DATE = "2024-01-15"
TOP_MONTH = "1998-07"
LOADED = dt.datetime(2024, 1, 15, 22, 0)

# ------------------------------------------------------------------ C1-C6

view("tx_batched", """
SELECT *, cast((row_index // 40) AS integer) AS batch, cast(row_index % 40 AS integer) AS batch_index FROM (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY etl_time, description) - 1 AS row_index FROM tx)""", ("tx",))

view("replies", """
SELECT source_file, batch,
       CASE WHEN batch % 2 = 1 THEN '```json' || chr(10) || j || chr(10) || '```' ELSE j END AS reply
FROM (SELECT source_file, batch,
             cast(to_json(list({'index': batch_index, 'category': category} ORDER BY batch_index)) AS varchar) AS j
      FROM tx_batched WHERE category IS NOT NULL GROUP BY source_file, batch)""", ("tx_batched",))

view("reply_labels", """
SELECT source_file, batch, cast(batch * 40 + it.index AS integer) AS row_index, it.category AS category FROM (
  SELECT source_file, batch, unnest(from_json(body, '[{"index":"INTEGER","category":"VARCHAR"}]')) AS it FROM (
    SELECT source_file, batch,
      CASE WHEN starts_with(t, '```') THEN trim(CASE WHEN contains(a, '```') THEN regexp_extract(a, '(?s)^(.*)```', 1) ELSE a END, ' ' || chr(9) || chr(13) || chr(10))
           ELSE t END AS body
    FROM (SELECT *, regexp_extract(t, '(?s)^[^\\n]*\\n(.*)$', 1) AS a FROM (
      SELECT source_file, batch, trim(reply, ' ' || chr(9) || chr(13) || chr(10)) AS t FROM replies))))""", ("replies",))


def _batched(spark, d):
    return lb.assign_batches(fx.tx(spark, d))


def _replies(spark, d):
    b = _batched(spark, d).filter(F.col("category").isNotNull())
    g = b.groupBy("source_file", "batch").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(F.col("batch_index").alias("index"), "category")))).alias("j"))
    fence = F.concat(F.lit("```json\n"), F.col("j"), F.lit("\n```"))
    return g.select("source_file", "batch", F.when(F.col("batch") % 2 == 1, fence).otherwise(F.col("j")).alias("reply"))


@query("assign_batches", with_views("SELECT source_file, description, row_index, batch, batch_index FROM tx_batched", ["tx_batched"]))
def q_assign_batches(spark, d):
    return _batched(spark, d).select("source_file", "description", F.col("row_index").cast("bigint").alias("row_index"),
                                     "batch", "batch_index")


@query("assign_batches_one_load", with_views("""
SELECT source_file, description, row_index, cast(row_index // 40 AS integer) AS batch, cast(row_index % 40 AS integer) AS batch_index FROM (
  SELECT source_file, description, row_number() OVER (PARTITION BY source_file ORDER BY description, etl_time) - 1 AS row_index FROM (
    SELECT CASE WHEN substr(source_file, 11, 2) <= '04' THEN 'all.pdf' ELSE source_file END AS source_file, description, etl_time FROM tx))""", ["tx"]))
def q_assign_batches_one_load(spark, d):
    """Each statement loaded at one time, one of them with a third of all rows."""
    hot = F.when(F.substring("source_file", 11, 2) <= "04", F.lit("all.pdf")).otherwise(F.col("source_file"))
    tx = fx.tx(spark, d).withColumn("source_file", hot).withColumnRenamed("etl_time", "delivered").withColumn("etl_time", F.lit(LOADED).cast("timestamp_ntz"))
    out = lb.assign_batches(tx, order=("etl_time", "description", "delivered"), strategy="ranked")
    return out.select("source_file", "description", F.col("row_index").cast("bigint").alias("row_index"), "batch", "batch_index")


@query("build_request", with_views("""
SELECT source_file, batch, 'Classify these transactions:' || chr(10) || chr(10) || string_agg(
  cast(batch_index AS varchar) || '. Date: ' || date || ' | Description: ' || description || ' | Amount: '
    || regexp_replace(regexp_replace(cast(cast(amount AS decimal(18,2)) AS varchar), '0$', ''), '[.]$', '.0'),
  chr(10) ORDER BY batch_index) AS request
FROM tx_batched GROUP BY source_file, batch""", ["tx_batched"]))
def q_build_request(spark, d):
    return lb.build_request(_batched(spark, d))


@query("parse_reply", with_views("SELECT * FROM reply_labels", ["reply_labels"]))
def q_parse_reply(spark, d):
    return lb.parse_reply(_replies(spark, d))


@query("quarantine_replies", with_views("""
SELECT source_file, batch, n AS n_items, CASE batch % 5 WHEN 1 THEN 'not a JSON array' WHEN 2 THEN 'an item without index or category' END AS reason
FROM (SELECT source_file, batch, count(*) AS n FROM tx_batched WHERE category IS NOT NULL GROUP BY source_file, batch)""", ["tx_batched"]))
def q_quarantine_replies(spark, d):
    """Replies that can be used (with their labels) and rejects, from one evaluation; together all replies."""
    r = _replies(spark, d)
    n = F.size(F.split("reply", '"index"')) - 1
    spoilt = F.when(F.col("batch") % 5 == 1, F.lit("I can't do that.")).when(
        F.col("batch") % 5 == 2, F.regexp_replace("reply", '"category":"[^"]*"}\\]', '"label":"x"}]')).otherwise(F.col("reply"))
    checked = lb.checked_replies(r.withColumn("n_items", n.cast("bigint")).withColumn("reply", spoilt))
    good, rejects = split_rejects(checked, scratch_path(spark, f"replies-{uuid.uuid4().hex[:12]}"))
    labelled = lb.parse_reply(good).groupBy("source_file", "batch").agg(F.count("*").alias("n_items"))
    return labelled.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects.drop("reply"))


@query("attach_label", with_views("""
SELECT b.source_file, cast(b.row_index AS bigint) AS row_index, b.description, coalesce(l.category, 'Other') AS category
FROM tx_batched b LEFT JOIN reply_labels l ON b.source_file = l.source_file AND b.row_index = l.row_index""",
    ["tx_batched", "reply_labels"]))
def q_attach_label(spark, d):
    labels = lb.parse_reply(_replies(spark, d))
    out = lb.attach_label(_batched(spark, d), labels)
    return out.select("source_file", F.col("row_index").cast("bigint").alias("row_index"), "description", "category")


_DOMAIN_SQL = ", ".join(f"'{c}'" for c in rules.CATEGORY_DOMAIN)


@query("category_domain", with_views(f"""
SELECT source_file, description, category FROM (SELECT source_file, description, {OVERRIDE} AS category FROM tx)
WHERE category IS NOT NULL AND category NOT IN ({_DOMAIN_SQL})""", ["tx"]))
def q_category_domain(spark, d):
    over = rules.apply_rules(fx.tx(spark, d)).select("source_file", "description", "category")
    return rules.category_domain(over)


_KW_SQL = "CASE " + " ".join(f"WHEN contains(upper(description), '{kw}') THEN '{lab}'" for kw, lab in lb.KEYWORD_RULES) + " ELSE 'Other' END"


ORACLE_CLASSIFY = with_views(f"""
SELECT source_file, cast(row_index AS bigint) AS row_index, description, {_KW_SQL} AS category FROM tx_batched""", ["tx_batched"])


@query("classify_rules", ORACLE_CLASSIFY)
def q_classify_rules(spark, d):
    out = lb.classify_keywords(_batched(spark, d))
    return out.select("source_file", F.col("row_index").cast("bigint").alias("row_index"), "description", "category")


# ------------------------------------------------------------------ P11, Q1-Q3, A12

@query("source_status", with_views(f"""
SELECT run_date, source, status, row_count, message FROM run_status
WHERE run_date = DATE '{STATUS_DATE}' AND pipeline = 'investment'""", ["run_status"]))
def q_source_status(spark, d):
    return rp.source_status(fx.run_status(spark, d), STATUS_DATE)


def _event_tables(spark, d):
    """Per day and event type: the newest event ('table last modified'), checked at 06:00 UTC next day."""
    e = fx.table(spark, d, "events")
    g = e.groupBy(F.col("ts").cast("date").alias("run_date"), F.col("event_type").alias("table")).agg(F.max("ts").alias("last_modified"))
    as_of = (F.date_add("run_date", 1).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(6), F.lit(0), F.lit(0)))
    return g.withColumn("as_of", as_of)


view("event_fresh", """
SELECT run_date, "table", last_modified,
       last_modified >= start AS fresh,
       CASE WHEN last_modified >= start THEN strftime(last_modified + INTERVAL 8 HOUR, '%H:%M') END AS updated_local,
       CASE WHEN last_modified < start THEN date_diff('microsecond', last_modified, as_of) // 3600000000 END AS age_hours
FROM (SELECT *, cast(cast(as_of + INTERVAL 8 HOUR AS date) AS timestamp) - INTERVAL 8 HOUR AS start FROM (
  SELECT cast(ts AS date) AS run_date, event_type AS "table", max(ts) AS last_modified,
         cast(cast(ts AS date) + 1 AS timestamp) + INTERVAL 6 HOUR AS as_of
  FROM events GROUP BY 1, 2))""")


def _fresh(spark, d):
    t = _event_tables(spark, d)
    return rp.freshness(t, F.col("as_of")).drop("as_of")


@query("freshness", with_views("SELECT * FROM event_fresh", ["event_fresh"]))
def q_freshness(spark, d):
    return _fresh(spark, d)


view("verdicts", """
SELECT coalesce(s.run_date, t.run_date) AS run_date,
  CASE WHEN s.has_failed = 1 OR coalesce(t.n_tables, 0) = 0 OR t.all_fresh = 0 THEN 'action'
       WHEN s.has_fallback = 1 THEN 'warn'
       WHEN coalesce(s.n_status, 0) = 0 THEN 'unknown' ELSE 'clear' END AS verdict
FROM (SELECT run_date, max(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS has_failed,
             max(CASE WHEN status = 'fallback' THEN 1 ELSE 0 END) AS has_fallback, count(*) AS n_status
      FROM run_status GROUP BY run_date) s
FULL JOIN (SELECT run_date, min(CASE WHEN fresh THEN 1 ELSE 0 END) AS all_fresh, count(*) AS n_tables
           FROM event_fresh GROUP BY run_date) t ON s.run_date = t.run_date""", ("run_status", "event_fresh"))


@query("pipeline_verdict", with_views("SELECT * FROM verdicts", ["verdicts"]))
def q_pipeline_verdict(spark, d):
    return rp.overall_verdict(fx.run_status(spark, d), _fresh(spark, d))


_VERDICT_TEXT = "CASE verdict " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rp.VERDICTS.items()) + " END"
_ICON = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rp.STATUS_ICONS.items()) + f" ELSE '{rp.UNKNOWN_ICON}' END"


@query("report_lines", with_views(f"""
SELECT run_date, row_number() OVER (PARTITION BY run_date ORDER BY section, sort, line) AS line_no, line FROM (
  SELECT run_date, 10 AS section, source AS sort,
         {_ICON.format(c="status")} || ' ' || upper(source)
           || CASE WHEN row_count IS NOT NULL THEN ' — ' || cast(row_count AS varchar) || ' positions' ELSE '' END
           || ' (' || status || ')' AS line
  FROM run_status WHERE source <> 'fx'
  UNION ALL
  SELECT run_date, 20, '', {_ICON.format(c="min(status)")} || ' FX Rates (' || min(status) || ')'
  FROM run_status WHERE source = 'fx' GROUP BY run_date
  UNION ALL
  SELECT run_date, 30, "table",
         CASE WHEN fresh THEN '✅ ' || "table" || ' — updated ' || updated_local || ' SGT'
              ELSE '❌ ' || "table" || ' — stale (' || cast(age_hours AS varchar) || 'h old)' END
  FROM event_fresh
  UNION ALL
  SELECT run_date, 40, '', {_VERDICT_TEXT} FROM verdicts)""", ["run_status", "event_fresh", "verdicts"]))
def q_report_lines(spark, d):
    status = fx.run_status(spark, d)
    fresh = _fresh(spark, d)
    return rp.report_lines(status, fresh, rp.overall_verdict(status, fresh))


view("daily_runs", """
SELECT cast(ts AS date) AS run_date, event_type, max(ts) AS last, count(*) AS n, (date_diff('day', DATE '1970-01-01', cast(ts AS date))) % 7 AS kind
FROM events GROUP BY cast(ts AS date), event_type""")
view("daily_status", """
SELECT run_date, CASE WHEN event_type = 'purchase' THEN 'fx' ELSE event_type END AS source,
  CASE WHEN kind = 1 AND length(event_type) % 2 = 1 THEN 'fallback' WHEN kind = 2 AND length(event_type) % 2 = 1 THEN 'failed' ELSE 'live' END AS status,
  CASE WHEN event_type <> 'purchase' THEN n END AS row_count
FROM daily_runs WHERE kind IN (0, 1, 2, 3, 5)""", ("daily_runs",))
# The report's local day (eight hours ahead) began at 16:00 UTC; all loads are of 22:00 to 22:59 UTC, a day earlier in kind 3.
view("daily_tables", """
SELECT run_date, 'ads_' || event_type AS "table", kind <> 3 AS fresh,
  CASE WHEN kind = 3 THEN '❌ ads_' || event_type || ' — stale (' || cast(24 + CASE WHEN minute(last) * 60 + floor(second(last)) <= 1800 THEN 1 ELSE 0 END AS varchar) || 'h old)'
       ELSE '✅ ads_' || event_type || ' — updated 06:' || lpad(cast(minute(last) AS varchar), 2, '0') || ' SGT' END AS line
FROM daily_runs WHERE kind IN (0, 1, 2, 3, 4)""", ("daily_runs",))
view("daily_verdicts", """
SELECT run_date, CASE WHEN s.failed OR t.fresh IS NOT TRUE THEN 'action' WHEN s.fallback THEN 'warn' WHEN s.run_date IS NULL THEN 'unknown' ELSE 'clear' END AS verdict
FROM (SELECT DISTINCT run_date FROM daily_runs) d
LEFT JOIN (SELECT run_date, bool_or(status = 'failed') AS failed, bool_or(status = 'fallback') AS fallback FROM daily_status GROUP BY run_date) s USING (run_date)
LEFT JOIN (SELECT run_date, bool_and(fresh) AS fresh FROM daily_tables GROUP BY run_date) t USING (run_date)""",
     ("daily_runs", "daily_status", "daily_tables"))


def _daily_report(spark, d):
    days, status, tables = fx.daily_runs(spark, d)
    return rp.report_message(days, status, rp.freshness(tables, F.col("as_of")).drop("as_of"))


@query("daily_verdicts", with_views("SELECT * FROM daily_verdicts", ["daily_verdicts"]))
def q_daily_verdicts(spark, d):
    """All four verdicts, days without status, without tables and without either."""
    return _daily_report(spark, d).select("run_date", "verdict")


@query("report_message", with_views(f"""
SELECT run_date, concat_ws(chr(10),
  '{rp.REPORT_TITLE} — ' || strftime(run_date, '%a %d %b %Y'), '', '{rp.SOURCES_HEADING}', coalesce(b.lines, '{rp.NO_STATUS}'), f.line, '',
  '{rp.TABLES_HEADING}', coalesce(t.lines, '{rp.NO_TABLES}'), '', '{rp.RULE}', {_VERDICT_TEXT}) AS message
FROM daily_verdicts
LEFT JOIN (SELECT run_date, string_agg({_ICON.format(c="status")} || ' ' || upper(source) || ' — ' || row_count || ' positions (' || status || ')',
             chr(10) ORDER BY source) AS lines FROM daily_status WHERE source <> 'fx' GROUP BY run_date) b USING (run_date)
LEFT JOIN (SELECT run_date, {_ICON.format(c="status")} || ' FX Rates (' || status || ')' AS line FROM daily_status WHERE source = 'fx') f USING (run_date)
LEFT JOIN (SELECT run_date, string_agg(line, chr(10) ORDER BY "table") AS lines FROM daily_tables GROUP BY run_date) t USING (run_date)""",
    ["daily_verdicts", "daily_status", "daily_tables"]))
def q_report_message(spark, d):
    return _daily_report(spark, d).select("run_date", "message")


# ------------------------------------------------------------------ Q4-Q6, O2, O3

def _monthly(spark, d):
    return m.net_worth_monthly(_history(spark, d))


_KPI_METRICS = ("total_net_worth_sgd", "investment_sgd", "cash_sgd", "total_cpf_sgd")


@query("kpis", with_views("SELECT date, " + ", ".join(
    f"{c}, CASE WHEN prev_{c} <> 0 THEN {pct(f'{c} - prev_{c}', f'prev_{c}')} END AS {c}_mom_pct" for c in _KPI_METRICS) + """
FROM (SELECT *, """ + ", ".join(f"lag({c}) OVER (ORDER BY date) AS prev_{c}" for c in _KPI_METRICS) + """ FROM nw_monthly)
WHERE date = (SELECT max(date) FROM nw_monthly)""", ["nw_monthly"]))
def q_kpis(spark, d):
    return rp.kpis(_monthly(spark, d), _KPI_METRICS)


ALLOCATION = {"investments": ("stocks_sgd", "crypto_sgd"), "cash": ("cash_sgd",),
              "endowus": ("endowus_principal_sgd",), "cpf": ("cpf_oa_sgd", "cpf_sa_sgd", "cpf_ma_sgd")}


def _alloc_sql():
    parts = []
    for name, cols in ALLOCATION.items():
        v = " + ".join(f"coalesce(cast({c} AS decimal(18,2)), 0)" for c in cols)
        parts.append(f"SELECT date, '{name}' AS asset_class, cast({v} AS double) AS value FROM latest")
    return "\nUNION ALL\n".join(parts)


@query("allocation", with_views(f"""
SELECT date, asset_class, value, {pct('value', 'total')} AS share_pct
FROM (SELECT *, sum(cast(value AS decimal(18,2))) OVER (PARTITION BY date) AS total FROM alloc)""",
    ["nw_monthly"], {"latest": "SELECT * FROM nw_monthly WHERE date = (SELECT max(date) FROM nw_monthly)",
                     "alloc": _alloc_sql()}))
def q_allocation(spark, d):
    return rp.allocation(_monthly(spark, d), ALLOCATION)


@query("account_breakdown", with_views(f"""
SELECT date, source, value, {pct('value', 'total')} AS share_pct
FROM (SELECT *, sum(cast(value AS decimal(18,2))) OVER (PARTITION BY date) AS total FROM (
  SELECT date, source, cast(round(sum(cast(market_value_sgd AS decimal(18,2))), 2) AS double) AS value
  FROM nw_history WHERE date = (SELECT max(date) FROM nw_history) GROUP BY date, source))""", ["nw_history"]))
def q_account_breakdown(spark, d):
    return rp.breakdown(_history(spark, d))


@query("top_merchants", with_views(f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY total DESC, description, category) AS rank, description, category,
         cast(total AS double) AS total_spend, tx_count
  FROM (SELECT description, category, round(sum(abs(cast(amount AS decimal(18,2)))), 2) AS total, count(*) AS tx_count
        FROM dwd_tx WHERE year_month = '{TOP_MONTH}' AND amount < 0 GROUP BY description, category))
WHERE rank <= 5""", ["dwd_tx"]))
def q_top_merchants(spark, d):
    out = rollup.top_merchants(_dwd_tx(spark, d), TOP_MONTH, k=5)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("recent_transactions", with_views("""
SELECT transaction_id, transaction_date, description, amount, category, rank FROM (
  SELECT *, row_number() OVER (ORDER BY transaction_date DESC, transaction_id DESC) AS rank FROM dwd_tx)
WHERE rank <= 10""", ["dwd_tx"]))
def q_recent_transactions(spark, d):
    out = rollup.recent_transactions(_dwd_tx(spark, d), k=10)
    return out.select("transaction_id", "transaction_date", "description", "amount", "category",
                      F.col("rank").cast("bigint").alias("rank"))


# ------------------------------------------------------------------ S8, S16

@query("file_arrival_stream", with_views(f"SELECT {TX_ID} AS transaction_id, * FROM tx", ["tx"]))
def q_file_arrival_stream(spark, d):
    """Statements arrive as files (one per month); one is delivered twice under a new name.

    The stream appends each transaction once: re-deliveries and replayed
    micro-batches are removed by the key anti join.
    """
    root = scratch_path(spark, f"inbox-{uuid.uuid4().hex[:12]}")
    inbox, target, ckpt = f"{root}/inbox", f"{root}/ods_bank_transactions_df", f"{root}/_checkpoint"
    raw = fx.tx(spark, d)
    t = raw.withColumn("transaction_id", m.tx_id(raw))
    t.repartition(8, "source_file").write.mode("append").parquet(inbox)
    schema = T.StructType(BANK_TRANSACTIONS.fields + [T.StructField("transaction_id", T.StringType(), True)])
    handler = idempotent_append(target, schema, ["transaction_id", "etl_time"])
    ingest_stream(spark, inbox, schema, handler, ckpt, glob="*.parquet")
    # re-delivery: some statements arrive again as new files
    t.filter(F.col("source_file") < "stmt_1996").write.mode("append").parquet(inbox)
    ingest_stream(spark, inbox, schema, handler, ckpt, glob="*.parquet")
    return spark.read.parquet(target)


def _deliver(spark, d) -> str:
    """All statements arrive as files of words; then some arrive again, under their own and under other names, and a second
    loader meets the same files.  Returns the target."""
    root = scratch_path(spark, f"statements-{uuid.uuid4().hex[:12]}")
    inbox, target = f"{root}/inbox", f"{root}/target"
    words = fx.statement_words(spark, d, "savings").unionByName(fx.statement_words(spark, d, "credit_card"))
    words.repartition(6, "source_file").write.mode("append").parquet(inbox)
    stream_statements(spark, inbox, target, f"{root}/first", "first", LOADED, max_files=3)
    early = F.regexp_extract("source_file", r"_(\d{4})_", 1) < "1994"
    again = words.filter(early).withColumn("source_file", F.concat(F.lit("again_"), F.col("source_file"))).unionByName(words.filter(early))
    again.repartition(2, "source_file").write.mode("append").parquet(inbox)
    stream_statements(spark, inbox, target, f"{root}/first", "first", LOADED)
    stream_statements(spark, inbox, target, f"{root}/second", "second", LOADED)
    return target


@query("stream_statements", with_views(f"""
SELECT source_file, date, description, transaction_type, amount, 'SGD' AS currency, {_KW_SQL} AS category FROM ({TRANSACTIONS_SQL[0]})""",
    *TRANSACTIONS_SQL[1:]))
def q_stream_statements(spark, d):
    """Transactions landed by a stream of statement words, each statement once however often it arrives."""
    return landed(spark, _deliver(spark, d), "transactions").drop("etl_time")


@query("stream_balances", with_views(f"""
SELECT 'bank_savings' AS source, source_file, strftime(cast(strptime(first_date, '%d %b %Y') AS date), '%Y-%m') AS statement_date,
       closing_balance AS balance, 'SGD' AS currency
FROM (SELECT source_file, arg_min(date, page * 1000000 + top) AS first_date FROM ({TRANSACTIONS_SQL[0]}) GROUP BY source_file)
JOIN stmt_facts USING (source_file) WHERE closing_balance IS NOT NULL""", *TRANSACTIONS_SQL[1:]))
def q_stream_balances(spark, d):
    """Closing balances landed by the same stream: none of statements without transactions, none twice."""
    return landed(spark, _deliver(spark, d), "balances").drop("etl_time")


@query("read_holdings_csv", with_views("""
SELECT DATE '1998-12-31' AS date, cast(o_orderdate AS date) AS issue_date,
       cast(o_orderdate + INTERVAL 120 MONTH AS date) AS maturity_date, 'GX' || cast(o_orderkey AS varchar) AS issue_code,
       round(o_totalprice, 2) AS face_value, 'SGD' AS currency FROM orders"""))
def q_read_holdings_csv(spark, d):
    """Bond holdings snapshots written as CSV from orders and read back with the fixed schema."""
    path = scratch_path(spark, f"holdings-{uuid.uuid4().hex[:12]}")
    o = fx.table(spark, d, "orders")
    h = o.select(
        F.lit(None).cast("date").alias("date"),
        F.col("o_orderdate").cast("date").alias("issue_date"),
        F.add_months(F.col("o_orderdate").cast("date"), 120).alias("maturity_date"),
        F.concat(F.lit("GX"), F.col("o_orderkey").cast("string")).alias("issue_code"),
        F.round(F.col("o_totalprice"), 2).alias("face_value"),
        F.lit("SGD").alias("currency"))
    h.write.mode("overwrite").option("header", True).csv(path)
    return payloads.read_holdings_csv(spark, path, as_of="1998-12-31")


@query("classify_batches", ORACLE_CLASSIFY)
def q_classify_batches(spark, d):
    """The same classifier driven once per 40-row batch (the remote-model calling pattern)."""
    out = lb.classify(_batched(spark, d).select("source_file", "batch", "batch_index", "row_index", "description"),
                      per_batch=True)
    return out.select("source_file", F.col("row_index").cast("bigint").alias("row_index"), "description", "category")
