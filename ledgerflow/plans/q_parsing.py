"""Queries for statement parsing, payload readers, sources and sinks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ledgerflow.operators import fx as fxops
from ledgerflow.operators import rollup, statements as st
from ledgerflow.plans import fixtures as fx
from ledgerflow.plans import runs
from ledgerflow.plans.catalog import query
from ledgerflow.plans.oracle_views import view, with_views
from ledgerflow.schemas import BANK_TRANSACTIONS
from ledgerflow.session import scratch_path
from ledgerflow.sources import events as ev
from ledgerflow.sources import payloads, tables

# ------------------------------------------------------------------ oracle views: savings words

view("sav_base", """
SELECT 'sav_' || strftime(o_orderdate, '%Y') || '_' || cast(o_orderkey // 1024 AS varchar) || '.pdf' AS source_file,
       cast((o_orderkey % 1024) // 32 + 1 AS integer) AS page,
       cast(100 + (o_orderkey % 32) * 24 AS double) AS base, o_orderkey AS k, o_orderdate, o_totalprice,
       strftime(o_orderdate, '%d') AS day, strftime(o_orderdate, '%b') AS mon,
       format('{:,.2f}', cast(o_totalprice AS decimal(18,2))) AS amt
FROM orders""")

_SAV_WORDS = [
    (0, 20, 32, "day", "true"), (0, 40, 60, "mon", "true"),
    (0, 80, 120, "CASE k % 4 WHEN 0 THEN 'Inward' WHEN 1 THEN 'Bill' ELSE 'Misc' END", "k % 4 <> 2"),
    (0, 125, 165, "CASE k % 4 WHEN 0 THEN 'Credit' WHEN 1 THEN 'Payment' ELSE 'Debit' END", "k % 4 <> 2"),
    (0, 310, 350, "amt", "k % 7 <> 0 AND k % 5 < 3"), (0, 410, 450, "amt", "k % 7 <> 0 AND k % 5 >= 3"),
    (0, 515, 555, "amt", "k % 2 = 0"),
    (12, 80, 110, "'Shop'", "true"), (12, 115, 150, "cast(k AS varchar)", "true"),
    (12, 310, 350, "amt", "k % 7 = 0 AND k % 5 < 3"), (12, 410, 450, "amt", "k % 7 = 0 AND k % 5 >= 3"),
    (18, 80, 130, "'PIB' || cast(k AS varchar)", "k % 3 = 0"),
]
_SAV_PAGE_WORDS = [(40, 20, 50, "'Page'"), (40, 55, 65, "cast(page AS varchar)"), (60, 20, 45, "'Date'"),
                   (60, 80, 150, "'Description'"), (60, 300, 360, "'Withdrawals'"), (60, 405, 455, "'Deposits'"),
                   (60, 505, 565, "'Balance'")]
_SAV_FILE_WORDS = [(10, 20, 80, "'Statement'"), (10, 85, 100, "'of'"), (10, 105, 160, "'Account'"),
                   (20, 20, 60, "'Period:'"), (20, 65, 80, "'01'"), (20, 85, 100, "strftime(d0, '%b')"),
                   (20, 105, 130, "strftime(d0, '%Y')"), (30, 20, 40, "'One'"), (30, 45, 80, "'Account'"),
                   (30, 85, 100, "'SGD'"), (30, 105, 160, "format('{:,.2f}', tot)")]


def _word_sql(src, dy, x0, x1, text, cond="true", page="page", base="base"):
    return (f"SELECT source_file, {page} AS page, {text} AS text, cast({x0} AS double) AS x0, cast({x1} AS double) AS x1, "
            f"{base} + {dy} AS top FROM {src} WHERE {cond}")


view("sav_words", "\nUNION ALL\n".join(
    [_word_sql("sav_base", *w) for w in _SAV_WORDS]
    + [_word_sql("(SELECT DISTINCT source_file, page FROM sav_base)", dy, x0, x1, t, base="0.0") for dy, x0, x1, t in _SAV_PAGE_WORDS]
    + [_word_sql("(SELECT source_file, min(o_orderdate) AS d0, sum(cast(o_totalprice AS decimal(18,2))) AS tot FROM sav_base GROUP BY 1)",
                 dy, x0, x1, t, page="1", base="0.0") for dy, x0, x1, t in _SAV_FILE_WORDS]), ("sav_base",))

view("sav_lines", """
SELECT source_file, page, round(top, 1) AS top, list(text ORDER BY x0, x1, text) AS ws,
       trim(string_agg(text, ' ' ORDER BY x0, x1, text)) AS text
FROM sav_words GROUP BY source_file, page, round(top, 1)""", ("sav_words",))

_NOISE_SQL = " OR ".join(f"contains(text, '{f}')" for f in st.SAVINGS_NOISE)
view("sav_clean", f"SELECT * FROM sav_lines WHERE NOT ({_NOISE_SQL})", ("sav_lines",))

view("sav_heads", """
SELECT source_file, page, text, (x0 + x1) / 2 AS centre,
       row_number() OVER (PARTITION BY source_file, page ORDER BY round(top, 1), x0, x1) AS ord
FROM sav_words WHERE text IN ('Withdrawals', 'Deposits', 'Balance')""", ("sav_words",))

view("sav_centres", """
SELECT source_file, page, centre AS withdrawal, dep.c AS deposit, bal.c AS balance FROM (
  SELECT *, row_number() OVER (PARTITION BY source_file, page ORDER BY ord) AS pick FROM (
    SELECT *,
      min(CASE WHEN text = 'Deposits' THEN {'o': ord, 'c': centre} END) OVER (PARTITION BY source_file, page ORDER BY ord
          ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS dep,
      min(CASE WHEN text = 'Balance' THEN {'o': ord, 'c': centre} END) OVER (PARTITION BY source_file, page ORDER BY ord
          ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS bal
    FROM sav_heads)
  WHERE text = 'Withdrawals' AND dep IS NOT NULL AND bal IS NOT NULL)
WHERE pick = 1""", ("sav_heads",))


view("card_base", """
SELECT 'card_' || strftime(o_orderdate, '%Y') || '_' || cast(o_orderkey // 1024 AS varchar) || '.pdf' AS source_file,
       cast((o_orderkey % 1024) // 32 + 1 AS integer) AS page,
       cast(100 + (o_orderkey % 32) * 24 AS double) AS base, o_orderkey AS k, o_orderdate, o_totalprice,
       strftime(o_orderdate, '%d') AS day, upper(strftime(o_orderdate, '%b')) AS mon,
       format('{:,.2f}', cast(o_totalprice AS decimal(18,2))) AS amt
FROM orders""")

_CARD_WORDS = [
    (0, 20, 32, "day", "true"), (0, 40, 62, "mon", "true"), (0, 70, 82, "day", "k % 2 = 0"), (0, 90, 112, "mon", "k % 2 = 0"),
    (0, 150, 190, "'SHOP'", "true"), (0, 195, 240, "cast(k AS varchar)", "true"), (0, 350, 390, "'0.99'", "k % 7 = 0"),
    (0, 400, 460, "amt || CASE WHEN k % 5 >= 3 THEN 'CR' ELSE '' END", "true"),
    (12, 150, 180, "'Ref'", "k % 3 = 0"), (12, 185, 200, "'No.'", "k % 3 = 0"), (12, 205, 240, "cast(k AS varchar)", "k % 3 = 0"),
    (18, 400, 420, "'CR'", "k % 11 = 0"), (20, 400, 440, "'5.50CR'", "k % 13 = 0"),
]
_CARD_PAGE_WORDS = [(40, 20, 50, "'Page'"), (40, 55, 65, "cast(page AS varchar)"), (60, 20, 40, "'Post'"), (60, 45, 65, "'Date'"),
                    (60, 70, 90, "'Trans'"), (60, 95, 115, "'Date'"), (60, 150, 200, "'Description'"), (60, 205, 215, "'of'"),
                    (60, 220, 280, "'Transaction'"), (60, 400, 450, "'Transaction'"), (60, 455, 490, "'Amount'")]
_CARD_FILE_WORDS = [(20, 20, 60, "'Statement'"), (20, 65, 85, "'Date'"), (20, 90, 100, "'01'"),
                    (20, 105, 125, "upper(strftime(d0, '%b'))"), (20, 130, 160, "strftime(d0, '%Y')")]

view("card_words", "\nUNION ALL\n".join(
    [_word_sql("card_base", *w) for w in _CARD_WORDS]
    + [_word_sql("(SELECT DISTINCT source_file, page FROM card_base)", dy, x0, x1, t, base="0.0") for dy, x0, x1, t in _CARD_PAGE_WORDS]
    + [_word_sql("(SELECT source_file, min(o_orderdate) AS d0 FROM card_base GROUP BY 1)",
                 dy, x0, x1, t, page="1", base="0.0") for dy, x0, x1, t in _CARD_FILE_WORDS]), ("card_base",))

view("stmt_page_text", """
SELECT source_file, page, string_agg(text, chr(10) ORDER BY top) AS text FROM (
  SELECT source_file, page, round(top, 1) AS top, trim(string_agg(text, ' ' ORDER BY x0, x1, text)) AS text
  FROM (SELECT * FROM sav_words UNION ALL SELECT * FROM card_words) GROUP BY 1, 2, 3)
GROUP BY 1, 2""", ("sav_words", "card_words"))

_IS_CARD = " OR ".join(f"contains(text, '{h}')" for h in st.CARD_HEADERS)
view("stmt_facts", f"""
SELECT source_file,
  CASE WHEN {_IS_CARD} THEN 'credit_card' ELSE 'savings' END AS statement_type,
  CASE WHEN {_IS_CARD} THEN coalesce(nullif(regexp_extract(text, '{st.CARD_YEAR_RE}', 1), ''), '{st.CARD_DEFAULT_YEAR}')
       ELSE coalesce(nullif(regexp_extract(text, '{st.SAVINGS_YEAR_RE}', 1), ''), '{st.SAVINGS_DEFAULT_YEAR}') END AS year,
  CASE WHEN {_IS_CARD} THEN NULL ELSE cast(cast(replace(coalesce(nullif(regexp_extract(text, '{st.CLOSING_RE}', 1), ''),
       nullif(regexp_extract(text, '{st.GRAND_TOTAL_RE}', 1), '')), ',', '') AS decimal(18,2)) AS double) END AS closing_balance
FROM stmt_page_text WHERE page = 1""", ("stmt_page_text",))


def _sav_lines(spark, d):
    return st.words_to_lines(fx.statement_words(spark, d, "savings"))


# ------------------------------------------------------------------ R1, R2, R6, R7, R8

@query("words_to_lines", with_views("SELECT source_file, page, top, text FROM sav_lines", ["sav_lines"]))
def q_words_to_lines(spark, d):
    return _sav_lines(spark, d).select("source_file", "page", "top", "text")


@query("drop_noise", with_views("SELECT source_file, page, top, text FROM sav_clean", ["sav_clean"]))
def q_drop_noise(spark, d):
    return st.drop_noise(_sav_lines(spark, d), st.SAVINGS_NOISE).select("source_file", "page", "top", "text")


@query("column_centres", with_views("SELECT * FROM sav_centres", ["sav_centres"]))
def q_column_centres(spark, d):
    return st.column_centres(fx.statement_words(spark, d, "savings"))


view("sav_amounts", """
SELECT * FROM sav_words WHERE regexp_matches(text, '^\\d{1,3}(,\\d{3})*\\.\\d{2}$')""", ("sav_words",))


@query("nearest_column", with_views("""
SELECT w.source_file, w.page, w.top, w.x0, w.text,
  CASE WHEN abs((x0 + x1) / 2 - withdrawal) <= abs((x0 + x1) / 2 - deposit)
         AND abs((x0 + x1) / 2 - withdrawal) <= abs((x0 + x1) / 2 - balance) THEN 'withdrawal'
       WHEN abs((x0 + x1) / 2 - deposit) <= abs((x0 + x1) / 2 - balance) THEN 'deposit'
       ELSE 'balance' END AS col
FROM sav_amounts w JOIN sav_centres c ON w.source_file = c.source_file AND w.page = c.page""", ["sav_amounts", "sav_centres"], stored=True))
def q_nearest_column(spark, d):
    words = fx.statement_words(spark, d, "savings")
    c = st.column_centres(words)
    amounts = words.filter(F.col("text").rlike(st.AMOUNT_RE)).join(c, ["source_file", "page"])
    centre = (F.col("x0") + F.col("x1")) / 2
    col = st.nearest_column(centre, {n: F.col(n) for n in st.COLUMNS})
    return amounts.select("source_file", "page", "top", "x0", "text", col.alias("col"))


@query("segment_lines", with_views(f"""
SELECT source_file, page, top, text, txn FROM (
  SELECT *, cast(sum(CASE WHEN regexp_matches(ws[1] || ' ' || coalesce(ws[2], ''), '{st.SAVINGS_DATE_RE}') THEN 1 ELSE 0 END)
              OVER (PARTITION BY source_file, page ORDER BY top ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS txn
  FROM sav_clean) WHERE txn > 0""", ["sav_clean"]))
def q_segment_lines(spark, d):
    seg = st.segment(st.drop_noise(_sav_lines(spark, d), st.SAVINGS_NOISE), st.SAVINGS_DATE_RE)
    return seg.select("source_file", "page", "top", "text", F.col("txn").cast("bigint").alias("txn"))


# ------------------------------------------------------------------ R3-R5, R9-R12 (golden-tested; rows-only here)

def _all_words(spark, d):
    return fx.statement_words(spark, d, "savings").unionByName(fx.statement_words(spark, d, "credit_card"))


def _facts(spark, d):
    return st.statement_facts(st.page_text(st.page_lines(_all_words(spark, d))))


@query("statement_type", with_views("SELECT source_file, statement_type FROM stmt_facts", ["stmt_facts"]))
def q_statement_type(spark, d):
    return _facts(spark, d).select("source_file", "statement_type")


@query("statement_facts", with_views("SELECT * FROM stmt_facts", ["stmt_facts"]))
def q_statement_facts(spark, d):
    return _facts(spark, d)


def q_statement_savings(spark, d):
    pages = st.page_lines(fx.statement_words(spark, d, "savings"))
    years = st.statement_facts(st.page_text(pages)).select("source_file", "year")
    return st.savings_transactions(pages, years)


def q_statement_card(spark, d):
    pages = st.page_lines(fx.statement_words(spark, d, "credit_card"))
    years = st.statement_facts(st.page_text(pages)).select("source_file", "year")
    return st.card_transactions(pages, years)


def q_statement_transactions(spark, d):
    tx, _ = st.parse_statements(_all_words(spark, d))
    return tx


def q_statement_month(spark, d):
    tx, _ = st.parse_statements(_all_words(spark, d))
    tx = tx.withColumn("transaction_date", F.to_date(F.initcap(F.lower("date")), "d MMM yyyy"))
    return rollup.statement_month(tx.withColumn("position", F.struct("page", "top")))


# ------------------------------------------------------------------ R13

view("pension_letters", """
SELECT source_file, concat_ws(chr(10), 'Account balances', 'as at ' || strftime(statement_date, '%-d %b %Y'),
  'Ordinary Account $' || format('{:,.2f}', cast(ordinary_account AS decimal(18,2))),
  'SPECIAL ACCOUNT $' || format('{:,.2f}', cast(special_account AS decimal(18,2))),
  'MediSave Account $' || format('{:,.2f}', cast(medisave_account AS decimal(18,2))), 'Total') AS text
FROM pension""", ("pension",))


def _label_sql(name, pat):
    return (f"cast(replace(arg_max(amt, pos) FILTER (WHERE regexp_matches(line, '{pat}') AND amt <> ''), ',', '')"
            f" AS decimal(18,2)) AS {name}")


@query("labelled_balances", with_views(f"""
SELECT source_file, statement_date, cast(ordinary_account AS double) AS ordinary_account,
       cast(special_account AS double) AS special_account, cast(medisave_account AS double) AS medisave_account,
       cast(round(ordinary_account + special_account + medisave_account, 2) AS double) AS total
FROM (
  SELECT source_file, cast(strptime(any_value(as_at), '%d %b %Y') AS date) AS statement_date,
    {", ".join(_label_sql(n, p) for n, p in st.BALANCE_LABELS.items())}
  FROM (SELECT source_file, regexp_extract(text, '{st.AS_AT_RE}', 1) AS as_at,
               line, pos, regexp_extract(line, '\\$([\\d,]+\\.\\d{{2}})', 1) AS amt
        FROM (SELECT source_file, text, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM pension_letters))
  GROUP BY source_file)""", ["pension_letters"]))
def q_labelled_balances(spark, d):
    return st.labelled_balances(fx.pension_letters(spark, d))


# ------------------------------------------------------------------ S11 sectioned CSV

view("flex_lines", """
SELECT 'flex_' || cast(l_orderkey // 512 AS varchar) || '.csv' AS file, 0 AS line_no,
       '"ClientAccountID","CurrencyPrimary","AssetClass","Symbol","Quantity","MarkPrice"' AS text
FROM lineitem GROUP BY 1
UNION ALL
SELECT 'flex_' || cast(l_orderkey // 512 AS varchar) || '.csv', 1, 'Trades,Header' FROM lineitem GROUP BY 1
UNION ALL
SELECT 'flex_' || cast(l_orderkey // 512 AS varchar) || '.csv',
       cast((l_orderkey % 512) * 8 + l_linenumber + 1 AS integer),
       CASE WHEN l_linenumber = 3 THEN '' ELSE '"U1",' END || '"' || n_name || '","'
         || CASE p_type WHEN 'ECONOMY' THEN 'STK' WHEN 'SMALL' THEN 'ETF' WHEN 'MEDIUM' THEN 'CRYPTO'
                        WHEN 'PROMO' THEN 'CASH' WHEN 'STANDARD' THEN 'OPT' ELSE 'WAR' END
         || '","S' || cast(l_partkey % 40 AS varchar) || '"," '
         || CASE WHEN l_linenumber = 5 THEN 'x' WHEN l_linenumber = 6 THEN '' ELSE cast(cast(l_quantity AS integer) - 10 AS varchar) END
         || ' ",' || cast(cast(p_retailprice AS decimal(18,2)) AS varchar)
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""")


def _flex_lines(spark, d):
    li = fx.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    part = fx.table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice")
    supp = fx.table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = fx.table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    j = li.join(part, li.l_partkey == part.p_partkey).join(supp.join(nation, "s_nationkey"), li.l_suppkey == supp.s_suppkey)
    file_col = F.concat(F.lit("flex_"), (F.col("l_orderkey") / 512).cast("long").cast("string"), F.lit(".csv"))
    code = fx._case(F.col("p_type"), [("ECONOMY", "STK"), ("SMALL", "ETF"), ("MEDIUM", "CRYPTO"), ("PROMO", "CASH"),
                                      ("STANDARD", "OPT")], "WAR")
    qty = fx._case(F.col("l_linenumber"), [(5, "x"), (6, "")], (F.col("l_quantity").cast("int") - 10).cast("string"))
    text = F.concat(F.when(F.col("l_linenumber") == 3, F.lit("")).otherwise(F.lit('"U1",')), F.lit('"'), F.col("n_name"),
                    F.lit('","'), code, F.lit('","S'), (F.col("l_partkey") % 40).cast("string"), F.lit('"," '), qty,
                    F.lit(' ",'), F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
    recs = j.select(file_col.alias("file"), ((F.col("l_orderkey") % 512) * 8 + F.col("l_linenumber") + 1).cast("int").alias("line_no"),
                    text.alias("text"))
    files = li.select(file_col.alias("file")).distinct()
    hdr = files.select("file", F.lit(0).alias("line_no"),
                       F.lit('"ClientAccountID","CurrencyPrimary","AssetClass","Symbol","Quantity","MarkPrice"').alias("text"))
    sec = files.select("file", F.lit(1).alias("line_no"), F.lit("Trades,Header").alias("text"))
    return hdr.unionByName(sec).unionByName(recs)


def broker_positions(records):
    """Broker report records -> positions: unparseable quantity/price rows skipped,
    zero quantity dropped, class code mapped (unknown -> lower case), value round(q*p, 2)."""
    r = F.col("record")
    qty = F.coalesce(F.nullif(r["Quantity"], F.lit("")), F.lit("0")).try_cast("double")
    price = F.coalesce(F.nullif(r["MarkPrice"], F.lit("")), F.lit("0")).try_cast("double")
    out = records.select(
        "file", "line_no", F.coalesce(r["Symbol"], F.lit("")).alias("symbol"),
        F.coalesce(r["AssetClass"], F.lit("STK")).alias("code"), qty.alias("quantity"), price.alias("price"),
        F.coalesce(r["CurrencyPrimary"], F.lit("USD")).alias("currency"))
    out = out.filter(F.col("quantity").isNotNull() & F.col("price").isNotNull() & (F.col("quantity") != 0))
    out = fxops.map_class(out, "code", out="asset_class")
    return fxops.market_value(out, "rounded").drop("code")


_SECTIONED_SQL = """
SELECT file, line_no, symbol, quantity, price, currency, asset_class,
       cast(round(cast(quantity AS decimal(19,8)) * cast(price AS decimal(19,8)), 2) AS double) AS market_value
FROM (
  SELECT file, line_no,
         coalesce(cells[len(header) + 1 - list_position(list_reverse(header), 'Symbol')], '') AS symbol,
         try_cast(coalesce(nullif(cells[len(header) + 1 - list_position(list_reverse(header), 'Quantity')], ''), '0') AS double) AS quantity,
         try_cast(coalesce(nullif(cells[len(header) + 1 - list_position(list_reverse(header), 'MarkPrice')], ''), '0') AS double) AS price,
         coalesce(cells[len(header) + 1 - list_position(list_reverse(header), 'CurrencyPrimary')], 'USD') AS currency,
         CASE code WHEN 'STK' THEN 'stock' WHEN 'ETF' THEN 'etf' WHEN 'OPT' THEN 'option' WHEN 'FUT' THEN 'future'
                   WHEN 'CASH' THEN 'cash' WHEN 'CRYPTO' THEN 'crypto' ELSE lower(code) END AS asset_class
  FROM (
    SELECT *, coalesce(cells[len(header) + 1 - list_position(list_reverse(header), 'AssetClass')], 'STK') AS code FROM (
      SELECT file, line_no, cells, is_header,
             last_value(CASE WHEN is_header THEN cells END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header
      FROM (SELECT file, line_no, cells,
                   list_has_all(cells, ['CurrencyPrimary', 'AssetClass', 'Symbol', 'Quantity', 'MarkPrice']) AS is_header
            FROM (SELECT file, line_no, list_transform(string_split(text, ','), lambda c: regexp_replace(trim(c), '^"+|"+$', '', 'g')) AS cells
                  FROM flex_lines)))
    WHERE NOT is_header AND header IS NOT NULL AND len(cells) = len(header)))
WHERE quantity IS NOT NULL AND price IS NOT NULL AND quantity <> 0"""


@query("sectioned_csv", with_views(_SECTIONED_SQL, ["flex_lines"]))
def q_sectioned_csv(spark, d):
    recs = payloads.read_sectioned_csv(_flex_lines(spark, d))
    return broker_positions(recs)


# The same lines as files: a file's lines follow one another, so a line's number is its rank (the dates of flex_lines leave gaps).
@query("sectioned_csv_files", with_views(_SECTIONED_SQL.replace("FROM flex_lines", "FROM file_lines"), ["flex_lines"], {"file_lines": """
SELECT file, cast(row_number() OVER (PARTITION BY file ORDER BY line_no, text) - 1 AS bigint) AS line_no, text FROM flex_lines"""}))
def q_sectioned_csv_files(spark, d):
    """Report files written from the lines, then read as the scan splits them."""
    path = _scratch(spark, "reports")
    lines = _flex_lines(spark, d)
    body = lines.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("line_no", "text"))).alias("ls"))
    # One text value per file: its lines in order.  (Fixture only: reading does not need a file in one value.)
    whole = body.select("file", F.array_join(F.transform("ls", lambda x: x["text"]), "\n").alias("value"))
    whole.write.partitionBy("file").text(path)
    records = payloads.sectioned_csv_files(spark, path)
    named = records.withColumn("file", F.regexp_extract("file", r"file=([^/]+)/", 1))
    return broker_positions(named)


# ------------------------------------------------------------------ S5, S6 idempotent loads

@query("skip_landed", with_views("""
SELECT etl_time, source_file, description, amount FROM tx
WHERE source_file NOT IN (SELECT source_file FROM tx WHERE cast(substr(source_file, 11, 2) AS integer) % 2 = 0)""", ["tx"]))
def q_skip_landed(spark, d):
    new, landed = fx.tx_halves(spark, d)
    return tables.skip_landed(new, landed, ["source_file"]).select("etl_time", "source_file", "description", "amount")


@query("skip_loaded", with_views("""
SELECT source_file, statement_date, total_cpf FROM pension
WHERE statement_date NOT IN (SELECT statement_date FROM pension WHERE o_orderkey % 80 = 0)""", ["pension"]))
def q_skip_loaded(spark, d):
    p = fx.pension(spark, d)
    return tables.skip_loaded(p, p.filter(F.col("o_orderkey") % 80 == 0)).select("source_file", "statement_date", "total_cpf")


# ------------------------------------------------------------------ S9, S10 events

_ENVELOPE_SQL = """CASE page_id % 5
  WHEN 0 THEN '{"data":{"bucket":"b1","name":"inbox/' || cast(page_id AS varchar) || '.pdf"}}'
  WHEN 1 THEN '{"bucket":"b1","name":"raw/' || cast(page_id AS varchar) || '.pdf"}'
  WHEN 2 THEN '{"data":{"bucket":"b1","name":"inbox/p' || cast(page_id AS varchar) || '.PDF"}}'
  WHEN 3 THEN '{"data":{"bucket":"","name":"inbox/x.pdf"}}'
  ELSE '{"data":{"bucket":"b1","name":"inbox/' || cast(page_id AS varchar) || '.html"}}' END"""


def _spark_sql(sql: str) -> str:
    """The same CASE text for Spark SQL (STRING instead of VARCHAR)."""
    return sql.replace("AS varchar", "AS string")


def _envelopes(spark, d):
    p = fx.table(spark, d, "pages").select("page_id")
    return p.select("page_id", F.expr(_spark_sql(_ENVELOPE_SQL)).alias("body"))


@query("route_events", with_views("""
SELECT page_id, bucket, name,
  CASE WHEN bucket = '' OR name = '' THEN 'error'
       WHEN NOT starts_with(name, 'inbox/') OR NOT ends_with(lower(name), '.pdf') THEN 'skipped' ELSE 'process' END AS action,
  CASE WHEN bucket = '' OR name = '' THEN 'missing bucket or name'
       WHEN NOT starts_with(name, 'inbox/') THEN name || ' is not in inbox/'
       WHEN NOT ends_with(lower(name), '.pdf') THEN name || ' is not a PDF' END AS reason,
  CASE WHEN bucket <> '' AND name <> '' AND starts_with(name, 'inbox/') AND ends_with(lower(name), '.pdf')
       THEN split_part(name, '/', -1) END AS file
FROM (SELECT page_id, coalesce(json_extract_string(data, '$.bucket'), '') AS bucket,
             coalesce(json_extract_string(data, '$.name'), '') AS name
      FROM (SELECT page_id, coalesce(json_extract(body, '$.data'), body::JSON) AS data
            FROM (SELECT page_id, """ + _ENVELOPE_SQL + """ AS body FROM pages)))"""))
def q_route_events(spark, d):
    return ev.route_events(_envelopes(spark, d)).select("page_id", "bucket", "name", "action", "reason", "file")


_SUBJECT_SQL = ("CASE WHEN page_id % 2 = 0 THEN '/projects/_/buckets/b1/objects/inbox/' || cast(page_id AS varchar) || '.pdf' "
                "ELSE 'inbox/sub/' || cast(page_id AS varchar) || '.pdf' END")


@query("object_path", with_views(f"""
SELECT page_id, subject, path, split_part(path, '/', -1) AS base_name FROM (
  SELECT page_id, subject,
         CASE WHEN instr(subject, '/objects/') > 0 THEN substr(subject, instr(subject, '/objects/') + 9) ELSE subject END AS path
  FROM (SELECT page_id, {_SUBJECT_SQL} AS subject FROM pages))"""))
def q_object_path(spark, d):
    p = fx.table(spark, d, "pages").select("page_id", F.expr(_spark_sql(_SUBJECT_SQL)).alias("subject"))
    p = p.withColumn("path", ev.object_path("subject"))
    return p.withColumn("base_name", ev.base_name("path"))


# ------------------------------------------------------------------ S14, S15, A10, S13

@query("stamp_local_date", with_views("""
SELECT event_id, ts AS etl_time, cast(ts + INTERVAL 8 HOUR AS date) AS date, cast(ts AS date) AS landing_date FROM events"""))
def q_stamp_local_date(spark, d):
    e = fx.table(spark, d, "events").select("event_id", "ts")
    out = tables.stamp(e, F.col("ts"), tz="Asia/Singapore")
    return out.select("event_id", "etl_time", "date", "landing_date")


@query("statement_totals", with_views("""
SELECT source_file,
  cast(round(sum(CASE WHEN amount < 0 THEN abs(cast(amount AS decimal(18,2))) ELSE 0 END), 2) AS double) AS total_debits,
  cast(round(sum(CASE WHEN amount > 0 THEN cast(amount AS decimal(18,2)) ELSE 0 END), 2) AS double) AS total_credits,
  count(*) AS tx_count
FROM tx GROUP BY source_file""", ["tx"]))
def q_statement_totals(spark, d):
    return rollup.statement_totals(fx.tx(spark, d))


@query("table_freshness", with_views("""
SELECT 'ods_bank_transactions_df' AS "table", max(etl_time) AS last_modified FROM tx
UNION ALL SELECT 'ods_investment_positions_df', max(etl_time) FROM positions
UNION ALL SELECT 'ods_account_balances_df', max(etl_time) FROM balances
UNION ALL SELECT 'ods_cpf_balances_df', max(etl_time) FROM pension""", ["tx", "positions", "balances", "pension"]))
def q_table_freshness(spark, d):
    return tables.table_freshness({
        "ods_bank_transactions_df": fx.tx(spark, d), "ods_investment_positions_df": fx.positions(spark, d),
        "ods_account_balances_df": fx.balances(spark, d), "ods_cpf_balances_df": fx.pension(spark, d)})


# ------------------------------------------------------------------ S3, S4, S7 sinks (round trips)

def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("land_raw_roundtrip", with_views("""
SELECT *, CASE WHEN transaction_type = 'Credit Card' THEN 'credit_card' ELSE 'savings' END AS statement_type,
       substr(source_file, 6, 7) AS month FROM tx""", ["tx"]))
def q_land_raw_roundtrip(spark, d):
    """Land raw transactions by type and month, one type after the other and the first one twice, and read them back."""
    kind = F.when(F.col("transaction_type") == "Credit Card", F.lit("credit_card")).otherwise(F.lit("savings"))
    t = fx.tx(spark, d).withColumn("statement_type", kind).withColumn("month", F.substring("source_file", 6, 7))
    path = _scratch(spark, "raw-tx")
    for landed in ("savings", "credit_card", "savings"):
        tables.land_raw(t.where(F.col("statement_type") == landed), path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ rejects, refresh, freshness by listing

_LETTER_FAULTS = {"statement_date": "o_orderkey % 13 IN (5, 6)", "special_account": "o_orderkey % 11 = 3"}


def _faulty_letters(spark, d):
    """Pension letters of which some lack a balance, and some a date, or give one that is none."""
    p = fx.pension_letters(spark, d)
    k = F.regexp_extract("source_file", r"_(\d+)", 1).cast("long")
    text = F.when(k % 11 == 3, F.regexp_replace("text", "SPECIAL ACCOUNT", "Other")).otherwise(F.col("text"))
    text = F.when(k % 13 == 5, F.regexp_replace(text, "as at", "on")).when(k % 13 == 6, F.regexp_replace(text, r"as at \d+", "as at 31 Foo 2020,")).otherwise(text)
    return p.select("source_file", text.alias("text"))


@query("quarantine_letters", with_views(f"""
SELECT source_file, CASE WHEN faults <> '' THEN 'missing ' || faults END AS reason,
  CASE WHEN {_LETTER_FAULTS["statement_date"]} THEN NULL ELSE statement_date END AS statement_date, ordinary_account,
  CASE WHEN {_LETTER_FAULTS["special_account"]} THEN NULL ELSE special_account END AS special_account, medisave_account,
  CASE WHEN {_LETTER_FAULTS["special_account"]} THEN NULL ELSE total_cpf END AS total
FROM (SELECT *, concat_ws(', ', {", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _LETTER_FAULTS.items())}) AS faults FROM pension)""", ["pension"]))
def q_quarantine_letters(spark, d):
    """Good letters and rejects, from one evaluation; together all letters."""
    good, rejects = tables.split_rejects(st.checked_balances(_faulty_letters(spark, d)), _scratch(spark, "letters"))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects)


@query("pension_run", with_views(f"""
SELECT source_file, statement_date, ordinary_account, special_account, medisave_account, total_cpf, 'SGD' AS currency FROM (
  SELECT *, row_number() OVER (PARTITION BY statement_date ORDER BY o_orderkey % 2 DESC, source_file) AS rn
  FROM pension WHERE NOT ({" OR ".join(_LETTER_FAULTS.values())})) WHERE rn = 1""", ["pension"]))
def q_pension_run(spark, d):
    """Half of the letters in one run, all of them in the next, which is repeated: a date is loaded once."""
    target, letters = _scratch(spark, "pension"), _faulty_letters(spark, d)
    odd = F.regexp_extract("source_file", r"_(\d+)", 1).cast("long") % 2 == 1
    runs.pension_run(spark, letters.filter(odd), target, dt.datetime(2024, 1, 14))
    for _ in range(2):
        runs.pension_run(spark, letters, target, dt.datetime(2024, 1, 15))
    return runs.stored(spark, target, runs.PENSION).drop("etl_time")


@query("refresh_switch", with_views("SELECT * FROM m_spend", ["m_spend"]))
def q_refresh_switch(spark, d):
    """A table refreshed twice; its name gives the rows of the second refresh."""
    from ledgerflow.plans.q_models import _monthly_spend
    spend, path, name = _monthly_spend(spark, d), _scratch(spark, "spend"), f"spend_{uuid.uuid4().hex[:12]}"
    tables.refresh(spend.filter("net_spend > 0"), "ads", name, path)
    tables.refresh(spend, "ads", name, path)
    return spark.table(f"ads.{name}")


@query("listed_freshness")
def q_listed_freshness(spark, d):
    return tables.listed_freshness(spark, {t: f"{d.rstrip('/')}/{t}.parquet" for t in ("orders", "lineitem", "events", "documents")})


@query("append_ods", with_views("SELECT * FROM tx", ["tx"]))
def q_append_ods(spark, d):
    """Append raw transactions in the enforced ods schema and read the table back."""
    path = _scratch(spark, "ods-tx")
    tables.append_ods(fx.tx(spark, d), path, BANK_TRANSACTIONS)
    return tables.read_table(spark, path, BANK_TRANSACTIONS)


@query("materialize", with_views("SELECT * FROM m_spend", ["m_spend"]))
def q_materialize(spark, d):
    """Full-refresh materialization of the monthly spend model as layer.table."""
    from ledgerflow.plans.q_models import _monthly_spend
    name = tables.materialize(_monthly_spend(spark, d), "dws", "dws_monthly_spend_df", path=_scratch(spark, "dws"))
    return spark.table(name)



# ------------------------------------------------------------------ parser oracles (token level, no arrays)

def _noise_sql(col, fragments):
    return "(" + " OR ".join(f"contains({col}, '{f}')" for f in fragments) + ")"


_AMT = st.AMOUNT_RE


def _stmt_tokens(words_view):
    return f"""
SELECT source_file, page, round(top, 1) AS top, text, x0, x1,
       row_number() OVER (PARTITION BY source_file, page, round(top, 1) ORDER BY x0, x1, text) AS pos
FROM {words_view}"""


def _segmented(lines_view, noise, date_re, extra_join=""):
    return f"""
SELECT * , top = min(top) OVER (PARTITION BY source_file, page, txn) AS is_first FROM (
  SELECT l.source_file, l.page, l.top, l.text, l.ws,
         cast(sum(CASE WHEN regexp_matches(l.ws[1] || ' ' || coalesce(l.ws[2], ''), '{date_re}') THEN 1 ELSE 0 END)
              OVER (PARTITION BY l.source_file, l.page ORDER BY l.top ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS txn
  FROM {lines_view} l {extra_join}
  WHERE NOT {_noise_sql('l.text', noise)})
WHERE txn > 0"""


_SAV_CTES = {
    "sav_tok": _stmt_tokens("sav_words"),
    "sav_seg": _segmented("sav_lines", st.SAVINGS_NOISE, st.SAVINGS_DATE_RE,
                          "JOIN sav_centres c ON c.source_file = l.source_file AND c.page = l.page"),
    "sav_amt": f"""
SELECT s.source_file, s.page, s.txn, s.top * 10000 + t.pos AS k, t.text, s.is_first,
  CASE WHEN abs((t.x0 + t.x1) / 2 - c.withdrawal) <= abs((t.x0 + t.x1) / 2 - c.deposit)
        AND abs((t.x0 + t.x1) / 2 - c.withdrawal) <= abs((t.x0 + t.x1) / 2 - c.balance) THEN 'withdrawal'
       WHEN abs((t.x0 + t.x1) / 2 - c.deposit) <= abs((t.x0 + t.x1) / 2 - c.balance) THEN 'deposit' ELSE 'balance' END AS col
FROM sav_seg s JOIN sav_tok t ON t.source_file = s.source_file AND t.page = s.page AND t.top = s.top
JOIN sav_centres c ON c.source_file = s.source_file AND c.page = s.page
WHERE (NOT s.is_first OR t.pos >= 3) AND regexp_matches(t.text, '{_AMT}')""",
    "sav_chosen": """
SELECT source_file, page, txn, arg_min(text, k) AS amt_text, arg_min(is_first, k) AS on_first, arg_min(col, k) AS col
FROM sav_amt WHERE col IN ('withdrawal', 'deposit') GROUP BY 1, 2, 3""",
    "sav_head": f"""
SELECT s.source_file, s.page, s.txn, s.top, s.ws[1] || ' ' || s.ws[2] AS day_month,
  trim(coalesce(string_agg(t.text, ' ' ORDER BY t.pos) FILTER (WHERE t.pos >= 3 AND NOT regexp_matches(t.text, '{_AMT}')), '')) AS ttype
FROM sav_seg s JOIN sav_tok t ON t.source_file = s.source_file AND t.page = s.page AND t.top = s.top
WHERE s.is_first GROUP BY 1, 2, 3, 4, 5""",
    "sav_desc": f"""
SELECT source_file, page, txn, trim(string_agg(l, ' | ' ORDER BY o)) AS description FROM (
  SELECT source_file, page, txn, ttype AS l, -1.0 AS o FROM sav_head WHERE ttype <> ''
  UNION ALL
  SELECT source_file, page, txn, text, top FROM sav_seg WHERE NOT is_first AND NOT regexp_matches(trim(text), '{st.SAVINGS_REF_RE}'))
WHERE NOT {_noise_sql('l', st.SAVINGS_NOISE)} AND NOT regexp_matches(trim(l), '{st.SAVINGS_REF_RE}') AND length(trim(l)) > 1
GROUP BY 1, 2, 3""",
    "sav_years": "SELECT source_file, year FROM stmt_facts WHERE source_file LIKE 'sav%'",
}
_KEYWORDS_SQL = " OR ".join(f"contains(h.ttype, '{k}')" for k in st.DEPOSIT_KEYWORDS)
_SAV_SKIP_SQL = ", ".join(f"'{x}'" for x in st.SAVINGS_SKIP)
_SAV_ORACLE = f"""
SELECT * FROM (
  SELECT h.source_file, h.page, h.txn, h.top, h.day_month || ' ' || y.year AS date,
         coalesce(d.description, '') AS description, h.ttype AS transaction_type,
         CASE WHEN CASE WHEN ch.on_first AND h.ttype <> '' THEN ({_KEYWORDS_SQL}) ELSE ch.col = 'deposit' END
              THEN 1 ELSE -1 END * cast(cast(replace(ch.amt_text, ',', '') AS decimal(18,2)) AS double) AS amount
  FROM sav_head h JOIN sav_chosen ch ON ch.source_file = h.source_file AND ch.page = h.page AND ch.txn = h.txn
  JOIN sav_years y ON y.source_file = h.source_file
  LEFT JOIN sav_desc d ON d.source_file = h.source_file AND d.page = h.page AND d.txn = h.txn)
WHERE description <> '' AND description NOT IN ({_SAV_SKIP_SQL})"""

ORACLE_SAVINGS = with_views(_SAV_ORACLE, ["sav_lines", "sav_centres", "stmt_facts"], _SAV_CTES)


query("statement_savings", ORACLE_SAVINGS)(q_statement_savings)


view("card_lines", """
SELECT source_file, page, round(top, 1) AS top, list(text ORDER BY x0, x1, text) AS ws,
       trim(string_agg(text, ' ' ORDER BY x0, x1, text)) AS text
FROM card_words GROUP BY source_file, page, round(top, 1)""", ("card_words",))

_IS_CARD_PAGE = " OR ".join(f"contains(p.text, '{h}')" for h in st.CARD_HEADERS)
_CR_AMT = f"(ends_with(t.text, 'CR') AND regexp_matches(trim(regexp_replace(t.text, 'CR$', '')), '{_AMT}'))"
_CARD_SKIP_SQL = ", ".join(f"'{x}'" for x in st.CARD_SKIP)
_CARD_CTES = {
    "card_pages": f"SELECT p.source_file, p.page FROM stmt_page_text p WHERE p.source_file LIKE 'card%' AND ({_IS_CARD_PAGE})",
    "card_tok": _stmt_tokens("card_words"),
    "card_seg": _segmented("card_lines", st.CARD_NOISE, st.CARD_DATE_RE,
                           "JOIN card_pages cp ON cp.source_file = l.source_file AND cp.page = l.page"),
    # first-line tokens after the date (and after a second date when present); later-line tokens
    "card_t": f"""
SELECT s.source_file, s.page, s.txn, s.is_first, s.top * 10000 + t.pos AS k, t.pos, t.text,
       {_CR_AMT} AS cr_amt, regexp_matches(t.text, '{_AMT}') AS amt,
       CASE WHEN {_CR_AMT} THEN trim(regexp_replace(t.text, 'CR$', '')) ELSE t.text END AS num
FROM card_seg s JOIN card_tok t ON t.source_file = s.source_file AND t.page = s.page AND t.top = s.top
WHERE NOT s.is_first OR t.pos >= CASE WHEN len(s.ws) >= 4 AND regexp_matches(s.ws[3] || ' ' || s.ws[4], '{st.CARD_DATE_RE}')
                                      THEN 5 ELSE 3 END""",
    "card_agg": """
SELECT source_file, page, txn,
  arg_max(num, k) FILTER (WHERE is_first AND (cr_amt OR amt)) AS a0,
  arg_max(cr_amt, k) FILTER (WHERE is_first AND (cr_amt OR amt)) AS c0,
  arg_max(num, k) FILTER (WHERE NOT is_first AND cr_amt) AS last_cr,
  arg_min(text, k) FILTER (WHERE NOT is_first AND amt) AS first_plain,
  min(k) FILTER (WHERE NOT is_first AND amt) AS first_plain_k,
  coalesce(bool_or(text = 'CR') FILTER (WHERE NOT is_first), false) AS any_cr,
  trim(coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (WHERE is_first AND NOT cr_amt AND NOT amt), '')) AS head
FROM card_t GROUP BY 1, 2, 3""",
    "card_cr_after": """
SELECT a.source_file, a.page, a.txn, bool_or(t.text = 'CR' AND t.k > a.first_plain_k) AS cr_after
FROM card_agg a JOIN card_t t ON t.source_file = a.source_file AND t.page = a.page AND t.txn = a.txn AND NOT t.is_first
GROUP BY 1, 2, 3""",
    "card_first": "SELECT source_file, page, txn, top, ws[1] || ' ' || ws[2] AS day_month FROM card_seg WHERE is_first",
    "card_desc": f"""
SELECT source_file, page, txn, trim(string_agg(l, ' | ' ORDER BY o)) AS description FROM (
  SELECT source_file, page, txn, head AS l, -1.0 AS o FROM card_agg WHERE head <> '' AND head NOT IN ({_CARD_SKIP_SQL})
  UNION ALL
  SELECT source_file, page, txn, text, top FROM card_seg
  WHERE NOT is_first AND NOT regexp_matches(trim(text), '{st.CARD_REF_RE}') AND NOT regexp_matches(trim(text), '{_AMT}'))
WHERE NOT {_noise_sql('l', st.NOISE_FRAGMENTS)} AND NOT regexp_matches(trim(l), '{st.CARD_REF_RE}') AND length(trim(l)) > 1
GROUP BY 1, 2, 3""",
    "card_years": "SELECT source_file, year FROM stmt_facts WHERE source_file LIKE 'card%'",
}
_CARD_ORACLE = f"""
SELECT * FROM (
  SELECT f.source_file, f.page, f.txn, f.top, f.day_month || ' ' || y.year AS date,
         coalesce(d.description, '') AS description, 'Credit Card' AS transaction_type,
         CASE WHEN CASE WHEN a.last_cr IS NOT NULL THEN true WHEN a.a0 IS NOT NULL THEN a.c0 OR a.any_cr
                        ELSE coalesce(ca.cr_after, false) END THEN 1 ELSE -1 END
           * cast(cast(replace(coalesce(a.last_cr, a.a0, a.first_plain), ',', '') AS decimal(18,2)) AS double) AS amount
  FROM card_first f JOIN card_agg a ON a.source_file = f.source_file AND a.page = f.page AND a.txn = f.txn
  JOIN card_years y ON y.source_file = f.source_file
  LEFT JOIN card_cr_after ca ON ca.source_file = f.source_file AND ca.page = f.page AND ca.txn = f.txn
  LEFT JOIN card_desc d ON d.source_file = f.source_file AND d.page = f.page AND d.txn = f.txn)
WHERE amount IS NOT NULL AND description <> '' AND description NOT IN ({_CARD_SKIP_SQL})"""

ORACLE_CARD = with_views(_CARD_ORACLE, ["card_lines", "stmt_facts"], _CARD_CTES)

query("statement_card", ORACLE_CARD)(q_statement_card)

_TX_COLS = "source_file, page, top, date, description, transaction_type, amount"
#: The statement of all transactions, and the views and further CTEs that it reads.
TRANSACTIONS_SQL = (f"SELECT {_TX_COLS} FROM ({_SAV_ORACLE}) UNION ALL SELECT {_TX_COLS} FROM ({_CARD_ORACLE})",
                    ["sav_lines", "sav_centres", "card_lines", "stmt_facts"], {**_SAV_CTES, **_CARD_CTES})
ORACLE_TRANSACTIONS = with_views(*TRANSACTIONS_SQL)
ORACLE_MONTH = with_views(f"""
SELECT source_file, strftime(arg_min(cast(strptime(date, '%d %b %Y') AS date), page * 1000000 + top), '%Y-%m') AS statement_month
FROM (SELECT {_TX_COLS} FROM ({_SAV_ORACLE}) UNION ALL SELECT {_TX_COLS} FROM ({_CARD_ORACLE})) GROUP BY source_file""",
                          ["sav_lines", "sav_centres", "card_lines", "stmt_facts"], {**_SAV_CTES, **_CARD_CTES})
query("statement_transactions", ORACLE_TRANSACTIONS)(q_statement_transactions)
query("statement_month", ORACLE_MONTH)(q_statement_month)
