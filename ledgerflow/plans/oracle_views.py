"""DuckDB SQL for the derived views and shared model CTEs (the oracle side).

``with_views(select, [names], extra_ctes)`` prefixes the CTEs a statement
needs, in dependency order.  Semantics mirror ``fixtures.py`` / ``models.py``;
money is summed and rounded in DECIMAL and returned as DOUBLE as there.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    VIEWS[name] = (deps, body.strip())


def _resolve(names, seen, order):
    for n in names:
        if n in seen:
            continue
        deps, _ = VIEWS[n]
        _resolve(deps, seen, order)
        seen.add(n)
        order.append(n)


def with_views(select: str, names=(), ctes: dict[str, str] | None = None, stored: bool = False) -> str:
    """``stored``: the views are computed once each, and not folded into the places that read them."""
    order: list[str] = []
    _resolve(list(names), set(), order)
    parts = [f"{n} AS {'MATERIALIZED ' if stored else ''}(\n{VIEWS[n][1]}\n)" for n in order]
    parts += [f"{k} AS (\n{v.strip()}\n)" for k, v in (ctes or {}).items()]
    head = ("WITH " + ",\n".join(parts) + "\n") if parts else ""
    return head + select.strip()


def money(x: str) -> str:
    return f"cast({x} as decimal(18,2))"


def msum(x: str) -> str:
    """round(sum(x), 2) exactly, as DOUBLE."""
    return f"cast(round(sum({money(x)}), 2) as double)"


def pct(num: str, den: str, scale: int = 1) -> str:
    """round(num/den*100, scale) half away from zero, exact on 2-dp inputs; NULL if den is 0/NULL.

    DuckDB divides DECIMALs in DOUBLE, so the division is done on integer cents.
    """
    n = f"cast(round({money(num)} * 100) as hugeint)"
    d = f"cast(round({money(den)} * 100) as hugeint)"
    m = 10 ** scale * 100
    return (f"CASE WHEN {d} = 0 THEN NULL ELSE cast(sign({n}) * sign({d}) * "
            f"((abs({n}) * {2 * m} + abs({d})) // (2 * abs({d}))) as double) / {10 ** scale} END")


# ------------------------------------------------------------------ views

view("orders_copies", """
SELECT *, 0 AS copy FROM orders
UNION ALL
SELECT *, 1 AS copy FROM orders WHERE o_orderkey % 10 = 0
""")

_TX_SELECT = """
SELECT o_orderdate + to_days(copy) AS etl_time,
       'stmt_' || strftime(o_orderdate, '%Y-%m') || '.pdf' AS source_file,
       CASE o_orderkey % 3 WHEN 0 THEN 'Credit Card' WHEN 1 THEN '' ELSE 'FAST Payment' END AS transaction_type,
       strftime(o_orderdate, '%d %b %Y') AS date,
       CASE o_orderkey % 13 WHEN 0 THEN 'Uob Kay Hian' WHEN 1 THEN 'PAYMT thru' WHEN 2 THEN 'Acme Salary'
            WHEN 3 THEN 'Gov | credit' WHEN 4 THEN 'Cash Rebate' WHEN 5 THEN 'PayNow OTHR | someone' ELSE 'Shop' END
         || ' ' || cast(o_orderkey AS varchar) AS description,
       CASE WHEN o_orderkey % 5 < 3 THEN -o_totalprice ELSE o_totalprice END AS amount,
       'SGD' AS currency,
       {category} AS category
FROM orders_copies
"""
_CATEGORY = """CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'Transfer'
            ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'Dining' WHEN '2-HIGH' THEN 'Groceries'
                 WHEN '3-MEDIUM' THEN 'Transport' WHEN '4-NOT SPECIFIED' THEN 'Shopping' ELSE 'Other' END END"""
view("tx", _TX_SELECT.format(category=_CATEGORY), ("orders_copies",))
view("tx_b7", _TX_SELECT.format(category=f"CASE WHEN copy = 1 THEN 'Transfer' ELSE {_CATEGORY} END"), ("orders_copies",))

view("quoted_rates", """
SELECT CASE WHEN n_nationkey = 3 THEN 'UNQUOTED' ELSE n_name END AS currency,
       CASE WHEN n_nationkey % 11 = 7 THEN cast(0 AS double) ELSE cast(n_nationkey AS double) + cast('0.37' AS double) END AS rate
FROM nation
""")

view("rates", """
SELECT currency, CASE WHEN coalesce(rate, 0) = 0 THEN 0.0 ELSE round(1.0 / rate, 6) END AS fx_rate_to_base
FROM quoted_rates WHERE currency <> 'SGD'
UNION ALL SELECT 'SGD', 1.0
""", ("quoted_rates",))

view("positions_raw", """
SELECT l_shipdate + to_hours(l_linenumber) AS etl_time,
       cast(l_shipdate AS date) AS date,
       CASE l_returnflag WHEN 'A' THEN 'ibkr' WHEN 'N' THEN 'tiger' ELSE 'gemini' END AS source,
       'S' || cast(l_partkey % 40 AS varchar) AS symbol,
       CASE p_type WHEN 'ECONOMY' THEN 'stock' WHEN 'SMALL' THEN 'etf' WHEN 'MEDIUM' THEN 'crypto'
                   WHEN 'PROMO' THEN 'cash' WHEN 'STANDARD' THEN 'option' ELSE 'stock' END AS asset_class,
       l_quantity AS quantity, p_retailprice AS price, l_extendedprice AS market_value, n_name AS currency,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
     JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""")

view("positions", """
SELECT p.*, coalesce(r.fx_rate_to_base, 1.0) AS fx_rate_to_sgd,
       cast(round(cast(p.market_value AS decimal(22,8)) * cast(coalesce(r.fx_rate_to_base, 1.0) AS decimal(14,6)), 2) AS double)
         AS market_value_sgd
FROM positions_raw p LEFT JOIN rates r ON p.currency = r.currency
""", ("positions_raw", "rates"))

view("balances", """
SELECT o_orderdate AS etl_time, 'bank_savings' AS source,
       'acct_' || cast(o_custkey % 3 AS varchar) || '.pdf' AS source_file,
       strftime(CASE WHEN year(o_orderdate) = 1997 AND month(o_orderdate) = 5 THEN o_orderdate - INTERVAL 1 MONTH ELSE o_orderdate END, '%Y-%m')
         AS statement_date,
       CASE WHEN month(o_orderdate) % 6 = 0 THEN cast(0 AS double)
            ELSE cast(round(cast(o_totalprice AS decimal(18,2)), 2) AS double) END AS balance,
       'SGD' AS currency, o_orderkey
FROM orders
""")

view("pension", """
SELECT o_orderdate AS etl_time, 'cpf_' || cast(o_orderkey AS varchar) || '.pdf' AS source_file,
       cast(o_orderdate AS date) AS statement_date,
       cast(round(cast(o_totalprice AS decimal(18,2)) * 0.60, 2) AS double) AS ordinary_account,
       cast(round(cast(o_totalprice AS decimal(18,2)) * 0.25, 2) AS double) AS special_account,
       cast(round(cast(o_totalprice AS decimal(18,2)) * 0.15, 2) AS double) AS medisave_account,
       cast(round(round(cast(o_totalprice AS decimal(18,2)) * 0.60, 2) + round(cast(o_totalprice AS decimal(18,2)) * 0.25, 2)
                  + round(cast(o_totalprice AS decimal(18,2)) * 0.15, 2), 2) AS double) AS total_cpf,
       'SGD' AS currency, o_orderkey
FROM orders
""")

view("run_status", """
SELECT cast(ts AS date) AS run_date, max(ts) AS run_time, 'investment' AS pipeline, event_type AS source,
       CASE event_id % 3 WHEN 0 THEN 'live' WHEN 1 THEN 'fallback' ELSE 'failed' END AS status,
       count(*) AS row_count, '' AS message
FROM events GROUP BY cast(ts AS date), event_type, CASE event_id % 3 WHEN 0 THEN 'live' WHEN 1 THEN 'fallback' ELSE 'failed' END
""")

# ------------------------------------------------------------- model CTEs

TX_ID = ("md5(coalesce(source_file, '') || coalesce(date, '') || coalesce(description, '') || "
         "coalesce(cast(cast(amount AS decimal(18,2)) AS varchar), ''))")

OVERRIDE = """CASE
  WHEN amount < 0 AND upper(description) LIKE '%UOB KAY HIAN%' THEN 'Endowus'
  WHEN transaction_type = 'Credit Card' AND amount > 0 AND upper(description) LIKE '%PAYMT%' THEN 'Transfer'
  WHEN amount > 0 AND (upper(description) LIKE '%SALA%' OR upper(description) LIKE '%SALARY%' OR upper(description) LIKE '%PAYROLL%') THEN 'Income'
  WHEN amount > 0 AND (upper(description) LIKE '%GOV |%' OR upper(description) LIKE '%GST VOUCHER%' OR upper(description) LIKE '%CDC VOUCHER%'
                       OR upper(description) LIKE '%SKILLSFUTURE%' OR upper(description) LIKE '%WORKFARE%') THEN 'Income'
  WHEN amount > 0 AND (upper(description) LIKE '%CASH REBATE%' OR upper(description) LIKE '%CASHBACK%' OR upper(description) LIKE '%REBATE%') THEN 'Income'
  WHEN amount > 0 AND transaction_type = '' AND upper(description) LIKE 'PAYNOW OTHR |%' THEN 'Reimbursement'
  ELSE category END"""

PARSE_DATE = "cast(strptime(date, '%d %b %Y') AS date)"

for _name, _src in (("dwd_tx", "tx"), ("dwd_tx_b7", "tx_b7")):
    view(_name, f"""
SELECT transaction_id, etl_time, source_file, transaction_type, transaction_date, year_month, description, amount, currency, category
FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY etl_time DESC, category DESC NULLS LAST) AS rn
  FROM (
    SELECT {TX_ID} AS transaction_id, etl_time, source_file, transaction_type,
           {PARSE_DATE} AS transaction_date, strftime({PARSE_DATE}, '%Y-%m') AS year_month,
           description, amount, currency, category
    FROM (SELECT * REPLACE ({OVERRIDE} AS category) FROM {_src})
    WHERE category NOT IN ('Transfer', 'Income', 'Reimbursement', 'Endowus')
  )
) WHERE rn = 1
""", (_src,))

POS_TIEBREAK = "etl_time DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC"

view("dwd_pos", f"""
SELECT etl_time, date, source, symbol, asset_class, quantity, price, market_value, currency, fx_rate_to_sgd, market_value_sgd
FROM (SELECT *, row_number() OVER (PARTITION BY date, source, symbol ORDER BY {POS_TIEBREAK}) AS rn FROM positions)
WHERE rn = 1
""", ("positions",))

view("bal_latest", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY statement_date, source_file ORDER BY etl_time DESC, o_orderkey DESC) AS rn
  FROM balances) WHERE rn = 1
""", ("balances",))

view("pen_latest", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date_trunc('month', statement_date) ORDER BY statement_date DESC, o_orderkey DESC) AS rn
  FROM pension) WHERE rn = 1
""", ("pension",))

view("raw_tx_latest", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY etl_time DESC, category DESC NULLS LAST) AS rn
  FROM (SELECT *, {TX_ID} AS transaction_id FROM tx)) WHERE rn = 1
""", ("tx",))

view("contrib_monthly", f"""
SELECT cast(date_trunc('month', {PARSE_DATE}) AS date) AS month,
       cast(round(sum(abs({money('amount')})), 2) AS double) AS monthly_sgd
FROM raw_tx_latest
WHERE (category = 'Endowus' OR upper(description) LIKE '%UOB KAY HIAN%') AND amount < 0
GROUP BY 1
""", ("raw_tx_latest",))

view("contrib_cum", f"""
SELECT month AS date,
       cast(round(sum({money('monthly_sgd')}) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS double)
         AS market_value_sgd
FROM contrib_monthly
""", ("contrib_monthly",))

view("bank_monthly", f"""
SELECT cast(statement_date || '-01' AS date) AS date, {msum('balance')} AS cash_sgd
FROM bal_latest GROUP BY 1
""", ("bal_latest",))

view("inv_month_end", f"""
SELECT cast(date_trunc('month', date) AS date) AS date, source, asset_class, {msum('market_value_sgd')} AS market_value_sgd
FROM dwd_pos
WHERE date IN (SELECT max(date) FROM dwd_pos GROUP BY date_trunc('month', date))
GROUP BY 1, 2, 3
""", ("dwd_pos",))

view("pen_unpivot", """
SELECT cast(date_trunc('month', statement_date) AS date) AS date, 'cpf' AS source, 'cpf_oa' AS asset_class,
       cast(round(cast(ordinary_account AS decimal(18,2)), 2) AS double) AS market_value_sgd FROM pen_latest
UNION ALL
SELECT cast(date_trunc('month', statement_date) AS date), 'cpf', 'cpf_sa',
       cast(round(cast(special_account AS decimal(18,2)), 2) AS double) FROM pen_latest
UNION ALL
SELECT cast(date_trunc('month', statement_date) AS date), 'cpf', 'cpf_ma',
       cast(round(cast(medisave_account AS decimal(18,2)), 2) AS double) FROM pen_latest
""", ("pen_latest",))

view("nw_history", """
SELECT date, source, asset_class, market_value_sgd FROM inv_month_end
UNION ALL SELECT date, 'uob_savings', 'cash', cash_sgd FROM bank_monthly
UNION ALL SELECT date, source, asset_class, market_value_sgd FROM pen_unpivot
UNION ALL SELECT date, 'endowus', 'endowus', market_value_sgd FROM contrib_cum
""", ("inv_month_end", "bank_monthly", "pen_unpivot", "contrib_cum"))


def _cls_sum(classes: str, nullif: bool) -> str:
    s = f"round(sum(CASE WHEN asset_class IN ({classes}) THEN {money('market_value_sgd')} ELSE 0 END), 2)"
    if nullif:
        s = f"nullif({s}, 0)"
    return f"cast({s} AS double)"


view("nw_pivot", f"""
SELECT date,
  {_cls_sum("'stock', 'etf'", False)} AS stocks_sgd,
  {_cls_sum("'crypto'", False)} AS crypto_sgd,
  {_cls_sum("'cash'", True)} AS cash_sgd,
  {_cls_sum("'cpf_oa'", True)} AS cpf_oa_sgd,
  {_cls_sum("'cpf_sa'", True)} AS cpf_sa_sgd,
  {_cls_sum("'cpf_ma'", True)} AS cpf_ma_sgd,
  {_cls_sum("'endowus'", True)} AS endowus_principal_sgd
FROM nw_history GROUP BY date
""", ("nw_history",))

CARRIED = ["cash_sgd", "cpf_oa_sgd", "cpf_sa_sgd", "cpf_ma_sgd", "endowus_principal_sgd"]


def fill_sql(cols, order="date", keys=""):
    part = f"PARTITION BY {keys} " if keys else ""
    return ",\n  ".join(
        f"last_value({c} IGNORE NULLS) OVER ({part}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in cols)


def row_total_sql(cols):
    return "cast(round(" + " + ".join(f"coalesce({money(c)}, 0)" for c in cols) + ", 2) AS double)"


FINAL_COLS = f"""date, stocks_sgd, crypto_sgd,
  {row_total_sql(['stocks_sgd', 'crypto_sgd'])} AS investment_sgd,
  coalesce(cash_sgd, 0.0) AS cash_sgd, coalesce(endowus_principal_sgd, 0.0) AS endowus_principal_sgd,
  coalesce(cpf_oa_sgd, 0.0) AS cpf_oa_sgd, coalesce(cpf_sa_sgd, 0.0) AS cpf_sa_sgd, coalesce(cpf_ma_sgd, 0.0) AS cpf_ma_sgd,
  {row_total_sql(['cpf_oa_sgd', 'cpf_sa_sgd', 'cpf_ma_sgd'])} AS total_cpf_sgd,
  {row_total_sql(['stocks_sgd', 'crypto_sgd', 'cash_sgd', 'endowus_principal_sgd'])} AS total_net_worth_excl_cpf_sgd,
  {row_total_sql(['stocks_sgd', 'crypto_sgd', 'cash_sgd', 'endowus_principal_sgd', 'cpf_oa_sgd', 'cpf_sa_sgd', 'cpf_ma_sgd'])}
    AS total_net_worth_sgd"""

view("nw_monthly", f"""
SELECT {FINAL_COLS}
FROM (SELECT date, stocks_sgd, crypto_sgd,
  {fill_sql(CARRIED)}
  FROM nw_pivot)
""", ("nw_pivot",))

view("inv_daily", f"""
SELECT date, {_cls_sum("'stock', 'etf'", False)} AS stocks_sgd, {_cls_sum("'crypto'", False)} AS crypto_sgd
FROM dwd_pos GROUP BY date
""", ("dwd_pos",))

view("bank_ranged", """
SELECT date, cash_sgd, lead(date, 1, DATE '9999-12-31') OVER (ORDER BY date) AS next_date FROM bank_monthly
""", ("bank_monthly",))

view("pen_monthly", """
SELECT cast(date_trunc('month', statement_date) AS date) AS date,
       cast(round(cast(ordinary_account AS decimal(18,2)), 2) AS double) AS cpf_oa_sgd,
       cast(round(cast(special_account AS decimal(18,2)), 2) AS double) AS cpf_sa_sgd,
       cast(round(cast(medisave_account AS decimal(18,2)), 2) AS double) AS cpf_ma_sgd
FROM pen_latest
""", ("pen_latest",))

view("nw_daily_joined", """
SELECT i.date, i.stocks_sgd, i.crypto_sgd, b.cash_sgd, c.cpf_oa_sgd, c.cpf_sa_sgd, c.cpf_ma_sgd,
       e.market_value_sgd AS endowus_principal_sgd
FROM inv_daily i
LEFT JOIN bank_ranged b ON cast(date_trunc('month', i.date) AS date) >= b.date AND cast(date_trunc('month', i.date) AS date) < b.next_date
LEFT JOIN pen_monthly c ON c.date = cast(date_trunc('month', i.date) AS date)
LEFT JOIN contrib_cum e ON e.date = cast(date_trunc('month', i.date) AS date)
""", ("inv_daily", "bank_ranged", "pen_monthly", "contrib_cum"))

view("nw_daily", f"""
SELECT *, cast(round({money('total_net_worth_sgd')} - lag({money('total_net_worth_sgd')}) OVER (ORDER BY date), 2) AS double)
            AS day_over_day_change_sgd
FROM (
  SELECT {FINAL_COLS}
  FROM (SELECT date, stocks_sgd, crypto_sgd,
    {fill_sql(CARRIED)}
    FROM nw_daily_joined))
""", ("nw_daily_joined",))

view("m_spend", f"""
SELECT year_month, category,
  cast(round(sum(CASE WHEN amount < 0 THEN abs({money('amount')}) ELSE 0 END), 2) AS double) AS total_debit,
  cast(round(sum(CASE WHEN amount > 0 THEN {money('amount')} ELSE 0 END), 2) AS double) AS total_credit,
  cast(round(sum(CASE WHEN amount < 0 THEN abs({money('amount')}) ELSE 0 END)
             - sum(CASE WHEN amount > 0 THEN {money('amount')} ELSE 0 END), 2) AS double) AS net_spend,
  count(*) AS tx_count
FROM dwd_tx GROUP BY year_month, category
""", ("dwd_tx",))

EVENT_CCY = "CASE event_id % 6 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' WHEN 2 THEN 'USD' WHEN 3 THEN 'SOL' WHEN 4 THEN 'SGD' ELSE 'DOGE' END"

view("exchange_payloads", f"""
SELECT user_id, event_id,
       '[{{"currency":"' || {EVENT_CCY} || '","amount":"' || cast(cast(value AS decimal(18,2)) - 50 AS varchar)
         || '","available":"0"}},{{"currency":"LTC"}}]' AS payload
FROM events
""")

view("spot_prices", """
SELECT CASE event_id % 4 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' WHEN 2 THEN 'SOL' ELSE 'ADA' END AS currency,
       max(value) * 1000.0 AS price
FROM events GROUP BY 1
""")

view("exchange_balances", """
SELECT user_id, event_id, b.currency AS currency, coalesce(b.amount, '0') AS amount
FROM (SELECT user_id, event_id,
             unnest(from_json(payload, '[{"currency":"VARCHAR","amount":"VARCHAR","available":"VARCHAR"}]')) AS b
      FROM exchange_payloads)
""", ("exchange_payloads",))
