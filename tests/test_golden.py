"""Golden rows (hand-made inputs with known outputs) for parsers and edge semantics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.dates import parse_statement_date
from ledgerflow.operators import fx as fxops
from ledgerflow.operators import labels as lb
from ledgerflow.operators import rollup, rules, statements as st, timeline
from ledgerflow.plans.q_parsing import broker_positions
from ledgerflow.sources import events, payloads


def test_reply_parse_with_offset_and_fence(spark):
    body = '[{"index":0,"category":"Dining"},{"index":1,"category":"Transport"}]'
    df = spark.createDataFrame([("s", 0, body), ("s", 1, "```json\n" + body + "\n```")], "source_file string, batch int, reply string")
    got = {(r.batch, r.row_index): r.category for r in lb.parse_reply(df).collect()}
    assert got == {(0, 0): "Dining", (0, 1): "Transport", (1, 40): "Dining", (1, 41): "Transport"}
    off = lb.parse_reply(df.filter("batch = 0"), offset=F.lit(5)).collect()
    assert sorted((r.row_index, r.category) for r in off) == [(5, "Dining"), (6, "Transport")]


def test_reply_parse_rejects_bad_json(spark):
    df = spark.createDataFrame([("s", 0, "not json")], "source_file string, batch int, reply string")
    with pytest.raises(Exception):
        lb.parse_reply(df).collect()


def test_attach_label_default_other(spark):
    tx = spark.createDataFrame([("s", 0, "a"), ("s", 1, "b")], "source_file string, row_index int, description string")
    labels = spark.createDataFrame([("s", 0, "Dining")], "source_file string, row_index int, category string")
    got = {r.row_index: r.category for r in lb.attach_label(tx, labels).collect()}
    assert got == {0: "Dining", 1: "Other"}


def test_exchange_balances_drop_zero_and_fiat(spark):
    payload = ('[{"currency":"BTC","amount":"0.5"},{"currency":"ETH","amount":"3.2"},'
               '{"currency":"USD","amount":"1500.00"},{"currency":"LTC","amount":"0.0"}]')
    bal = payloads.explode_balances(spark.createDataFrame([(payload,)], "payload string"))
    coins = rules.exclude(fxops.filter_positions(bal, "positive", q="amount"), "currency", fxops.FIAT)
    prices = spark.createDataFrame([("BTC", 50000.0), ("ETH", 50000.0)], "currency string, price double")
    priced = fxops.market_value(fxops.lookup(coins.withColumnRenamed("amount", "quantity"), prices, "currency", "price", 0.0), "raw")
    got = {r.currency: r.market_value for r in priced.collect()}
    assert got == {"BTC": 25000.0, "ETH": 160000.0}


def test_sectioned_csv_two_records(spark):
    text = ['X,1', 'CurrencyPrimary,AssetClass,Symbol,Quantity,MarkPrice', '"USD","STK","AAPL","50","178.50"', 'bad',
            'USD,ETF,QQQ,10,420.00']
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line_no int, text string")
    got = {r.symbol: (r.asset_class, r.market_value) for r in broker_positions(payloads.read_sectioned_csv(lines)).collect()}
    assert got == {"AAPL": ("stock", 8925.0), "QQQ": ("etf", 4200.0)}


def test_sectioned_csv_duplicate_header_keeps_last(spark):
    text = ['CurrencyPrimary,AssetClass,Symbol,Quantity,MarkPrice,Symbol', 'USD,STK,OLD,1,2.00,NEW']
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line_no int, text string")
    rec = payloads.read_sectioned_csv(lines).collect()
    assert rec[0].record["Symbol"] == "NEW"


def test_statement_dates(spark):
    df = spark.createDataFrame([("7 Feb 2026",), ("07 FEB 2026",), ("07 Feb 2026",)], "d string")
    assert {r.x for r in df.select(parse_statement_date("d").alias("x")).collect()} == {dt.date(2026, 2, 7)}
    bad = spark.createDataFrame([("xx",)], "d string")
    assert bad.select(parse_statement_date("d", on_bad="null").alias("x")).collect()[0].x is None
    with pytest.raises(Exception):
        bad.select(parse_statement_date("d")).collect()


def test_labelled_balances(spark):
    text = "Statement\nas at 31 Jan 2026\nOrdinary Account $1,234.50\nSpecial Account $500.00\nMediSave Account $250.25\n"
    r = st.labelled_balances(spark.createDataFrame([("a.pdf", text)], "source_file string, text string")).collect()[0]
    assert (r.statement_date, r.ordinary_account, r.special_account, r.medisave_account, r.total) == (
        dt.date(2026, 1, 31), 1234.5, 500.0, 250.25, 1984.75)
    missing = spark.createDataFrame([("b.pdf", "as at 31 Jan 2026\nOrdinary Account $1.00")], "source_file string, text string")
    with pytest.raises(Exception):
        st.labelled_balances(missing).collect()
    soft = st.labelled_balances(missing, on_missing="null").collect()[0]
    assert soft.special_account is None


def _words(spark, rows):
    return spark.createDataFrame([("f.pdf", 1, t, float(x0), float(x0) + 30.0, float(top)) for top, x0, t in rows],
                                 "source_file string, page int, text string, x0 double, x1 double, top double")


def test_card_amount_rules(spark):
    words = _words(spark, [
        (10, 20, "Statement"), (10, 60, "Date"), (10, 90, "07"), (10, 110, "FEB"), (10, 140, "2026"),
        (60, 20, "Description"), (60, 60, "of"), (60, 80, "Transaction"), (60, 400, "Amount"),
        (100, 20, "07"), (100, 40, "FEB"), (100, 150, "SHOP"), (100, 195, "ABC"),
        (112, 400, "12.00"), (118, 400, "5.50CR"), (124, 400, "CR"),
        (140, 20, "08"), (140, 40, "FEB"), (140, 70, "08"), (140, 90, "FEB"), (140, 150, "CAFE"),
        (140, 350, "1.00"), (140, 400, "2.00"),
    ])
    tx, facts = st.parse_statements(words)
    got = sorted((r.date, r.description, r.amount) for r in tx.collect())
    assert got == [("07 FEB 2026", "SHOP ABC | 5.50CR | CR", 5.5), ("08 FEB 2026", "CAFE", -2.0)]
    assert facts.collect()[0].statement_type == "credit_card"


def test_savings_amount_rules(spark):
    words = _words(spark, [
        (10, 20, "Period:"), (10, 60, "01"), (10, 80, "Feb"), (10, 100, "2026"),
        (20, 20, "One"), (20, 50, "Account"), (20, 90, "SGD"), (20, 120, "9,999.99"),
        (60, 20, "Date"), (60, 80, "Description"), (60, 315, "Withdrawals"), (60, 415, "Deposits"), (60, 520, "Balance"),
        (100, 20, "7"), (100, 40, "Feb"), (100, 80, "Inward"), (100, 125, "Credit"), (100, 315, "1,000.00"),
        (112, 80, "PAYNOW"), (112, 130, "FROM"), (112, 170, "X"),
        (124, 80, "PIB12345"),
        (140, 20, "8"), (140, 40, "Feb"), (140, 520, "55.00"),
        (152, 80, "Cash"), (152, 120, "Rebate"), (152, 415, "12.34"),
        (170, 20, "9"), (170, 40, "Feb"), (170, 80, "BALANCE"), (170, 130, "B/F"),
    ])
    tx, facts = st.parse_statements(words)
    got = sorted((r.date, r.description, r.amount) for r in tx.collect())
    assert got == [("7 Feb 2026", "Inward Credit | PAYNOW FROM X", 1000.0), ("8 Feb 2026", "Cash Rebate 12.34", 12.34)]
    f = facts.collect()[0]
    assert (f.statement_type, f.year, f.closing_balance) == ("savings", "2026", 9999.99)


def test_carry_forward_and_null_percentages(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 5.0)], "date int, v double")
    assert [r.v for r in timeline.fill_forward(df, ["v"], order=["date"]).orderBy("date").collect()] == [10.0, 10.0, 5.0]
    ch = timeline.period_change(spark.createDataFrame([(1, 0.0), (2, 5.0)], "d int, v double"), "v", order=["d"])
    assert [r.pct for r in ch.orderBy("d").collect()] == [None, None]
    tx = spark.createDataFrame([("2026-01", -5.0)], "year_month string, amount double")
    assert rollup.savings_rate(tx).collect()[0].savings_rate_pct is None


def test_route_events(spark):
    bodies = ['{"data":{"bucket":"b","name":"inbox/a.PDF"}}', '{"bucket":"b","name":"raw/a.pdf"}',
              '{"data":{"bucket":"","name":"inbox/a.pdf"}}', '{"data":{"bucket":"b","name":"inbox/a.txt"}}', 'oops']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [(r.action, r.file) for r in events.route_events(df).collect()]
    assert got == [("process", "a.PDF"), ("skipped", None), ("error", None), ("skipped", None), ("error", None)]
    no_prefix = events.route_events(df, prefix=None).collect()
    assert no_prefix[1].action == "process"


def test_sectioned_csv_header_carries_across_blocks(spark):
    text = ['CurrencyPrimary,AssetClass,Symbol,Quantity,MarkPrice', 'x', 'USD,STK,A,1,2.00', 'y', 'USD,STK,B,1,3.00',
            'CurrencyPrimary,Symbol,AssetClass,Quantity,MarkPrice', 'USD,C,ETF,2,4.00']
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line_no int, text string")
    whole = sorted((r.symbol, r.asset_class, r.market_value) for r in broker_positions(payloads.read_sectioned_csv(lines)).collect())
    blocked = sorted((r.symbol, r.asset_class, r.market_value)
                     for r in broker_positions(payloads.read_sectioned_csv(lines, block_lines=2)).collect())
    assert whole == blocked == [("A", "stock", 2.0), ("B", "stock", 3.0), ("C", "etf", 8.0)]
