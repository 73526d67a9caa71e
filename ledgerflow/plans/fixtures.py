"""Finance-shaped views derived from the driver's tables.

Each view is a lazy DataFrame over the parquet tables (column pruning and
filters reach the scan), so its work grows with the tables.  The DuckDB
oracle builds the same views as CTEs (``ledgerflow.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.money import money
from ledgerflow.operators.fx import convert_to_base, invert_rates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as the scan splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, pairs: list[tuple[object, str]], default: Column | str | None) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d)


# ---------------------------------------------------------------------------
# bank transactions (raw ods shape), 10% of orders re-delivered a day later
# ---------------------------------------------------------------------------

def tx(spark: SparkSession, sf_dir: str, copy_category: str | None = None) -> DataFrame:
    """Raw transactions.  ``copy_category`` overrides the category of re-delivered copies."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    copies = F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    o = o.withColumn("copy", F.explode(copies))
    desc_head = _case(k % 13, [(0, "Uob Kay Hian"), (1, "PAYMT thru"), (2, "Acme Salary"), (3, "Gov | credit"),
                               (4, "Cash Rebate"), (5, "PayNow OTHR | someone")], "Shop")
    by_priority = _case(F.col("o_orderpriority"), [("1-URGENT", "Dining"), ("2-HIGH", "Groceries"),
                                                   ("3-MEDIUM", "Transport"), ("4-NOT SPECIFIED", "Shopping")], "Other")
    category = F.when(k % 97 == 0, F.lit(None).cast("string")).when(k % 29 == 0, F.lit("Transfer")).otherwise(by_priority)
    if copy_category is not None:
        category = F.when(F.col("copy") == 1, F.lit(copy_category)).otherwise(category)
    return o.select(
        (F.col("o_orderdate") + F.make_dt_interval(F.col("copy"), F.lit(0), F.lit(0), F.lit(0))).alias("etl_time"),
        F.concat(F.lit("stmt_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".pdf")).alias("source_file"),
        _case(k % 3, [(0, "Credit Card"), (1, "")], "FAST Payment").alias("transaction_type"),
        F.date_format("o_orderdate", "dd MMM yyyy").alias("date"),
        F.concat(desc_head, F.lit(" "), k.cast("string")).alias("description"),
        F.when(k % 5 < 3, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.lit("SGD").alias("currency"),
        category.alias("category"),
    )


def tx_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(new, already loaded): the loaded half is every statement of an even month."""
    t = tx(spark, sf_dir)
    even = (F.substring("source_file", 11, 2).cast("int") % 2) == 0
    return t, t.filter(even)


# ---------------------------------------------------------------------------
# FX rates and investment positions
# ---------------------------------------------------------------------------

def quoted_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of each currency per 1 SGD (one nation quoted under another code, so it has no rate; two zero rates)."""
    n = table(spark, sf_dir, "nation").withColumn(
        "n_name", F.when(F.col("n_nationkey") == 3, F.lit("UNQUOTED")).otherwise(F.col("n_name")))
    rate = F.when(F.col("n_nationkey") % 11 == 7, F.lit(0.0)).otherwise(F.col("n_nationkey").cast("double") + F.lit(0.37))
    return n.select(F.col("n_name").alias("currency"), rate.alias("rate"))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invert_rates(quoted_rates(spark, sf_dir))


POSITION_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def positions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions before FX (plus the lineitem tie-break columns)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name"))
    supp_ccy = supp.join(nation, "s_nationkey").select("s_suppkey", F.col("n_name").alias("currency"))
    j = li.join(part, li.l_partkey == part.p_partkey).join(supp_ccy, li.l_suppkey == supp_ccy.s_suppkey)
    cls = _case(F.col("p_type"), [("ECONOMY", "stock"), ("SMALL", "etf"), ("MEDIUM", "crypto"), ("PROMO", "cash"),
                                  ("STANDARD", "option")], "stock")
    return j.select(
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"), F.lit(0), F.lit(0))).alias("etl_time"),
        F.col("l_shipdate").cast("date").alias("date"),
        _case(F.col("l_returnflag"), [("A", "ibkr"), ("N", "tiger")], "gemini").alias("source"),
        F.concat(F.lit("S"), (F.col("l_partkey") % 40).cast("string")).alias("symbol"),
        cls.alias("asset_class"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_retailprice").alias("price"),
        F.col("l_extendedprice").alias("market_value"),
        "currency",
        *POSITION_TIEBREAK,
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ods positions: FX rate looked up (unknown -> 1.0) and value converted."""
    return convert_to_base(positions_raw(spark, sf_dir), rates(spark, sf_dir))


# ---------------------------------------------------------------------------
# account balances and pension balances
# ---------------------------------------------------------------------------

def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    # May 1997 is booked a month early: a gap in the statements without dropping a row.
    gap = (F.year("o_orderdate") == 1997) & (F.month("o_orderdate") == 5)
    booked = F.when(gap, F.add_months("o_orderdate", -1)).otherwise(F.to_date("o_orderdate"))
    bal = F.when(F.month("o_orderdate") % 6 == 0, F.lit(0.0)).otherwise(F.round(money("o_totalprice"), 2).cast("double"))
    return o.select(
        F.col("o_orderdate").alias("etl_time"),
        F.lit("bank_savings").alias("source"),
        F.concat(F.lit("acct_"), (F.col("o_custkey") % 3).cast("string"), F.lit(".pdf")).alias("source_file"),
        F.date_format(booked, "yyyy-MM").alias("statement_date"),
        bal.alias("balance"),
        F.lit("SGD").alias("currency"),
        "o_orderkey",
    )


def pension(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    tp = money("o_totalprice")
    oa = F.round(tp * F.lit(0.60).cast("decimal(3,2)"), 2)
    sa = F.round(tp * F.lit(0.25).cast("decimal(3,2)"), 2)
    ma = F.round(tp * F.lit(0.15).cast("decimal(3,2)"), 2)
    return o.select(
        F.col("o_orderdate").alias("etl_time"),
        F.concat(F.lit("cpf_"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("source_file"),
        F.col("o_orderdate").cast("date").alias("statement_date"),
        oa.cast("double").alias("ordinary_account"),
        sa.cast("double").alias("special_account"),
        ma.cast("double").alias("medisave_account"),
        F.round(oa + sa + ma, 2).cast("double").alias("total_cpf"),
        F.lit("SGD").alias("currency"),
        "o_orderkey",
    )


# ---------------------------------------------------------------------------
# pipeline run status (from events)
# ---------------------------------------------------------------------------

def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    status = _case(F.col("event_id") % 3, [(0, "live"), (1, "fallback")], "failed")
    return (
        e.groupBy(F.col("ts").cast("date").alias("run_date"), F.col("event_type").alias("source"), status.alias("status"))
        .agg(F.max("ts").alias("run_time"), F.count(F.lit(1)).alias("row_count"))
        .select("run_date", "run_time", F.lit("investment").alias("pipeline"), "source", "status", "row_count",
                F.lit("").alias("message"))
    )


def daily_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(days, status, tables) of one report a day.  By the day's number modulo 7: 0 all live, 1 some sources on fallback, 2 some
    failed, 3 the tables of the day before, 4 the job did not run, 5 no table known, 6 neither; 'purchase' stands for the rates."""
    e = table(spark, sf_dir, "events").select("ts", "event_type")
    g = e.groupBy(F.col("ts").cast("date").alias("run_date"), "event_type").agg(F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
    g = g.withColumn("kind", F.pmod(F.unix_date("run_date"), F.lit(7)))
    days = g.select("run_date").distinct()
    odd = F.length("event_type") % 2 == 1
    status = F.when((F.col("kind") == 1) & odd, F.lit("fallback")).when((F.col("kind") == 2) & odd, F.lit("failed")).otherwise(F.lit("live"))
    is_rates = F.col("event_type") == "purchase"
    runs = g.filter(F.col("kind").isin(0, 1, 2, 3, 5)).select(
        "run_date", F.when(is_rates, F.lit("fx")).otherwise(F.col("event_type")).alias("source"), status.alias("status"),
        F.when(~is_rates, F.col("n")).alias("row_count"))
    # The last load of the day was shortly before the report (22:30 UTC of that day), in kind 3 a day earlier.
    modified = F.col("run_date").cast("timestamp_ntz") + F.make_dt_interval(
        F.when(F.col("kind") == 3, F.lit(-1)).otherwise(F.lit(0)), F.lit(22), F.minute("last"), F.second("last"))
    as_of = F.col("run_date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(23), F.lit(30), F.lit(0))
    tables = g.filter(F.col("kind").isin(0, 1, 2, 3, 4)).select(
        "run_date", F.concat(F.lit("ads_"), F.col("event_type")).alias("table"), modified.alias("last_modified"), as_of.alias("as_of"))
    return days, runs, tables


# ---------------------------------------------------------------------------
# exchange balance payloads and spot prices (from events)
# ---------------------------------------------------------------------------

def _event_currency(col: Column) -> Column:
    return _case(col % 6, [(0, "BTC"), (1, "ETH"), (2, "USD"), (3, "SOL"), (4, "SGD")], "DOGE")


def exchange_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON balance list per event: a balance of (value - 50) and an entry with no amount."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    amount = (F.col("value").cast("decimal(18,2)") - F.lit(50)).cast("string")
    payload = F.concat(F.lit('[{"currency":"'), _event_currency(F.col("event_id")), F.lit('","amount":"'), amount,
                       F.lit('","available":"0"},{"currency":"LTC"}]'))
    return e.select("user_id", "event_id", payload.alias("payload"))


def spot_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price per coin (DOGE has none)."""
    e = table(spark, sf_dir, "events").select("event_id", "value")
    coin = _case(F.col("event_id") % 4, [(0, "BTC"), (1, "ETH"), (2, "SOL")], "ADA")
    return e.groupBy(coin.alias("currency")).agg((F.max("value") * F.lit(1000.0)).alias("price"))


# ---------------------------------------------------------------------------
# statement words (what a PDF word extractor emits), from orders
# ---------------------------------------------------------------------------

def _w(line: int, x0: float, x1: float, text: Column, keep: Column | None = None) -> Column:
    """One word struct; ``keep`` False turns it into NULL (dropped after explode)."""
    s = F.struct(F.lit(float(line)).alias("dy"), F.lit(float(x0)).alias("x0"), F.lit(float(x1)).alias("x1"), text.alias("text"))
    return s if keep is None else F.when(keep, s)


def _explode_words(df: DataFrame, words: list[Column]) -> DataFrame:
    """The words of each row, on its ``source_file`` and ``page``, below its ``base``."""
    e = df.select("source_file", "page", "base", F.explode(F.array(*words)).alias("w"))
    return e.filter(F.col("w").isNotNull()).select(
        "source_file", "page", F.col("w.text").alias("text"), F.col("w.x0").alias("x0"), F.col("w.x1").alias("x1"),
        (F.col("base") + F.col("w.dy")).alias("top"))


def statement_words(spark: SparkSession, sf_dir: str, kind: str = "savings") -> DataFrame:
    """Words of savings ('sav_YYYY_N.pdf') or card ('card_YYYY_N.pdf') statements: orders of
    one year and one block of 1,024 keys per file, 32 key slots per page, one transaction
    per order plus page and file headers."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    prefix = "sav_" if kind == "savings" else "card_"
    file_col = F.concat(F.lit(prefix), F.date_format("o_orderdate", "yyyy"), F.lit("_"), (k / 1024).cast("long").cast("string"),
                        F.lit(".pdf"))
    page = ((k % 1024) / 32).cast("int") + 1
    top = F.lit(100.0) + (k % 32).cast("double") * 24.0
    # An order's file, date and amount are formatted once, below the explode, not for each of its words.
    mon = F.date_format("o_orderdate", "MMM")
    o = o.select("o_orderkey", "o_orderdate", "o_totalprice", file_col.alias("source_file"), page.alias("page"), top.alias("base"),
                 F.format_number(money("o_totalprice"), 2).alias("amt"), F.date_format("o_orderdate", "dd").alias("day"),
                 (mon if kind == "savings" else F.upper(mon)).alias("mon"))
    amt, day, mon = F.col("amt"), F.col("day"), F.col("mon")
    if kind == "savings":
        m4 = k % 4
        t1 = _case(m4, [(0, "Inward"), (1, "Bill"), (3, "Misc")], F.lit(None).cast("string"))
        t2 = _case(m4, [(0, "Credit"), (1, "Payment"), (3, "Debit")], F.lit(None).cast("string"))
        wd = k % 5 < 3
        on_first = k % 7 != 0
        words = [
            _w(0, 20, 32, day), _w(0, 40, 60, mon),
            _w(0, 80, 120, t1, t1.isNotNull()), _w(0, 125, 165, t2, t2.isNotNull()),
            _w(0, 310, 350, amt, on_first & wd), _w(0, 410, 450, amt, on_first & ~wd),
            _w(0, 515, 555, amt, k % 2 == 0),
            _w(12, 80, 110, F.lit("Shop")), _w(12, 115, 150, k.cast("string")),
            _w(12, 310, 350, amt, ~on_first & wd), _w(12, 410, 450, amt, ~on_first & ~wd),
            _w(18, 80, 130, F.concat(F.lit("PIB"), k.cast("string")), k % 3 == 0),
        ]
        header = [("Date", 20, 45), ("Description", 80, 150), ("Withdrawals", 300, 360), ("Deposits", 405, 455), ("Balance", 505, 565)]
    else:
        cr = F.when(k % 5 >= 3, F.lit("CR")).otherwise(F.lit(""))
        words = [
            _w(0, 20, 32, day), _w(0, 40, 62, mon),
            _w(0, 70, 82, day, k % 2 == 0), _w(0, 90, 112, mon, k % 2 == 0),
            _w(0, 150, 190, F.lit("SHOP")), _w(0, 195, 240, k.cast("string")),
            _w(0, 350, 390, F.lit("0.99"), k % 7 == 0),
            _w(0, 400, 460, F.concat(amt, cr)),
            _w(12, 150, 180, F.lit("Ref"), k % 3 == 0), _w(12, 185, 200, F.lit("No."), k % 3 == 0),
            _w(12, 205, 240, k.cast("string"), k % 3 == 0),
            _w(18, 400, 420, F.lit("CR"), k % 11 == 0),
            _w(20, 400, 440, F.lit("5.50CR"), k % 13 == 0),
        ]
        header = [("Post", 20, 40), ("Date", 45, 65), ("Trans", 70, 90), ("Date", 95, 115), ("Description", 150, 200),
                  ("of", 205, 215), ("Transaction", 220, 280), ("Transaction", 400, 450), ("Amount", 455, 490)]
    tx_words = _explode_words(o, words)

    pages = o.select("source_file", "page").distinct().withColumn("base", F.lit(0.0))
    page_words = [_w(40, 20, 50, F.lit("Page")), _w(40, 55, 65, F.col("page").cast("string"))] + \
                 [_w(60, x0, x1, F.lit(t)) for t, x0, x1 in header]
    hdr_words = _explode_words(pages, page_words)

    per_file = o.groupBy("source_file").agg(F.min("o_orderdate").alias("d0"), F.sum(money("o_totalprice")).alias("tot"))
    y0, m0 = F.date_format("d0", "yyyy"), F.date_format("d0", "MMM")
    if kind == "savings":
        file_words = [_w(10, 20, 80, F.lit("Statement")), _w(10, 85, 100, F.lit("of")), _w(10, 105, 160, F.lit("Account")),
                      _w(20, 20, 60, F.lit("Period:")), _w(20, 65, 80, F.lit("01")), _w(20, 85, 100, m0), _w(20, 105, 130, y0),
                      _w(30, 20, 40, F.lit("One")), _w(30, 45, 80, F.lit("Account")), _w(30, 85, 100, F.lit("SGD")),
                      _w(30, 105, 160, F.format_number(F.col("tot"), 2))]
    else:
        file_words = [_w(20, 20, 60, F.lit("Statement")), _w(20, 65, 85, F.lit("Date")), _w(20, 90, 100, F.lit("01")),
                      _w(20, 105, 125, F.upper(m0)), _w(20, 130, 160, y0)]
    first_words = _explode_words(per_file.withColumns({"page": F.lit(1), "base": F.lit(0.0)}), file_words)
    return tx_words.unionByName(hdr_words).unionByName(first_words)


def pension_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pension statement text per pension row ('as at' date and three labelled balances)."""
    p = pension(spark, sf_dir)
    fmt = lambda c: F.concat(F.lit("$"), F.format_number(F.col(c).cast("decimal(18,2)"), 2))
    text = F.concat_ws(
        "\n",
        F.lit("Account balances"),
        F.concat(F.lit("as at "), F.date_format("statement_date", "d MMM yyyy")),
        F.concat(F.lit("Ordinary Account "), fmt("ordinary_account")),
        F.concat(F.lit("SPECIAL ACCOUNT "), fmt("special_account")),
        F.concat(F.lit("MediSave Account "), fmt("medisave_account")),
        F.lit("Total"),
    )
    return p.select("source_file", text.alias("text"))
