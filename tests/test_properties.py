"""Property checks: idempotence, order independence, range integrity, and owner keys."""

from pyspark.sql import functions as F

from ledgerflow.functions.dates import month_start
from ledgerflow.operators import dedup, rollup, timeline
from ledgerflow.plans import fixtures as fx
from ledgerflow.plans import models as m
from ledgerflow.plans.q_models import _history, bal_tb, pos_tb

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fill_forward_idempotent(spark):
    piv = rollup.pivot_classes(_history(spark, SF), m.MONTHLY_CLASSES, zero_as_null=m.CARRIED)
    once = timeline.fill_forward(piv, m.CARRIED)
    assert _rows(once) == _rows(timeline.fill_forward(once, m.CARRIED))


def test_dedup_idempotent_and_order_independent(spark):
    pos = fx.positions(spark, SF)
    keys = ["date", "source", "symbol"]
    a = dedup.dedup_latest(pos, keys, tiebreak=pos_tb())
    b = dedup.dedup_latest(pos.repartition(7, F.rand(3)), keys, tiebreak=pos_tb())
    assert _rows(a) == _rows(b)
    assert _rows(dedup.dedup_latest(a, keys, tiebreak=pos_tb())) == _rows(a)


def test_running_total_ends_at_sum(spark):
    cum = m.contributions_cumulative(fx.tx(spark, SF))
    last = cum.orderBy(F.col("date").desc()).first().market_value_sgd
    latest = m.raw_tx_latest(fx.tx(spark, SF))
    monthly = rollup.monthly_contributions(latest.withColumn("transaction_date", F.to_date("etl_time")))
    total = monthly.agg(F.sum(F.col("monthly_sgd").cast("decimal(18,2)"))).first()[0]
    assert round(float(total), 2) == last


def test_validity_ranges_chain_without_overlap(spark):
    bank = rollup.monthly_balance(m.latest_balances(fx.balances(spark, SF), tiebreak=bal_tb()))
    r = timeline.to_ranges(bank).orderBy("date").collect()
    assert all(a.next_date == b.date for a, b in zip(r, r[1:]))
    assert all(x.date < x.next_date for x in r)


def test_month_asof_join_equals_range_join(spark):
    inv = rollup.pivot_classes(m.dwd_positions(fx.positions(spark, SF), tiebreak=pos_tb()), m.DAILY_CLASSES)
    bank = rollup.monthly_balance(m.latest_balances(fx.balances(spark, SF), tiebreak=bal_tb()))
    asof = timeline.month_asof_join(inv, bank, "date", "date", ["cash_sgd"]).select("date", "cash_sgd")
    ranges = timeline.to_ranges(bank).select("date", "next_date", "cash_sgd")
    generic = timeline.interval_join(inv.withColumn("m", month_start("date")), ranges, "m").select(inv["date"], "cash_sgd")
    assert _rows(asof) == _rows(generic)


def _two_owners(df):
    return df.withColumn("owner", F.lit("a")).unionByName(df.withColumn("owner", F.lit("b")))


def test_owner_keys_partition_every_model(spark):
    """Two owners with identical books give each the single-owner result."""
    tx, pos, bal, pen = fx.tx(spark, SF), fx.positions(spark, SF), fx.balances(spark, SF), fx.pension(spark, SF)
    inputs1 = {"tx": tx, "positions": pos, "balances": bal, "pension": pen}
    inputs2 = {k: _two_owners(v) for k, v in inputs1.items()}
    names = ["net_worth_monthly", "net_worth_daily", "spend_mom", "savings_rate"]
    kw = dict(as_of="1998-09-15", position_tiebreak=pos_tb(), balance_tiebreak=bal_tb(), pension_tiebreak=bal_tb())
    single = m.run_models(inputs1, names, **kw)
    multi = m.run_models(inputs2, names, keys=["owner"], **kw)
    for n in names:
        expect = _rows(single[n])
        for owner in ("a", "b"):
            assert _rows(multi[n].filter(F.col("owner") == owner).drop("owner")) == expect, n


def test_month_asof_strategies_agree(spark):
    inv = rollup.pivot_classes(m.dwd_positions(fx.positions(spark, SF), tiebreak=pos_tb()), m.DAILY_CLASSES)
    bank = rollup.monthly_balance(m.latest_balances(fx.balances(spark, SF), tiebreak=bal_tb()))
    a = timeline.month_asof_join(inv, bank, "date", "date", ["cash_sgd"], strategy="carry")
    b = timeline.month_asof_join(inv, bank, "date", "date", ["cash_sgd"], strategy="months")
    assert _rows(a.select(*sorted(a.columns))) == _rows(b.select(*sorted(b.columns)))


def test_row_index_equals_window_row_number(spark):
    from ledgerflow.operators.numbering import row_index
    tx = fx.tx(spark, SF)
    order = ["etl_time", "description"]
    a = row_index(tx, ["source_file"], order, bucket=F.to_date("etl_time")).select("source_file", "description", "etl_time", "row_index")
    from pyspark.sql import Window
    w = Window.partitionBy("source_file").orderBy(*order)
    b = tx.select("source_file", "description", "etl_time", (F.row_number().over(w) - 1).cast("long").alias("row_index"))
    assert _rows(a) == _rows(b)
    hot = tx.withColumn("source_file", F.lit("one.pdf"))  # every row in one statement
    c = row_index(hot, ["source_file"], order, bucket=F.to_date("etl_time"))
    assert sorted(r.row_index for r in c.select("row_index").collect()) == list(range(hot.count()))


def test_results_do_not_depend_on_session_time_zone(spark, registry):
    qs, _ = registry
    names = ["stamp_local_date", "freshness", "pipeline_verdict", "append_ods", "net_worth_daily"]
    base = {n: _rows(qs[n](spark, SF)) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for n in names:
            assert _rows(qs[n](spark, SF)) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_shared_models_checkpointed_into_checkpoint_dir(spark):
    import os
    from ledgerflow.session import ensure_checkpoint_dir
    inputs = {"tx": fx.tx(spark, SF), "positions": fx.positions(spark, SF),
              "balances": fx.balances(spark, SF), "pension": fx.pension(spark, SF)}
    names = ["net_worth_monthly", "net_worth_daily", "savings_rate", "spend_mom"]
    kw = dict(as_of="1998-09-15", position_tiebreak=pos_tb(), balance_tiebreak=bal_tb(), pension_tiebreak=bal_tb())
    plain = m.run_models(inputs, names, **kw)
    ckpt_dir = ensure_checkpoint_dir(spark)
    before = sum(len(f) for _, _, f in os.walk(ckpt_dir))
    cut = m.run_models(inputs, names, checkpoint_shared=True, **kw)
    assert sum(len(f) for _, _, f in os.walk(ckpt_dir)) > before
    for n in names:
        assert _rows(cut[n]) == _rows(plain[n]), n
