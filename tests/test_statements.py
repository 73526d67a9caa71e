"""Statement parsing checked against a brute-force re-derivation of the fixture rules."""

import duckdb

from tests.conftest import SF_SMALL


def _orders():
    return duckdb.sql(f"select o_orderkey k, o_totalprice p, strftime(o_orderdate, '%d %b %Y') ds "
                      f"from '{SF_SMALL}/orders.parquet'").df().set_index("k")


def test_savings_parse_matches_brute_force(spark, registry):
    o = _orders()
    sav = registry[0]["statement_savings"](spark, SF_SMALL).toPandas()
    assert len(sav) == len(o)
    for _, r in sav.iterrows():
        k = int(r.description.split("Shop ")[1].split()[0])
        p = round(o.loc[k, "p"], 2)
        on_first, wd = k % 7 != 0, k % 5 < 3
        t = {0: "Inward Credit", 1: "Bill Payment", 2: "", 3: "Misc Debit"}[k % 4]
        dep = ("Credit" in t) if (on_first and t) else (not wd)
        cont = f"Shop {k}" + ("" if on_first else f" {p:,.2f}")
        assert abs(r.amount - (p if dep else -p)) < 1e-9
        assert r.description == " | ".join(x for x in [t, cont] if x)
        assert r.date.lower() == o.loc[k, "ds"].lower() and r.transaction_type == t


def test_card_parse_matches_brute_force(spark, registry):
    o = _orders()
    card = registry[0]["statement_card"](spark, SF_SMALL).toPandas()
    assert len(card) == len(o)
    for _, r in card.iterrows():
        k = int(r.description.split("SHOP ")[1].split()[0])
        amt, credit = round(o.loc[k, "p"], 2), k % 5 >= 3
        if k % 11 == 0:
            credit = True
        if k % 13 == 0:
            amt, credit = 5.50, True
        parts = [f"SHOP {k}"] + (["CR"] if k % 11 == 0 else []) + (["5.50CR"] if k % 13 == 0 else [])
        assert abs(r.amount - (amt if credit else -amt)) < 1e-9
        assert r.description == " | ".join(parts)


def test_stream_ingest_appends_each_row_once(spark, registry):
    from ledgerflow.plans import fixtures as fx
    got = registry[0]["file_arrival_stream"](spark, SF_SMALL)
    assert got.count() == fx.tx(spark, SF_SMALL).count()
    assert got.select("transaction_id", "etl_time").distinct().count() == got.count()
