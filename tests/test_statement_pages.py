"""Statements are gathered once by page, and no step repeats the folds of a page."""

import random

from ledgerflow.operators import statements as st
from ledgerflow.plans import fixtures as fx
from tests.conftest import SF_SMALL

WORDS = "source_file string, page int, text string, x0 double, x1 double, top double"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def key(*values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def test_lines_of_gathered_pages_equal_the_rule(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice(["x", "y ", " z", "", None]), rng.choice([1.0, 2.0, None]),
             rng.choice([3.0, None]), rng.choice([10.0, 10.04, 10.06, 30.0, -0.0, 0.0, -0.02, None])) for _ in range(600)]
    want = {}
    for file, page, text, x0, x1, top in rows:
        line = want.setdefault((file, page, None if top is None else round(top, 1) + 0.0), [])
        line.append((key(x0, x1), (text is not None, text or ""), (x0, x1, text)))
    want = {k: [w for *_, w in sorted(v)] for k, v in want.items()}
    got = st.words_to_lines(spark.createDataFrame(rows, WORDS).repartition(5)).collect()
    assert {(r["source_file"], r["page"], r["top"]): [tuple(w) for w in r["words"]] for r in got} == want and len(got) == len(want)
    assert all(r["text"] == " ".join(w["text"] for w in r["words"] if w["text"] is not None).strip(" ") for r in got)
    assert got[0]["words"][0].__fields__ == ["x0", "x1", "text"]


def test_words_are_gathered_by_page_not_by_line(spark):
    facts = st.statement_facts(st.page_text(st.page_lines(fx.statement_words(spark, SF_SMALL))))
    gathered = [line for line in plan(facts) if "collect_list" in line]
    assert len(gathered) == 1 and "round(" not in gathered[0] and "[source_file" in gathered[0]


def test_an_order_is_formatted_once_not_for_each_word(spark):
    for kind in ("savings", "credit_card"):
        lines = plan(fx.statement_words(spark, SF_SMALL, kind))
        above = lines[:next(i for i, line in enumerate(lines) if "Generate" in line)]
        assert above and not any("date_format" in line or "format_number" in line for line in above)


def test_both_parsers_read_the_words_once_and_no_filter_folds(spark):
    page = [("Withdrawals", 300.0, 80.0), ("Deposits", 400.0, 80.0), ("Balance", 500.0, 80.0),
            ("01", 20.0, 100.0), ("Jan", 32.0, 100.0), ("Shop", 150.0, 100.0), ("12.00", 405.0, 100.0)]
    words = spark.createDataFrame([("a.pdf", 1, t, x, x + 30.0, top) for t, x, top in page], WORDS)
    tx, _ = st.parse_statements(words)
    assert len([line for line in plan(tx) if "collect_list" in line]) == 2  # transactions and facts, on one shuffle
    assert not any("Filter" in line and "lambda" in line for line in plan(tx))
    assert len(tx.collect()) == 1 and "ReusedExchange" in tx._jdf.queryExecution().executedPlan().toString()


def test_pages_with_both_headers_and_odd_words(spark):
    """A page that holds both tables is read by the parser of its file's type; null words and null files do no harm."""
    head = [("Withdrawals", 300.0, 80.0), ("Deposits", 400.0, 80.0), ("Balance", 500.0, 80.0)]
    card = [("Transaction", 300.0, 90.0), ("Amount", 400.0, 90.0)]
    row = [("01", 20.0, 100.0), ("Jan", 32.0, 100.0), ("Shop", 150.0, 100.0), (None, 200.0, 100.0), ("12.00", 405.0, 100.0),
           ("02", 20.0, 120.0), ("JAN", 32.0, 120.0), ("Cafe", 150.0, 120.0), ("7.00CR", 405.0, 120.0)]
    rows = [(f, 1, t, x, x + 30.0, top) for f, words in (("s.pdf", head + row), ("c.pdf", head + card + row), (None, head + row)) for t, x, top in words]
    tx, facts = st.parse_statements(spark.createDataFrame(rows, WORDS))
    got = sorted((r["source_file"], r["date"], r["description"], r["amount"]) for r in tx.collect())
    assert got == [("c.pdf", "02 JAN 2026", "Cafe", 7.0), ("s.pdf", "01 Jan 2025", "Shop | 02 JAN Cafe 7.00CR", -12.0)]
    assert sorted(map(str, (r["source_file"] for r in facts.collect()))) == ["None", "c.pdf", "s.pdf"]
