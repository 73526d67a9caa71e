"""Statements at size: words are gathered and parsed once for a batch, and a page's cost grows with its words, not with their square."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.operators import statements as st
from ledgerflow.streaming import statements as sl

AS_OF = dt.datetime(2024, 1, 15, 22, 0)


def card_words(file, page, lines, year=None):
    """Words of lines given as (top, text), each word ten to the right of the last."""
    head = [(5.0, f"Statement Date 01 JAN {year}")] if year else []
    return [(file, page, w, 10.0 * i, 10.0 * i + 8, top) for top, text in [*head, (6.0, "Description of Transaction"), *lines] for i, w in enumerate(text.split())]


def words_of(spark, rows):
    return spark.createDataFrame(rows, "source_file string, page int, text string, x0 double, x1 double, top double")


def test_a_batch_is_gathered_once(spark, tmp_path, monkeypatch):
    words = words_of(spark, card_words("card_2024_1.pdf", 1, [(20.0, "03 JAN SHOP A 5.00"), (30.0, "04 JAN SHOP B 7.00CR")], 2024)
                     + card_words("card_2024_2.pdf", 2, [(20.0, "05 JAN SHOP C 9.00")]))
    calls = []
    real = st.page_lines
    monkeypatch.setattr(st, "page_lines", lambda *a, **k: calls.append(1) or real(*a, **k))
    loader = sl.StatementLoader(spark, str(tmp_path), "a", AS_OF)
    batch = loader.stage(words, 0)
    assert len(calls) == 1 and batch.keys == {("credit_card", "2024-01", "1")}
    loader.land(loader.claim(batch))
    got = sorted((r["source_file"], r["description"], r["amount"]) for r in sl.landed(spark, str(tmp_path), "transactions").collect())
    assert got == [("card_2024_1.pdf", "SHOP A", -5.0), ("card_2024_1.pdf", "SHOP B", 7.0)]
    # Without page 1 a file has the default type, and no rows of another type.
    noted = {r["source_file"]: (r["statement_type"], r["n_transactions"], r["state"]) for r in sl.manifest(spark, str(tmp_path)).collect()}
    assert noted == {"card_2024_1.pdf": ("credit_card", 2, "landed"), "card_2024_2.pdf": ("savings", 0, "no_transactions")}


def test_pages_hold_what_both_tables_need(spark):
    words = words_of(spark, card_words("c.pdf", 1, [(20.0, "03 JAN SHOP A 5.00")], 2023) + card_words("c.pdf", 2, [(20.0, "04 JAN SHOP B 6.00")])
                     + card_words(None, 1, [(20.0, "05 JAN SHOP N 1.00")], 2022))
    pages = st.parsed_pages(words)
    assert pages._jdf.queryExecution().sparkPlan().toString().count("ObjectHashAggregate") == 2  # one gathering, in two steps
    assert {(r["source_file"], r["page"], r["text"] is None, len(r["parsed"])) for r in pages.collect()} == {
        ("c.pdf", 1, False, 1), ("c.pdf", 2, True, 1), (None, 1, False, 1)}
    tx, facts = st.statement_tables(pages)
    assert sorted((r["source_file"], r["date"], r["amount"]) for r in tx.collect()) == [("c.pdf", "03 JAN 2023", -5.0), ("c.pdf", "04 JAN 2023", -6.0)]
    assert {(r["source_file"], r["statement_type"], r["year"]) for r in facts.collect()} == {("c.pdf", "credit_card", "2023"), (None, "credit_card", "2022")}
    both = st.parse_statements(words)
    assert [sorted(map(str, df.collect())) for df in both] == [sorted(map(str, df.collect())) for df in (tx, facts)]


def test_lines_are_cut_without_going_through_the_page_for_each(spark):
    rows = [("f", 1, f"w{i}", float(i % 3), 1.0, float(i // 3)) for i in range(60)]
    lines = st.page_lines(words_of(spark, rows[::-1]))
    assert "slice(" not in lines._jdf.queryExecution().optimizedPlan().toString()
    got = lines.select(F.inline("lines")).collect()
    assert [(r["top"], r["text"], len(r["words"])) for r in got] == [(float(i), f"w{3 * i} w{3 * i + 1} w{3 * i + 2}", 3) for i in range(20)]


def test_keys_are_sent_without_python_rows(spark, tmp_path):
    loader = sl.StatementLoader(spark, str(tmp_path), "a", AS_OF)
    keys = {("savings", f"20{i:02d}-01", str(i)) for i in range(30)}
    assert {tuple(r) for r in loader._frame(keys).collect()} == keys and loader._frame(keys).columns == list(sl.KEY)
    assert loader._frame(set()).collect() == [] and loader._frame(set()).schema == loader._frame(keys).schema
