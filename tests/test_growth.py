"""Steps whose cost must not grow faster than their rows: replies are parsed once, sources do not deal positions, batches are labelled once."""

import datetime as dt

import pandas as pd

from ledgerflow.operators import fx, labels


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_reply_is_parsed_once(spark):
    df = spark.createDataFrame([
        ("a", 0, '[{"index":0,"category":"x"},{"index":1,"category":"y"},{"index":0,"category":"z"}]'),
        ("a", 1, '```json\n[{"index":3,"category":"w"}]\n```'), ("a", 2, "[]")], "source_file string, batch int, reply string")
    parsed = labels.parse_reply(df)
    assert rows_of(parsed) == [("a", 0, 0, "z"), ("a", 0, 1, "y"), ("a", 1, 43, "w")]
    project = [line for line in parsed._jdf.queryExecution().optimizedPlan().toString().splitlines() if "lambda" in line]
    assert project and not any("from_json" in line and "slice" in line for line in project)  # not again for each item
    odd = spark.createDataFrame([("a", 0, '[{"index":1,"category":null},{"category":"v"}]'), ("a", 1, "no"), ("a", 2, None)], df.schema)
    assert rows_of(labels.parse_reply(odd, strict=False)) == [("a", 0, None, "v")]


def test_positions_are_not_dealt_by_source(spark):
    schema = "source string, symbol string, date date, etl_time timestamp_ntz, quantity double"
    at = dt.datetime(2024, 1, 2, 22)
    live = spark.createDataFrame([("x", "A", at.date(), at, 1.0), ("y", "B", at.date(), at, 2.0)], schema)
    old = at - dt.timedelta(days=1)
    stored = spark.createDataFrame([("y", "B", old.date(), old, 3.0), ("y", "C", old.date(), old, 4.0), ("x", "A", old.date(), old, 5.0),
                                    ("y", "D", old.date() - dt.timedelta(days=1), old, 6.0)], schema)
    outcome = spark.createDataFrame([("x", True), ("y", False)], "source string, ok boolean")
    out = fx.positions_with_fallback(live, outcome, stored)
    assert [(r[0], r[1], r[4]) for r in rows_of(out)] == [("x", "A", 1.0), ("y", "B", 3.0), ("y", "C", 4.0)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 4


def test_a_chunk_is_labelled_batch_by_batch():
    seen = []

    def fn(pdf):
        seen.append(pdf["batch_index"].tolist())
        return pd.Series([f"{b}{i}" for b, i in zip(pdf["batch"], pdf["batch_index"], strict=True)], index=pdf.index)

    pdf = pd.DataFrame({"source_file": ["a", "a", "a", None, "b"], "batch": [0, 0, 1, 1, 1], "batch_index": [0, 1, 0, 0, 0]}, index=[9, 8, 7, 6, 5])
    got = labels._label_groups(pdf, ["source_file", "batch"], fn, "category")
    assert seen == [[0, 1], [0], [0]] and got["category"].tolist() == ["00", "01", "10", "10"]
    assert labels._label_groups(pdf[pdf["source_file"].isna()], ["source_file", "batch"], fn, "category")["category"].tolist() == []
