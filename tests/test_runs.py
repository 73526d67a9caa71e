"""Model graph, refresh by switching, rejects, freshness by listing, and whole positions and pension runs."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import labels, statements
from ledgerflow.plans import fixtures as fx
from ledgerflow.plans import models as m
from ledgerflow.plans import runner, runs
from ledgerflow.plans.q_models import AS_OF, bal_tb, pos_tb
from ledgerflow.sources import tables

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ model graph

@pytest.fixture(scope="module")
def inputs(spark):
    return {"tx": fx.tx(spark, SF, copy_category="Transfer"), "positions": fx.positions(spark, SF), "balances": fx.balances(spark, SF), "pension": fx.pension(spark, SF)}


def test_graph_equals_single_runs_and_reads_each_input_once(spark, inputs, tmp_path):
    ties = {"position_tiebreak": pos_tb(), "balance_tiebreak": bal_tb(), "pension_tiebreak": bal_tb()}
    nodes = runner.graph(as_of=AS_OF, **ties)
    built = runner.run_graph(spark, nodes, inputs, m.MODEL_NAMES, str(tmp_path))
    single = m.run_models(inputs, m.MODEL_NAMES, as_of=AS_OF, **ties)
    for name in m.MODEL_NAMES:
        assert built[name].columns == single[name].columns and rows_of(built[name]) == rows_of(single[name]), name
        assert all(str(tmp_path) in f for f in built[name].inputFiles())
    assert [sum(raw in node.needs for node in nodes.values()) for raw in inputs] == [1] * len(inputs)
    assert sorted(os.listdir(tmp_path)) == sorted(set(nodes) - runner.VIEWS)


def test_levels_run_what_is_needed_side_by_side(spark, tmp_path):
    meet = threading.Barrier(3, timeout=60)
    one = spark.range(1)

    def waits(x):
        meet.wait()
        return x

    nodes = {n: runner.Node(("raw",), waits) for n in "abc"} | {"d": runner.Node(("a", "b"), lambda a, b: a.unionByName(b)), "e": runner.Node(("d",), lambda d: d)}
    assert runner.levels(nodes, ["d"]) == [["a", "b"], ["d"]] and runner.levels(nodes, ["c", "e"]) == [["a", "b", "c"], ["d"], ["e"]]
    assert runner.run_graph(spark, nodes, {"raw": one}, ["e", "c"], str(tmp_path))["e"].count() == 2
    with pytest.raises(KeyError):
        runner.levels(nodes, ["nothing"])
    broken = {"x": runner.Node(("raw",), lambda r: 1 / 0), "y": runner.Node(("raw",), lambda r: r), "z": runner.Node(("x", "y"), lambda x, y: x)}
    with pytest.raises(RuntimeError, match="x"):
        runner.run_graph(spark, broken, {"raw": one}, ["z"], str(tmp_path / "broken"))
    assert os.listdir(tmp_path / "broken") == ["y"]  # the rest of the level is kept


# ------------------------------------------------------------------ refresh

def test_readers_see_one_version(spark, tmp_path):
    path, frame = str(tmp_path / "t"), lambda n: spark.range(n).selectExpr("id", "id * 2 AS x")
    tables.refresh(frame(3), "switch", "t", path)
    before = spark.table("switch.t")
    assert before.count() == 3
    tables.refresh(frame(5), "switch", "t", path)
    assert before.count() == 3 and spark.table("switch.t").count() == 5  # the reader that began before goes on
    bad = frame(9).withColumn("x", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        tables.refresh(bad, "switch", "t", path)
    assert spark.table("switch.t").count() == 5
    tables.refresh(spark.range(2).withColumn("more", F.lit("m")), "switch", "t", path)  # other columns
    assert spark.table("switch.t").columns == ["id", "more"]
    had = [folder for _, folder in tables.versions(spark, path)]
    gone = tables.drop_versions(spark, path, keep=1)
    assert gone == had[:-1] and [f for _, f in tables.versions(spark, path)] == had[-1:]
    assert spark.table("switch.t").count() == 2 and tables.versions(spark, str(tmp_path / "none")) == []


# ------------------------------------------------------------------ rejects

def test_letters_and_replies_are_kept_or_rejected_with_a_reason(spark, tmp_path):
    letter = "as at 7 Feb 2026\nOrdinary Account $1.00\nSPECIAL account $2,000.50\nMediSave Account $3.00"
    docs = spark.createDataFrame([
        ("ok", letter), ("none", None), ("empty", ""), ("nodate", letter.replace("as at", "on")), ("odd", letter.replace("7 Feb", "45 Foo")),
        ("two", letter.replace("$1.00", "1.00").replace("MediSave", "x"))], "source_file string, text string")
    checked = statements.checked_balances(docs)
    good, rejects = tables.split_rejects(checked, str(tmp_path / "l"))
    assert rows_of(good) == [("ok", dt.date(2026, 2, 7), 1.0, 2000.5, 3.0, 2004.5)]
    every = "missing statement_date, ordinary_account, special_account, medisave_account"
    got = {r["source_file"]: r["reason"] for r in rejects.collect()}
    assert {k: got.get(k) for k in ("nodate", "odd", "two", "empty")} == {
        "nodate": "missing statement_date", "odd": "missing statement_date", "two": "missing ordinary_account, medisave_account", "empty": every}
    replies = spark.createDataFrame([
        ("a", 0, '[{"index":0,"category":"Dining"}]'), ("a", 1, "```json\n[]\n```"), ("a", 2, "no"), ("a", 3, None), ("a", 4, '[{"index":1}]'), ("a", 5, '{"index":1}')],
        "source_file string, batch int, reply string")
    good, rejects = tables.split_rejects(labels.checked_replies(replies), str(tmp_path / "r"))
    assert {r["batch"] for r in good.collect()} == {0, 1}
    assert rows_of(labels.parse_reply(good)) == [("a", 0, 0, "Dining")]
    found = {r["batch"]: r["reason"] for r in rejects.collect()}
    assert set(found) == {2, 3, 4, 5} and found[2] == "not a JSON array" and found[3] == "no reply" and found[4] == "an item without index or category"
    none = tables.split_rejects(labels.checked_replies(replies.limit(0)), str(tmp_path / "n"))
    assert [x.count() for x in none] == [0, 0]


def test_freshness_by_listing(spark, tmp_path):
    for name, at in (("a", 1_700_000_000), ("b", 1_600_000_000)):
        spark.range(4).repartition(2).write.parquet(str(tmp_path / name))
        for root, _, files in os.walk(tmp_path / name):
            for i, f in enumerate(sorted(files)):
                os.utime(os.path.join(root, f), (at - i * 60, at - i * 60))
    (tmp_path / "none").mkdir()
    df = tables.listed_freshness(spark, {n: str(tmp_path / n) for n in ("a", "b", "none")})
    got = {r["table"]: r["last_modified"] for r in df.collect()}
    utc = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc).replace(tzinfo=None)
    # Hidden files and marks are no data: the newest time is one of the part files'.
    assert got["none"] is None and utc(1_700_000_000 - 600) <= got["a"] <= utc(1_700_000_000) and utc(1_600_000_000 - 600) <= got["b"] <= utc(1_600_000_000)
    plan = df._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1] and "Format: Parquet" not in plan


# ------------------------------------------------------------------ runs

POS = "source string, symbol string, asset_class string, quantity double, price double, market_value double, currency string"


def test_positions_run(spark, tmp_path):
    target = str(tmp_path)
    ok = lambda **k: spark.createDataFrame(list(k.items()), "source string, ok boolean")
    rates = spark.createDataFrame([("USD", 1.5), ("SGD", 1.0)], "currency string, fx_rate_to_base double")
    first = spark.createDataFrame([("x", "A", "stock", 1.0, 2.0, 2.0, "USD"), ("y", "B", "etf", 1.0, 4.0, 4.0, "SGD")], POS)
    day = lambda n: dt.datetime(2024, 1, n, 22)
    status = lambda: [tuple(r)[:1] + (r["source"], r["status"], r["row_count"]) for r in runs.stored(spark, target, runs.STATUS).orderBy("run_date", "source").collect()]
    runs.positions_run(spark, first.limit(0), ok(x=False, y=False), target, day(1))  # nothing live, nothing stored
    assert runs.stored(spark, target, runs.POSITIONS).count() == 0 and not os.path.exists(tmp_path / "raw_positions")
    assert status() == [(dt.date(2024, 1, 2), "fx", "failed", None), (dt.date(2024, 1, 2), "x", "fallback", 0), (dt.date(2024, 1, 2), "y", "fallback", 0)]
    runs.positions_run(spark, first, ok(x=True, y=True), target, day(2), rates)
    for _ in range(2):  # repeated
        runs.positions_run(spark, first.filter("source = 'y'"), ok(x=False, y=True), target, day(3))
    rows = {(r["date"].day, r["source"]): (r["fx_rate_to_sgd"], r["market_value_sgd"], r["etl_time"]) for r in runs.stored(spark, target, runs.POSITIONS).collect()}
    assert rows == {(3, "x"): (1.5, 3.0, day(2)), (3, "y"): (1.0, 4.0, day(2)), (4, "x"): (1.5, 3.0, day(3)), (4, "y"): (1.0, 4.0, day(3))}
    assert runs.stored(spark, target, runs.POSITIONS).count() == 4
    assert sorted(os.listdir(tmp_path / "raw_positions"))[-2:] == ["landing_date=2024-01-02", "landing_date=2024-01-03"]  # the UTC day
    assert status()[-3:] == [(dt.date(2024, 1, 4), "fx", "fallback", None), (dt.date(2024, 1, 4), "x", "fallback", 1), (dt.date(2024, 1, 4), "y", "live", 1)]


def test_pension_run(spark, tmp_path):
    target = str(tmp_path)
    text = lambda day: f"as at {day}\nOrdinary Account $1.00\nSpecial Account $2.00\nMediSave Account $3.00"
    letters = spark.createDataFrame([("b", text("1 Jan 2024")), ("a", text("1 Jan 2024")), ("c", text("5 Feb 2024")), ("bad", "x")], "source_file string, text string")
    rejects = runs.pension_run(spark, letters.filter("source_file <> 'a'"), target, dt.datetime(2024, 3, 1))
    assert [(r["source_file"], r["reason"][:7]) for r in rejects.collect()] == [("bad", "missing")]
    for _ in range(2):
        runs.pension_run(spark, letters.unionByName(spark.createDataFrame([("d", text("6 Feb 2024"))], letters.schema)), target, dt.datetime(2024, 3, 2))
    got = {r["source_file"]: (r["statement_date"], r["total_cpf"], r["etl_time"].day) for r in runs.stored(spark, target, runs.PENSION).collect()}
    assert got == {"b": (dt.date(2024, 1, 1), 6.0, 1), "c": (dt.date(2024, 2, 5), 6.0, 1), "d": (dt.date(2024, 2, 6), 6.0, 2)}
    assert runs.stored(spark, target, runs.PENSION).count() == 3
    raw = spark.read.parquet(f"{target}/raw_pension")
    assert {(r["month"], r["source_file"]) for r in raw.collect()} == {("2024-01", "b"), ("2024-02", "c"), ("2024-02", "d")} and raw.count() == 3
