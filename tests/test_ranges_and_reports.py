"""Range-binned interval join and the whole daily message, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import report, timeline

D0 = dt.date(2020, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(4)
    left = [(i, "hot" if i % 3 else rng.choice(["a", "b", None]), None if i % 50 == 7 else day(rng.randrange(900))) for i in range(600)]
    ranges = []
    for owner in ("hot", "a", "c"):
        cuts = sorted(rng.sample(range(100, 900), 25))
        ranges += [(owner, day(x), day(y), j) for j, (x, y) in enumerate(zip(cuts, [*cuts[1:], None])) if y is not None]
        ranges.append((owner, day(cuts[-1]), dt.date(9999, 12, 31), 99))
    ranges += [("hot", day(200), day(420), 1000), ("hot", day(300), day(300), 1001), ("hot", day(500), day(400), 1002), ("a", None, day(9), 1003)]
    return (left, ranges, spark.createDataFrame(left, "id int, owner string, d date").repartition(4),
            spark.createDataFrame(ranges, "owner string, lo date, hi date, r int"))


def expected(left, ranges, keyed, outer=True):
    out = []
    for i, owner, d in left:
        hits = [r for o, lo, hi, r in ranges if d is not None and lo is not None and lo <= d < hi and (not keyed or o == owner)]
        out += [(i, r) for r in hits] or ([(i, None)] if outer else [])
    return sorted(out, key=str)


@pytest.mark.parametrize("bin_days", [1, 7, 32, 400])
def test_interval_join_equals_every_pair_checked(sides, bin_days):
    left, ranges, l, r = sides
    for keys in ((), ("owner",)):
        rr = r if keys else r.drop("owner")
        for how in ("left", "inner"):
            got = timeline.interval_join(l, rr, "d", "lo", "hi", keys=keys, how=how, bin_days=bin_days)
            assert got.columns == ["id", "owner", "d", "lo", "hi", "r"]
            assert sorted(((x["id"], x["r"]) for x in got.collect()), key=str) == expected(left, ranges, bool(keys), how == "left")
        some = {i for i, x in expected(left, ranges, bool(keys)) if x is not None}
        semi = timeline.interval_join(l, rr, "d", "lo", "hi", keys=keys, how="left_semi", bin_days=bin_days)
        assert {x["id"] for x in semi.collect()} == some and semi.columns == ["id", "owner", "d"]
        anti = timeline.interval_join(l, rr, "d", "lo", "hi", keys=keys, how="left_anti", bin_days=bin_days)
        assert {x["id"] for x in anti.collect()} == {i for i, _, _ in left} - some


def test_interval_join_edges(sides, spark):
    left, ranges, l, r = sides
    assert timeline.interval_join(l.limit(0), r, "d", "lo", "hi", keys=["owner"]).count() == 0
    assert timeline.interval_join(l, r.limit(0), "d", "lo", "hi", keys=["owner"]).count() == len(left)
    stamped = l.select("id", "owner", (F.col("d").cast("timestamp_ntz") + F.expr("interval 23 hours")).alias("d"))
    got = timeline.interval_join(stamped, r, "d", "lo", "hi", keys=["owner"])
    assert sorted(((x["id"], x["r"]) for x in got.collect()), key=str) == expected(left, ranges, True)  # a day's last hour is in the day


def test_interval_join_has_no_nested_loop(sides):
    for keys in ((), ("owner",)):
        plan = timeline.interval_join(sides[2], sides[3] if keys else sides[3].drop("owner"), "d", "lo", "hi", keys=keys)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_daily_message(spark):
    days = spark.createDataFrame([(day(i),) for i in range(5)], "run_date date")
    status = spark.createDataFrame([
        (day(0), "b", "live", 3), (day(0), "a", "live", None), (day(0), "fx", "live", None), (day(1), "a", "fallback", 0),
        (day(2), "fx", "failed", None), (day(4), "a", "odd", 1)], "run_date date, source string, status string, row_count long")
    fresh = spark.createDataFrame(
        [(day(i), t, True, "06:31", None) for i in (0, 1, 2, 3) for t in ("y", "x")] + [(day(4), "x", False, None, 27)],
        "run_date date, table string, fresh boolean, updated_local string, age_hours long")
    got = {r["run_date"]: (r["verdict"], r["message"].split("\n")) for r in report.report_message(days, status, fresh, labels={"x": "Monthly"}).collect()}
    assert [got[day(i)][0] for i in range(5)] == ["clear", "warn", "action", "unknown", "action"]
    assert got[day(0)][1] == [
        "📊 <b>Daily Report</b> — Wed 01 Jan 2020", "", "<b>Investment Positions</b>", "✅ A (live)", "✅ B — 3 positions (live)", "✅ FX Rates (live)",
        "", "<b>dbt Build &amp; Dashboard</b>", "✅ Monthly — updated 06:31 SGT", "✅ y — updated 06:31 SGT", "", "──────────────────────",
        "✅ All clear — dashboard is up to date"]
    assert got[day(2)][1][3:5] == ["❓ No status recorded — pipeline may not have run", "❌ FX Rates (failed)"]
    assert got[day(3)][1][3:5] == ["❓ No status recorded — pipeline may not have run", ""]
    assert got[day(4)][1][3:8] == ["❓ A — 1 positions (odd)", "", "<b>dbt Build &amp; Dashboard</b>", "❌ Monthly — stale (27h old)", ""]
    neither = report.report_message(days, status.limit(0), fresh.limit(0)).filter(F.col("run_date") == day(0)).first()
    assert neither["verdict"] == "action" and "❓ Could not check table freshness" in neither["message"]
