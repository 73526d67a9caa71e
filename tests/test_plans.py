"""Physical-plan checks: no Python in SQL-expressible queries, no nested-loop or
cartesian joins, partial top-1 before the shuffle, pruned scans."""

import contextlib
import io

import pytest

from ledgerflow.plans import catalog

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
PYTHON_ALLOWED = {"classify_batches"}
SIDE_EFFECT = {"land_raw_roundtrip", "append_ods", "materialize", "file_arrival_stream", "read_holdings_csv", "stream_statements", "stream_balances",
               "sectioned_csv_files", "assign_batches_one_load", "model_graph", "quarantine_letters", "quarantine_replies", "refresh_switch",
               "positions_run", "positions_run_status", "pension_run"}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SIDE_EFFECT))
def test_plan_shape(spark, registry, name):
    qs, _ = registry
    p = plan_text(qs[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    if name not in PYTHON_ALLOWED:
        assert not any(n in p for n in PY_NODES), name


def test_dedup_limits_before_shuffle(spark, registry):
    p = plan_text(registry[0]["dwd_positions"](spark, "/root/testdata/sf0.001"))
    assert p.count("WindowGroupLimit") >= 2


def test_positions_scan_is_pruned(spark, registry):
    p = plan_text(registry[0]["dwd_positions"](spark, "/root/testdata/sf0.001"))
    schemas = [line for line in p.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert schemas and all("l_tax" not in s and "l_discount" not in s for s in schemas)


def test_month_end_rows_broadcasts_calendar_aggregate(spark, registry):
    p = plan_text(registry[0]["month_end_snapshot"](spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin LeftSemi" in p
