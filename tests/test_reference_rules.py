"""Rules that the generated views never exercise, as golden rows."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import fx, labels, statements
from ledgerflow.sources import tables


def test_conversion_rounds_once(spark):
    """A coin value of many decimals is not rounded before it is multiplied."""
    df = spark.createDataFrame([("USD", 10.004999), ("USD", 0.005), ("XXX", 1.005001)], "currency string, market_value double")
    rates = spark.createDataFrame([("USD", 1.35)], "currency string, fx_rate_to_base double")
    got = [r["market_value_sgd"] for r in fx.convert_to_base(df, rates).orderBy(F.desc("market_value")).collect()]
    assert got == [round(10.004999 * 1.35, 2), 1.01, 0.01]  # 13.51; with cents first it would be 13.5


def test_repeated_reply_index_keeps_the_last_category(spark):
    reply = '[{"index": 0, "category": "Dining"}, {"index": 1, "category": "Other"}, {"index": 0, "category": "Travel"}]'
    df = spark.createDataFrame([("f", 1, reply)], "source_file string, batch int, reply string")
    got = {(r["row_index"], r["category"]) for r in labels.parse_reply(df).collect()}
    assert got == {(40, "Travel"), (41, "Other")}


def test_batches_number_ties_alike(spark):
    rows = [("f", "2024-01-01 00:00:00", "SHOP", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "source_file string, etl_time string, description string, amount double").withColumn(
        "etl_time", F.col("etl_time").cast("timestamp_ntz"))
    one = labels.assign_batches(df.repartition(7)).select("amount", "row_index").collect()
    two = labels.assign_batches(df.repartition(3, "amount")).select("amount", "row_index").collect()
    assert sorted(one) == sorted(two) == [(float(i), i) for i in range(50)]


def test_keyword_case_equals_the_batch_classifier(spark):
    rows = [("f", i, 0, i, d) for i, d in enumerate(["acme salary", "PAYNOW x", "uob kay hian", None, "", "shop SALARY", "zzz"])]
    df = spark.createDataFrame(rows, "source_file string, row_index int, batch int, batch_index int, description string")
    one = {r["row_index"]: r["category"] for r in labels.classify_keywords(df).collect()}
    two = {r["row_index"]: r["category"] for r in labels.classify(df).collect()}
    assert one == two


def _page(file, page, header_shift=0.0):
    head = [("Withdrawals", 300.0, 360.0, 80.0), ("Deposits", 400.0, 450.0, 80.0 + header_shift), ("Balance", 500.0, 540.0, 80.0)]
    row = [("01", 20.0, 30.0, 100.0), ("Jan", 32.0, 50.0, 100.0), ("Shop", 150.0, 190.0, 100.0), ("12.00", 320.0, 350.0, 100.0), ("88.00", 505.0, 535.0, 100.0)]
    return [(file, page, t, x0, x1, top) for t, x0, x1, top in head + row]


WORDS = "source_file string, page int, text string, x0 double, x1 double, top double"


def test_header_words_of_one_line_keep_their_order(spark):
    """'Deposits' a little higher than its line still follows 'Withdrawals'."""
    got = statements.column_centres(spark.createDataFrame(_page("a.pdf", 1, -0.02), WORDS)).collect()
    assert [(r["withdrawal"], r["deposit"], r["balance"]) for r in got] == [(330.0, 425.0, 520.0)]


def test_file_without_words_on_page_one_uses_the_default_year(spark):
    tx, facts = statements.parse_statements(spark.createDataFrame(_page("a.pdf", 2), WORDS))
    assert [(r["statement_type"], r["year"]) for r in facts.collect()] == [("savings", statements.SAVINGS_DEFAULT_YEAR)]
    assert [(r["date"], r["amount"]) for r in tx.collect()] == [(f"01 Jan {statements.SAVINGS_DEFAULT_YEAR}", -12.0)]


def test_landing_one_type_leaves_the_other_alone(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [(1, "savings", "2024-01"), (2, "credit_card", "2024-01"), (3, "credit_card", "2024-02")]
    df = spark.createDataFrame(rows, "id int, statement_type string, month string")
    for kind in ("savings", "credit_card", "credit_card"):
        tables.land_raw(df.where(F.col("statement_type") == kind), path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "static"


LETTER = "Ordinary Account $1,000.00\nSpecial Account $200.00\nMediSave Account $30.00"


def test_letter_without_a_date(spark):
    df = spark.createDataFrame([("a.pdf", LETTER), ("b.pdf", LETTER + "\nas at 31 Dec 2024")], "source_file string, text string")
    got = {r["source_file"]: r for r in statements.labelled_balances(df, on_missing="null").collect()}
    assert got["a.pdf"]["statement_date"] is None and got["a.pdf"]["total"] == 1230.0
    assert str(got["b.pdf"]["statement_date"]) == "2024-12-31"
    with pytest.raises(Exception, match="as at"):
        statements.labelled_balances(df).collect()


SIDE_EFFECT = {"land_raw_roundtrip", "append_ods", "materialize", "file_arrival_stream", "read_holdings_csv", "stream_statements", "stream_balances",
               "sectioned_csv_files", "assign_batches_one_load", "model_graph", "quarantine_letters", "quarantine_replies", "refresh_switch",
               "positions_run", "positions_run_status", "pension_run"}


def test_building_a_query_runs_no_job(spark, registry):
    from ledgerflow.plans import catalog

    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, "plans only")
    try:
        for name, build in catalog.queries().items():
            if name not in SIDE_EFFECT:
                build(spark, "/root/testdata/sf0.001")
                own = [j for j in tracker.getJobIdsForGroup(group)]
                # Reading a Parquet footer for the schema is the only job allowed, of one task.
                assert all(sum(tracker.getStageInfo(s).numTasks for s in (tracker.getJobInfo(j).stageIds if tracker.getJobInfo(j) else []) if tracker.getStageInfo(s)) <= 1 for j in own), name
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_checkpoint_folder_of_its_own_on_a_cluster(monkeypatch, spark):
    from ledgerflow import session

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
