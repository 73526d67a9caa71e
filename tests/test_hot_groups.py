"""Forms that cut a group with a large share of all rows equal the plain windows; report files are read in splits."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import labels, timeline
from ledgerflow.operators.numbering import row_rank
from ledgerflow.sources import payloads


@pytest.fixture(scope="module")
def owned(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        owner = "hot" if i % 3 else rng.choice(["a", "b", None])
        rows.append((i, owner, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(400)),
                     rng.choice([None, None, round(rng.uniform(-50, 50), 2)]), rng.choice([None, "x", "y"])))
    return spark.createDataFrame(rows, "k int, owner string, d date, v double, t string").repartition(7)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("keys", [("owner",), ()])
def test_two_level_carry_and_sum_equal_the_window(owned, keys):
    order = ["d", "k"]
    for bucket in (F.trunc("d", "MM"), F.col("d"), F.lit(1)):
        plain = timeline.fill_forward(owned, ["v", "t"], order, keys)
        assert rows_of(timeline.fill_forward(owned, ["v", "t"], order, keys, bucket=bucket)) == rows_of(plain)
        for out in (None, "total"):
            plain = timeline.running_total(owned, "v", order, keys, out=out)
            got = timeline.running_total(owned, "v", order, keys, out=out, bucket=bucket)
            assert got.columns == plain.columns and rows_of(got) == rows_of(plain)
    none = owned.limit(0)
    assert timeline.fill_forward(none, ["v"], order, keys, bucket=F.col("d")).count() == 0
    assert timeline.running_total(none, "v", order, keys, bucket=F.col("d")).count() == 0


def test_no_window_holds_a_whole_owner(owned):
    for df in (timeline.fill_forward(owned, ["v"], ["d", "k"], ["owner"], bucket=F.trunc("d", "MM")),
               timeline.running_total(owned, "v", ["d", "k"], ["owner"], bucket=F.trunc("d", "MM"))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        over_rows = [line for line in plan.splitlines() if "Window" in line and ("last(v" in line or "sum(" in line) and "__bucket" in line]
        assert any(", [owner" in line and "__bucket" in line.split("], [owner", 1)[-1].split("]", 1)[0] for line in over_rows)


def test_rank_of_a_group_loaded_at_one_time(owned, spark):
    rows = owned.unionByName(owned.filter("k < 30"))  # equal rows share their positions
    w = Window.partitionBy("owner").orderBy("t", "d", "k", "v")
    want = rows.withColumn("row_index", (F.row_number().over(w) - 1).cast("long"))
    got = row_rank(rows, ["owner"], ["t", "d"], pieces=16)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert row_rank(rows.limit(0), ["owner"], ["t"]).count() == 0
    assert rows_of(row_rank(rows.drop("owner"), [], ["t", "d"], pieces=5).select("row_index")) == sorted(((i,) for i in range(1530)), key=str)


def test_a_hot_group_is_cut(spark, owned, monkeypatch):
    from ledgerflow.operators import numbering

    where = []
    real = numbering.scratch_path
    monkeypatch.setattr(numbering, "scratch_path", lambda s, n: where.append(real(s, n)) or where[-1])
    row_rank(owned, ["owner"], ["t", "d"], pieces=16).count()
    per = {r["__range"]: r["count"] for r in spark.read.parquet(where[0]).filter("owner = 'hot'").groupBy("__range").count().collect()}
    assert len(per) >= 8 and max(per.values()) < 300


def test_batches_of_a_statement_loaded_at_one_time(owned):
    df = owned.select(F.lit("s").alias("source_file"), F.lit(dt.datetime(2024, 1, 1)).alias("etl_time"), F.col("k").cast("string").alias("description"))
    pick = lambda x: rows_of(x.select("description", "batch", "batch_index"))
    assert pick(labels.assign_batches(df, strategy="ranked")) == pick(labels.assign_batches(df, skew_safe=False))


HEADER = '"A","CurrencyPrimary","AssetClass","Symbol","Quantity","MarkPrice"'


def test_report_lines_are_numbered_across_splits(spark, tmp_path):
    rng = random.Random(1)
    texts = {}
    for name, n in (("a.csv", 4000), ("b.csv", 1), ("c.csv", 700), ("empty.csv", 0)):
        lines = [f"{name} {i} " + "x" * rng.randrange(120) if rng.random() > 0.05 else "" for i in range(n)]
        texts[name] = lines
        (tmp_path / name).write_bytes(b"".join(line.encode() + (b"\r\n" if i % 2 else b"\n") for i, line in enumerate(lines)))
    (tmp_path / "noend.csv").write_text("one\ntwo")
    texts["noend.csv"] = ["one", "two"]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        df = payloads.read_report_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30
        got = {}
        for r in df.collect():
            got.setdefault(r["file"].rsplit("/", 1)[1], {})[r["line_no"]] = r["text"]
        assert {f: [x[i] for i in range(len(x))] for f, x in got.items()} == {f: x for f, x in texts.items() if x}
        # A section's header in one split holds for records many splits later; a new header ends it.
        rows = [HEADER, *[f'"U","SGD","STK","S{i}",{i},1.5' for i in range(900)], "Trades,x", HEADER + ',"More"', "a,b", '"U","USD","OPT","T",1,2,3']
        (tmp_path / "s").mkdir()
        (tmp_path / "s" / "sections.csv").write_text("\n".join(rows))
        recs = {r["line_no"]: r["record"] for r in payloads.sectioned_csv_files(spark, str(tmp_path / "s"), block_lines=64).collect()}
        assert sorted(recs) == [*range(1, 901), 904] and recs[777]["Symbol"] == "S776" and recs[904]["More"] == "3"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
