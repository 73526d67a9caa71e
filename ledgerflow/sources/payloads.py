"""Payload readers: exchange balance lists (JSON), broker sectioned CSV reports,
and bond holdings CSV snapshots.  All are Spark functions over text columns,
so many payloads (one per row) are parsed in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerflow.schemas import BALANCE_LIST, BOND_HOLDINGS

# The columns that mark a positions header in a broker report.
POSITION_HEADER = ("CurrencyPrimary", "AssetClass", "Symbol", "Quantity", "MarkPrice")


def explode_balances(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """JSON array of {currency, amount, available} -> one row per balance.

    A missing amount counts as 0; the amount stays text until the caller's
    quantity filter decides how strictly to parse it.
    """
    items = df.select(*keep, F.explode(F.from_json(F.col(payload), BALANCE_LIST)).alias("b"))
    return items.select(
        *keep,
        F.col("b.currency").alias("currency"),
        F.coalesce(F.col("b.amount"), F.lit("0")).alias("amount"),
    )


def read_sectioned_csv(lines: DataFrame, required: Sequence[str] = POSITION_HEADER, file_col: str = "file",
                       line_no: str = "line_no", text: str = "text", block_lines: int = 1 << 16) -> DataFrame:
    """Records of a multi-section CSV text.

    Input: one row per line with an explicit (file, line number) order.  A line
    that contains every ``required`` column name becomes the current header;
    later lines with as many cells as that header are records (a map from
    header name to cell; duplicate names keep the last cell).  Cells are split
    on ',' and stripped of spaces and double quotes (no quoted commas).
    Returns (file, line_no, record map).
    """
    cells = F.transform(F.split(F.col(text), ","), lambda c: F.regexp_replace(F.trim(c), '^"+|"+$', ""))
    req = F.array(*[F.lit(r) for r in required])
    t = lines.select(file_col, line_no, cells.alias("cells"), (F.col(line_no) / block_lines).cast("long").alias("__block"))
    t = t.withColumn("is_header", F.size(F.array_except(req, F.col("cells"))) == 0)
    hdr = F.when(F.col("is_header"), F.col("cells"))
    # Header carry in two levels so no window spans a whole file: the last
    # header of every block (one row per block), carried into later blocks
    # along the small per-block series, then within each bounded block.
    blocks = t.groupBy(file_col, "__block").agg(F.max_by(hdr, F.when(F.col("is_header"), F.col(line_no))).alias("__last"))
    wb = Window.partitionBy(file_col).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carry_in = blocks.select(file_col, "__block", F.last("__last", ignorenulls=True).over(wb).alias("__in"))
    w = Window.partitionBy(file_col, "__block").orderBy(line_no).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("__own", F.last(hdr, ignorenulls=True).over(w)).join(carry_in, [file_col, "__block"], "left")
    t = t.withColumn("header", F.coalesce("__own", "__in"))
    rec = t.filter(~F.col("is_header") & F.col("header").isNotNull() & (F.size("cells") == F.size("header")))
    # a repeated header name keeps its last cell: distinct names, each looked
    # up at its last position
    rev = F.reverse(F.col("header"))
    names = F.array_distinct(rev)
    values = F.transform(names, lambda k: F.try_element_at(F.col("cells"), (F.size("header") + 1 - F.array_position(rev, k)).cast("int")))
    return rec.select(file_col, line_no, F.map_from_arrays(names, values).alias("record"))


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """Report files -> (file, line_no, text), line numbers from 0, however many splits a file is read in.

    The text source gives the lines of a split in file order, and each line to
    one split.  So a line's number is its place among the lines of its split
    plus the number of lines in earlier splits of the file: one row per split,
    added up along the file.  No file is read as one value or by one task, and
    the lines themselves are not sorted or shuffled.
    """
    split = F.col("_metadata.file_block_start")
    # The id counts a task's rows in the order read: whole splits, one after the other.
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), split.alias("__split"), F.monotonically_increasing_id().alias("__row"),
        F.regexp_replace("value", "\r$", "").alias("text"))
    per = lines.groupBy("file", "__split").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("file", "__split", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    return lines.join(starts, ["file", "__split"]).select("file", (F.col("__row") + F.col("__shift")).alias("line_no"), "text")


def sectioned_csv_files(spark: SparkSession, path: str, required: Sequence[str] = POSITION_HEADER, **options) -> DataFrame:
    """Records of all sectioned report files under ``path``: (file, line_no, record), sections running on across splits."""
    return read_sectioned_csv(read_report_lines(spark, path), required, **options)


def read_holdings_csv(spark: SparkSession, path: str, as_of=None) -> DataFrame:
    """Bond holdings snapshot CSV with an explicit schema; ``as_of`` fills a missing date."""
    df = spark.read.schema(BOND_HOLDINGS).option("header", True).option("mode", "FAILFAST").csv(path)
    if as_of is not None:
        df = df.withColumn("date", F.coalesce(F.col("date"), F.lit(as_of).cast("date")))
    return df
