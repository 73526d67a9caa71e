"""Row numbering within a key that stays balanced when one key is huge.

``row_number() over (partition by key order by ...)`` runs each key in one
task.  ``row_index`` splits each key into pieces by a ``bucket`` expression
that is monotone in the order (for example the day of a timestamp that leads
the order): rows are numbered inside each (key, bucket) piece, and the count
of the key's rows in earlier buckets (a prefix sum over one row per piece) is
added.  Pieces are defined by values, not by physical partitions, so every
evaluation of the plan agrees.  The result equals the window's
``row_number() - 1``.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], bucket: Column,
              out: str = "row_index") -> DataFrame:
    """0-based position of each row within its ``keys`` group in ``order``.

    ``bucket`` must be non-decreasing along ``order`` within a key.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    b = "__bucket"
    with_b = df.withColumn(b, bucket)
    local = Window.partitionBy(*keys, b).orderBy(*order_cols)
    numbered = with_b.withColumn("__local", F.row_number().over(local) - 1)
    sizes = with_b.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, b, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (numbered.join(offsets, [*keys, b])
            .withColumn(out, (F.col("__off") + F.col("__local")).cast("long"))
            .drop(b, "__local", "__off"))


def row_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "row_index",
             pieces: int | None = None) -> DataFrame:
    """0-based position of each row within its ``keys`` group, whatever share of the rows one group has.

    All rows are dealt by ranges of the *whole* order (keys, then ``order``,
    then every other column, so that no two different rows are equal), whose
    bounds Spark samples; a group that is too large for one range is cut where
    its rows are.  The sorted ranges are written once, each row with its place.
    A row's position is its place among the group's rows in its range plus the
    number of the group's rows in earlier ranges: a count per (group, range),
    added up along the group.  The ranges are written because a second
    evaluation would sample other bounds.  Rows that are equal in every column
    share their positions among them.  Equals ``row_number() - 1``.
    """
    spark = df.sparkSession
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    whole = [*[F.col(k).asc() for k in keys], *order_cols, *[F.col(c) for c in df.columns if c not in keys]]
    dealt = df.repartitionByRange(pieces, *whole) if pieces else df.repartitionByRange(*whole)
    path = scratch_path(spark, f"ranked-{uuid4().hex}")
    (dealt.sortWithinPartitions(*whole)
     .withColumn("__range", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id())
     .write.parquet(path))
    rows = spark.read.parquet(path)
    per = rows.groupBy(*keys, "__range").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shift = per.select(*keys, "__range", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    same = F.col("__a.__range") == F.col("__b.__range")
    for k in keys:  # a NULL key is a group too
        same = same & F.col(f"__a.{k}").eqNullSafe(F.col(f"__b.{k}"))
    return rows.alias("__a").join(shift.alias("__b"), same).select(
        *[F.col(f"__a.{c}") for c in df.columns], (F.col("__a.__row") + F.col("__b.__shift")).cast("long").alias(out))
