"""Reading, landing and appending tables with fixed schemas; idempotent loads.

Writes go to paths or catalog tables named by the caller (a shared
filesystem or object store on a cluster); nothing is staged on a
machine-local folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path_or_name: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """A raw-layer table: a catalog name or a path, projected to ``schema`` (never inferred)."""
    if "/" not in path_or_name and spark.catalog.tableExists(path_or_name):
        df = spark.table(path_or_name)
    else:
        reader = spark.read.format(fmt)
        if schema is not None and fmt != "parquet":
            reader = reader.schema(schema)
        df = reader.load(path_or_name)
    return conform(df, schema) if schema is not None else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to exactly ``schema`` (missing columns -> NULL; extra columns dropped)."""
    cols = []
    have = set(df.columns)
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_ods(df: DataFrame, target: str, schema: T.StructType, table: bool = False) -> None:
    """Append rows in the table's enforced schema (path, or catalog table when ``table``)."""
    out = conform(df, schema).write.mode("append")
    if table:
        out.saveAsTable(target)
    else:
        out.parquet(target)


def land_raw(df: DataFrame, path: str, parts: Sequence[str] = ("statement_type", "month")) -> None:
    """Land a raw batch as Parquet partitioned by ``parts``.

    Dynamic partition overwrite replaces only the partitions in the batch, so
    re-landing the same batch is idempotent and a retried task rewrites its
    own partition instead of duplicating it.  ``parts`` must name all that one
    batch holds whole: with the type among them, a card batch leaves the
    savings of the same month alone.
    """
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*parts) if parts else w).parquet(path)


def materialize(df: DataFrame, layer: str, name: str, path: str | None = None) -> str:
    """Full refresh of ``layer.name`` (database = layer, table name used verbatim)."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    full = f"`{layer}`.`{name}`"
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(f"{layer}.{name}")
    return full


def refresh(df: DataFrame, layer: str, name: str, path: str) -> str:
    """Full refresh of ``layer.name`` that readers never see half done.

    The rows are written to a new folder below ``path``; only then the name is
    switched to it, in one step of the catalog.  A reader that began before
    goes on with the old folder, one that begins later gets the new one, with
    its columns, should they have changed; a refresh that fails leaves the old
    rows.  The name is a view over the newest folder.  Older folders stay until
    :func:`drop_versions`.  Returns the new folder.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    newest = max((n for n, _ in versions(spark, path)), default=0) + 1
    folder = f"{path.rstrip('/')}/v{newest:08d}-{uuid4().hex[:8]}"
    df.write.parquet(folder)
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS SELECT * FROM parquet.`{folder}`")
    return folder


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the versions below ``path``, the oldest first."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted((int(n[1:9]), f"{path.rstrip('/')}/{n}") for n in names if n.startswith("v") and n[1:9].isdigit())


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all versions but the newest ``keep`` (at least one); call it when no reader of older ones is left."""
    old = [folder for _, folder in versions(spark, path)[: -max(1, keep)]]
    for folder in old:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return old


def split_rejects(checked: DataFrame, path: str, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with their reason) of rows that carry a ``reason`` (NULL: good), evaluated once.

    The rows are written below ``path`` by outcome, so each of the two reads
    only its own files; together they are all rows.
    """
    spark = checked.sparkSession
    checked.withColumn("__rejected", F.col(reason).isNotNull()).write.mode("overwrite").partitionBy("__rejected").parquet(path)
    rows = spark.read.schema(T.StructType([*checked.schema.fields, T.StructField("__rejected", T.BooleanType())])).parquet(path)
    return rows.filter(~F.col("__rejected")).drop("__rejected", reason), rows.filter("__rejected").drop("__rejected")


def skip_landed(new: DataFrame, landed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose landing key is not already landed (anti join)."""
    return new.join(landed.select(*on).distinct(), on=list(on), how="left_anti")


def skip_loaded(new: DataFrame, existing: DataFrame, on: Sequence[str] = ("statement_date",)) -> DataFrame:
    """Rows of ``new`` whose key has no row in ``existing`` (count > 0 check as an anti join)."""
    return new.join(existing.select(*on), on=list(on), how="left_anti")


def table_freshness(tables: Mapping[str, DataFrame], ts: str = "etl_time") -> DataFrame:
    """(table, last_modified) = max(ts) per table, one partial+final aggregate each."""
    parts = [df.agg(F.max(ts).alias("last_modified")).select(F.lit(name).alias("table"), "last_modified")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def file_freshness(df: DataFrame, name: str) -> DataFrame:
    """Freshness of a file-backed table from its files' modification times."""
    return df.select("_metadata.file_modification_time").agg(
        F.max("file_modification_time").alias("last_modified")).select(F.lit(name).alias("table"), "last_modified")


def listed_freshness(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table, last_modified as UTC wall-clock) of file-backed tables by the file listing alone: no row and no footer is read.

    A table without files has no time.
    """
    parts = []
    for name, path in tables.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("modificationTime")
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.max("modificationTime").cast("timestamp_ntz"))
        parts.append(files.agg(utc.alias("last_modified")).select(F.lit(name).alias("table"), "last_modified"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stamp(df: DataFrame, as_of, tz: str = "Asia/Singapore", ts_col: str = "etl_time", date_col: str = "date",
          utc_date_col: str | None = "landing_date") -> DataFrame:
    """Load time stamp (UTC wall-clock), the local calendar date of it in ``tz``,
    and (optionally) the UTC date used for the landing partition (the two
    differ near midnight).  Independent of the session time zone."""
    t = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), t)
    out = df.withColumn(ts_col, t).withColumn(date_col, F.to_date(local))
    if utc_date_col:
        out = out.withColumn(utc_date_col, F.to_date(t))
    return out
