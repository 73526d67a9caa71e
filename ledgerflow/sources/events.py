"""Object-arrival events: classify each event and derive object paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import base_name, object_path

__all__ = ["route_events", "object_path", "base_name"]


def route_events(df: DataFrame, body: str = "body", prefix: str | None = "inbox/", suffix: str = ".pdf") -> DataFrame:
    """Classify arrival events (JSON envelopes, the object under ``$.data`` or at the root).

    action: 'error' when bucket or name is missing/empty; 'skipped' when the
    name is outside ``prefix`` (if given) or does not end with ``suffix``
    (case-insensitive); else 'process' with ``file`` = the base name.
    """
    data = F.coalesce(F.get_json_object(F.col(body), "$.data"), F.col(body))
    bucket = F.coalesce(F.get_json_object(data, "$.bucket"), F.lit(""))
    name = F.coalesce(F.get_json_object(data, "$.name"), F.lit(""))
    out = df.withColumn("bucket", bucket).withColumn("name", name)
    missing = (F.col("bucket") == "") | (F.col("name") == "")
    outside: Column = ~F.col("name").startswith(prefix) if prefix else F.lit(False)
    not_suffix = ~F.lower(F.col("name")).endswith(suffix.lower())
    action = F.when(missing, F.lit("error")).when(outside | not_suffix, F.lit("skipped")).otherwise(F.lit("process"))
    reason = (F.when(missing, F.lit("missing bucket or name"))
              .when(outside, F.concat(F.col("name"), F.lit(f" is not in {prefix}")))
              .when(not_suffix, F.concat(F.col("name"), F.lit(" is not a PDF"))))
    return out.withColumn("action", action).withColumn("reason", reason).withColumn(
        "file", F.when(action == "process", base_name(F.col("name"))))
