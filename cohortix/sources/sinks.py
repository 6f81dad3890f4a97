"""Sinks: tables, findings reports and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINDING_SCHEMA = T.StructType(
    [
        T.StructField("step", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("severity", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def sink_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
               fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table; ``partition_by=["split"]`` writes train/test as folders."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def sink_report(findings: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Ordered findings ``(step, seq, severity, subject, message, value)``."""
    out = findings.select([F.col(f.name).cast(f.dataType) for f in FINDING_SCHEMA.fields])
    out = out.orderBy("step", "seq")
    if fmt == "text":
        out.select(
            F.concat_ws(" | ", "step", "severity", "subject", "message",
                        F.coalesce(F.col("value").cast("string"), F.lit(""))).alias("value")
        ).write.mode("overwrite").text(path)
    else:
        out.write.mode("overwrite").format(fmt).save(path)


def sink_model(model, path: str) -> None:
    """Persist a fitted ``pyspark.ml`` model or pipeline."""
    model.write().overwrite().save(path)
