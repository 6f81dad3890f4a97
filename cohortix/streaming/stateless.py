"""Structured Streaming for the row-wise operators.

The cleaning rules (NULL-out, winsorize), engineered features, text
normalisation and threshold scoring with a fitted pipeline are all stateless
projections, so the same functions run unchanged on a streaming DataFrame.
Fitted statistics (medians, scaler, model) are fitted once on a batch table
and applied as constants to every micro-batch. The sink is an exactly-once
file sink with its checkpoint in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortix.sources.scan import nan_to_null

Step = Callable[[DataFrame], DataFrame]


def read_stream(spark: SparkSession, directory: str, schema: T.StructType,
                glob: str | None = None, max_files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    """Files arriving in ``directory`` as a stream (schema given, never inferred).

    ``directory`` may be a table: a folder of part files or one file. ``glob``
    matches file names, so it does not select a folder.
    """
    r = spark.readStream.schema(schema).format(fmt)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path) and fs.getFileStatus(path).isFile():  # a stream reads folders
        directory, glob = path.getParent().toString(), path.getName()
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    return nan_to_null(r.load(directory))


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Chain stateless steps; works for batch and streaming frames alike."""
    for step in steps:
        df = step(df)
    return df


def write_stream(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = True, partition_by: Sequence[str] = ()):
    """Append to a file sink; ``available_now`` drains what is there and stops.

    The drain has no time limit: it returns when all input is written, and
    raises if the stream ended with an error.
    """
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start(out_path)
    if available_now:
        q.awaitTermination()  # raises the stream's own error
        if q.isActive or q.exception() is not None:
            raise RuntimeError(f"the stream did not drain: {q.exception()}")
    return q


def score_step(model, features: Sequence[str], threshold: float, keep: Sequence[str]) -> Step:
    """A fitted ``PipelineModel`` as a stream step: adds ``score`` and ``pred``."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    def step(df: DataFrame) -> DataFrame:
        out = model.transform(df).select(*keep, vector_to_array("probability")[1].alias("score"))
        return out.withColumn("pred", (F.col("score") >= threshold).cast("int"))

    return step
