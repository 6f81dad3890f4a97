"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortix.session import ensure_checkpoint_dir

#: What separates two words: a run of these six ASCII white-space characters.
WORD_GAP = "[ \\t-\\r]+"
#: The same for Python's ``re`` (the words themselves).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a non-null text, unchanged, in order."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def size_buckets(n: int, least: int = 512) -> int:
    """Number of buckets for ``n`` rows: about sqrt(n) rows in each, ``least`` at least.

    Both the rows of a bucket and the table of buckets then stay small
    against the data: 3e10 rows make 170,000 buckets of 170,000 rows.
    """
    return max(1, round(n / max(least, n ** 0.5)))


def unit_hash(*cols: Column) -> Column:
    """Hex digest that orders rows in a seeded, reproducible way."""
    return F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def hash_bucket(digest: Column, buckets: int) -> Column:
    """Bucket of a hex digest that keeps the digests' order: 0 to ``buckets`` - 1."""
    first = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(first * F.lit(int(buckets)) / F.lit(float(2 ** 32))).cast("bigint")


def running_sums(df: DataFrame, keys: list[str], bucket: str, order: list[Column],
                 sums: dict[str, str], totals: dict[str, str] | None = None,
                 per_key: DataFrame | None = None) -> DataFrame:
    """Add exclusive running sums within ``keys`` in the order (``bucket``, ``order``).

    No task sorts a whole key: rows are ranked inside (keys, bucket), and each
    bucket starts from the sum of the buckets before it, taken from the small
    table of bucket totals. ``sums`` maps the new column to the summed one,
    ``totals`` a new column to one that is summed over the whole key. The
    columns of ``per_key`` (one row per key) come along with the bucket
    starts, so that a hot key is not joined on the key alone.
    """
    totals = totals or {}
    every = {**sums, **totals}
    small = df.groupBy(*keys, bucket).agg(*[F.sum(v).alias(f"_t_{n}") for n, v in every.items()])
    key = Window.partitionBy(*(keys or [F.lit(0)]))
    before = key.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = small.select(
        *keys, bucket,
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_s_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(key).alias(n) for n in totals])
    more = list(totals)
    if per_key is not None:
        starts = starts.join(per_key, keys)
        more += [c for c in per_key.columns if c not in keys]
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, [*keys, bucket])
        .select(*df.columns, *more, *[
            (F.col(f"_s_{n}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).cast("bigint").alias(n)
            for n, v in sums.items()])
    )


def integer_ids(df: DataFrame, col: str) -> None:
    """Refuse ids that are no integers, where the operator's order is that of numbers."""
    t = df.schema[col].dataType
    if not isinstance(t, (T.IntegralType, T.NullType)):
        raise TypeError(f"{col} must be an integer column, not {t.simpleString()}")


def ready(df: DataFrame) -> DataFrame:
    """Let Python workers find this package where the driver has it (else they use an installed one)."""
    env = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return df


_held: dict = {}


def worker_state(*key, make):
    """What a Python worker keeps for one operator between its batches and tasks (an encoder, say).

    A worker serves many operators in turn and stays alive between them: what
    another one left is dropped first, so that only one's state is held.
    """
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make()
    return _held[key]


_written: list[tuple[SparkSession, str]] = []


def _drop_written() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session is gone: its folder stays
            return


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that all executors see. The tables of a
    session are removed when its driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_drop_written)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)
