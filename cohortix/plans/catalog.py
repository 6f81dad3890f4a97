"""Registered queries: one per operator, over the driver's test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; ``ORACLE`` holds
the DuckDB SQL twin with the same column names. Doubles are rounded to 6 dp
on both sides so the engines' last-bit differences do not matter; counts are
BIGINT on both sides.

Shared inputs (profiled): lineitem (no NULLs, so some columns are NULLed with
``nullif``), events scored as ``value / 500`` with label ``event_type =
'purchase'``, orders grouped by ``o_custkey``, documents, labels, customer.
"""

from __future__ import annotations

import atexit
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortix.sources.scan import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def round_half_away(x, digits: int = 6):
    """Round a double half away from zero at ``digits`` decimals as
    ``round(x * 10^d) / 10^d`` - the oracle engine's rule for doubles - with
    arithmetic only (Spark's ``round`` goes through BigDecimal per value).
    Values too large for the scaled integer keep all their digits."""
    m = float(10 ** digits)
    y = F.abs(x) * m
    r = F.signum(x) * F.floor(y + 0.5).cast("double") / m
    return F.when(F.abs(x) < 1e12, r).otherwise(x)


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (oracle comparison)."""
    return df.select(
        *[
            round_half_away(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- shared inputs ----------------------------------------------------------------

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_ORDER = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def lineitem(spark, sf):
    return table(spark, sf, "lineitem")


def lineitem_nulls(spark, sf):
    """lineitem with l_tax and l_discount zeros as NULL."""
    li = lineitem(spark, sf)
    return li.withColumns(
        {"l_tax": F.nullif(F.col("l_tax"), F.lit(0.0)),
         "l_discount": F.nullif(F.col("l_discount"), F.lit(0.0))}
    )


LI_NULLS_SQL = """(SELECT * REPLACE (nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount)
  FROM lineitem)"""


def scored_events(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(
        "event_id", "user_id", "event_type", "value",
        (F.col("value") / 500.0).alias("score"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )


EV_SQL = """(SELECT event_id, user_id, event_type, value, value / 500.0 AS score,
  CAST(event_type = 'purchase' AS INTEGER) AS label FROM events)"""


def split_hash_sql(key_sql: str, seed: int = 42) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws(':', '{seed}', {key_sql})), 1, 15)) AS BIGINT)"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the session's shared checkpoint directory, removed when the driver ends."""
    from cohortix.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_drop_scratch)
    _SCRATCH.append((spark, path))
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


def _drop_scratch() -> None:
    for spark, path in _SCRATCH:
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session has ended
            return
