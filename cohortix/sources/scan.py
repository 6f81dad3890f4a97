"""Sources: CSV / Parquet scans with an explicit schema, NaN -> NULL, optional
row position, existence checks and column requirements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_ORDER = "_row_order"


def _fractional(t: T.DataType) -> bool:
    return isinstance(t, (T.DoubleType, T.FloatType))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to NULL in every floating column (one projection)."""
    exprs = {
        f.name: F.when(~F.isnan(F.col(f.name)), F.col(f.name))
        for f in df.schema.fields
        if _fractional(f.dataType)
    }
    return df.withColumns(exprs) if exprs else df


def with_row_order(df: DataFrame) -> DataFrame:
    """Add ``_row_order = struct(file_path, row_index)``: the file order of each
    row, stable across retries (read from the Parquet metadata, not generated)."""
    return df.withColumn(
        ROW_ORDER,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ),
    )


def _from_text(c: str, t: T.DataType):
    """Cast a text column safely: bad text -> NULL, "NaN" -> NULL, "1.0" -> 1."""
    x = F.col(c)
    if isinstance(t, T.StringType):
        return x
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # whole numbers as they are (a double would lose digits above 2^53), "1.0" by way of a decimal
        return F.coalesce(x.try_cast(t), x.try_cast("decimal(38,10)").try_cast(t))
    return x.try_cast(t)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_values: Sequence[str] = ("", "NaN", "nan", "NA")) -> DataFrame:
    """Header CSV; empty and NaN text are missing.

    With ``schema`` the header names (not positions) decide which field is
    which, text is cast per field (bad values become NULL), and a field absent
    from the header is an error. Without it, types are inferred (an extra
    pass over the data; give a schema in production).
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("nullValue", "")
    if schema is None:
        df = reader.option("inferSchema", True).option("nanValue", "NaN").csv(path)
    else:
        raw = reader.option("inferSchema", False).csv(path)
        require_columns(raw, [f.name for f in schema.fields])
        df = raw.select(*[_from_text(f.name, f.dataType).alias(f.name) for f in schema.fields])
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    extra = [v for v in null_values if v != ""]
    if str_cols and extra:
        df = df.withColumns({c: F.when(~F.col(c).isin(extra), F.col(c)) for c in str_cols})
    return nan_to_null(df)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 row_order: bool = False, where=None) -> DataFrame:
    """Parquet scan (projection and filters push down), NaN -> NULL.

    A filter on a floating column after the scan sees the NaN rule, not the
    column, and is not pushed. ``where`` is applied to the columns as stored,
    so it prunes row groups; repeat the filter after the scan if NaN could
    pass it.
    """
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    if row_order:
        df = with_row_order(df)
    if columns is not None:
        df = df.select(*columns, *([ROW_ORDER] if row_order else []))
    return nan_to_null(df)


def table(spark: SparkSession, sf_dir: str, name: str, **kw) -> DataFrame:
    """One of the test tables ``{sf_dir}/{name}.parquet``."""
    return scan_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", **kw)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop FileSystem of the path (works on any store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def scan_if_exists(spark: SparkSession, path: str, fmt: str = "parquet",
                   schema: T.StructType | None = None) -> DataFrame | None:
    """The table if ``path`` exists, else ``None`` (the caller skips the step)."""
    if not path_exists(spark, path):
        return None
    if fmt == "csv":
        return scan_csv(spark, path, schema)
    return scan_parquet(spark, path)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from ``df`` (metadata only)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Refuse to go on when a required column is missing."""
    miss = missing_columns(df, required)
    if miss:
        raise ValueError(f"missing required columns: {miss}")
    return df
