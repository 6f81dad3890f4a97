"""CSV scans map schema fields by header name and cast text safely."""

import pytest
from pyspark.sql import types as T

from cohortix.sources.scan import missing_columns, require_columns, scan_csv, scan_if_exists


def test_csv_fields_by_header_name(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("b,extra,a,c\n1.0,zz,hello,NaN\n2,zz,,3.5\nabc,zz,x,\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()),
                           T.StructField("c", T.DoubleType())])
    rows = [tuple(r) for r in scan_csv(spark, str(path), schema).collect()]
    assert rows == [("hello", 1, None), (None, 2, 3.5), ("x", None, None)]


def test_csv_missing_field_is_an_error(spark, tmp_path):
    path = tmp_path / "y.csv"
    path.write_text("a\n1\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(ValueError, match="missing required columns"):
        scan_csv(spark, str(path), schema)


def test_scan_if_exists_and_requirements(spark, tmp_path):
    assert scan_if_exists(spark, str(tmp_path / "nothing.parquet")) is None
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert missing_columns(df, ["a", "z"]) == ["z"]
    with pytest.raises(ValueError):
        require_columns(df, ["z"])
