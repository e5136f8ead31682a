"""Paged text results: CSV pages whose rows are all strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.decode import typed_from_strings


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every page of a folder as one typed result. Each page carries its
    header, which has to name the columns of the schema in their order; a
    missing value is an empty unquoted field, and a quoted one may hold line
    breaks. A page with another header or a row of another length fails."""
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
    reader = spark.read.schema(as_text).option("header", True).option("escape", '"')
    reader = reader.option("enforceSchema", False).option("multiLine", True)
    pages = reader.option("mode", "FAILFAST").csv(path)
    return typed_from_strings(pages, schema)
