"""Dimension tables from CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickloom.schemas import PRODUCT_SCHEMA, USER_SCHEMA
from clickloom.sources.tables import write_table


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; blank fields are null, a malformed line stops the load."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", enforceSchema=False)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCT_SCHEMA)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, USER_SCHEMA)


def load_dimension(source: DataFrame, path: str) -> DataFrame:
    """Full replace of a dimension table."""
    return write_table(source, path)
