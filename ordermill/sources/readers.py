"""Readers with declared schemas."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import CORRUPT, CUSTOMERS_CSV, ORDERS_CSV, PRODUCTS_CSV, RAW_ORDERS
from .json_records import read_json_records


def read_raw_orders(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool = True,
    schema: T.StructType | None = RAW_ORDERS,
    split: bool = True,
) -> DataFrame:
    """Nested orders from JSON: with ``multiline`` a file is one array or object, otherwise one
    object per line. Both kinds of files split over tasks (see ``read_json_records``); with ``split=False``, or without
    a schema, a multi-line file is read by one task, which suits many small files.

    Text that is not JSON ends up in ``_corrupt_record``: the record, but the whole file where it is read by one task.
    ``schema=None`` infers the schema, at the price of a pass over the data.
    """
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        if CORRUPT not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        if multiline and split:
            return read_json_records(spark, path, schema)
        reader = reader.schema(schema)
    return reader.json(path, multiLine=multiline)


def ingest_path(raw_root: str, ingest_date: datetime.date | str) -> str:
    """The JSON files of one ingest day."""
    return f"{raw_root.rstrip('/')}/ingest_date={ingest_date}/*.json"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; ``schema=None`` infers the types. Times without an offset are UTC in any session."""
    reader = spark.read.option("header", True).option("timeZone", "UTC")
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ORDERS_CSV)


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CUSTOMERS_CSV)


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCTS_CSV)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, with its partition columns; folders starting with ``_`` are not part of it."""
    return spark.read.parquet(path)


def calendar(spark: SparkSession, first: datetime.date | str, last: datetime.date | str, name: str = "day") -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    first, last = (datetime.date.fromisoformat(str(day)) for day in (first, last))
    days = spark.range((last - first).days + 1)
    return days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def register_views(**frames: DataFrame) -> None:
    """Make frames available to ``spark.sql`` under their argument names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
