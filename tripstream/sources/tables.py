"""Static (batch) readers: SRC-5..10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripstream.sources.streams import JSON_TS_OPTIONS


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """SRC-7 (schema from the footer) / SRC-8 (explicit schema; absent columns read as null)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_found(spark: SparkSession, path: str) -> DataFrame:
    """SNK-10: a table whose files differ in their schema, which is found by merging all footers.

    Columns that a file lacks read as null; decimals of one scale widen to the widest. The
    footers are read by a Spark job; other changes of type are an error, never a guess.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def read_dimension_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC-5: static lookup CSV with a heading line, typed by an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_with_header(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC-6: fact CSV with a header; the header must name the schema's columns.

    ``enforceSchema=False`` makes Spark check the header against the schema
    instead of binding columns by position.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC-9: JSON-lines directory with an explicit schema (microsecond timestamps)."""
    return spark.read.schema(schema).options(**JSON_TS_OPTIONS).json(path)


def sql_over_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """SRC-10: register ``df`` as a temp view and run SQL text over it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
