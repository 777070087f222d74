"""Annotation tables in, result tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seqspark.operators.filters import require_columns

# Fixed value: the one column an annotation table cannot do without.
REQUIRED = ("TE_name",)


def read_annotations(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """An annotation CSV with a header. Give a schema to spare the extra pass that infers one."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return require_columns(reader.csv(path), REQUIRED)


REJECTED = "_rejected"


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An annotation CSV by a schema, every line kept: ``_rejected`` holds a line that does not fit, else NULL.

    Values that cannot be read are NULL. Lines are judged where they are read, in one pass over splittable files.
    """
    noted = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    reader = spark.read.schema(noted).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
    found = reader.option("columnNameOfCorruptRecord", REJECTED).option("enforceSchema", False).csv(path)
    return require_columns(found, REQUIRED)


def write_csv(df: DataFrame, path: str) -> None:
    """A result table as CSV part files with a header; quotes within values are doubled."""
    df.write.option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """A result table as parquet."""
    df.write.parquet(path)
