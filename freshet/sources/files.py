"""Files: CSV tables, folders that grow, Parquet tables, document folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_table(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Many CSV files with a header as one table.

    Without a schema the types are inferred, which reads the files once more.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def csv_arrivals(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A growing folder of CSV files; the checkpoint knows which were read."""
    reader = spark.readStream.option("header", True).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def parquet_arrivals(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def zoned(df: DataFrame) -> DataFrame:
    """Timestamps without a zone as instants; watermarks take no others."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain}) if plain else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder, its timestamps as instants."""
    return zoned(spark.read.parquet(f"{folder}/{name}.parquet"))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Casts to a declared schema and takes its columns in its order."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def documents(spark: SparkSession, root: str, resource: str, schema: T.StructType, view: str | None = None) -> DataFrame:
    """A document folder, as a SQL table too if ``view`` is given."""
    found = spark.read.schema(schema).json(f"{root}/{resource}")
    if view:
        found.createOrReplaceTempView(view)
    return found
