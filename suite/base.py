"""The registry of queries and the frames most of them start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.decode import decode_json
from freshet.schemas import schema
from freshet.session import configure
from freshet.sources.files import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# The events table with its payload decoded, in SQL.
EV = "(SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events) ev"
COUNTER = schema(k="integer")


def query(sql: str | None = None, name: str | None = None):
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLE[key] = sql
        return function

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(configure(spark), folder, name)


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table with the payload's counter as a column."""
    decoded = decode_json(read(spark, folder, "events"), COUNTER, "props", nested="_p")
    return decoded.withColumn("k", F.col("_p.k")).drop("_p")


def shortened(df: DataFrame, **digits: int) -> DataFrame:
    """Results cut to some decimals, so that the order of adding does not show in the comparison."""
    return df.withColumns({c: F.floor(F.col(c) * 10.0**n + 0.3) / 10.0**n for c, n in digits.items()})


def shortened_sql(value: str, digits: int) -> str:
    return f"floor(({value}) * {10.0**digits}::DOUBLE + 0.3::DOUBLE) / {10.0**digits}::DOUBLE"


def second(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(ts)


def clock(seconds_sql: str) -> str:
    """SQL text for whole epoch seconds, as ``second`` prints them."""
    return f"strftime(make_timestamp(CAST({seconds_sql} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"
