"""Plans written in SQL over views of document folders and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.functions.rules import classify, label
from freshet.plans import values as V
from freshet.plans.base import plan


@plan(S.SEQUENCE)
def doubled_values(df: DataFrame) -> DataFrame:
    return df.sparkSession.sql("SELECT id, val, val * 2 AS doubled_val FROM {source}", source=df)


@plan(S.SERVER_LOG, mode="batch")
def log_levels(df: DataFrame) -> DataFrame:
    return df.sparkSession.sql("SELECT level, count(*) AS count FROM {logs} GROUP BY level", logs=df)


@plan(S.PRODUCT, mode="batch")
def premium_products(df: DataFrame, category: str = V.PREMIUM_CATEGORY, price: float = V.PREMIUM_PRICE) -> DataFrame:
    return df.sparkSession.sql(
        "SELECT name, price FROM {products} WHERE category = :category AND price > :price",
        {"category": category, "price": price},
        products=df,
    )


@plan(S.schema(timestamp="timestamp", value="long"))
def siem_events(df: DataFrame) -> DataFrame:
    """Numbered events with a label and a fixed address."""
    marked, normal = V.SIEM_LABELS
    return df.select(
        "timestamp",
        label([(F.col("value") % V.SIEM_EVERY == 0, marked)], normal).alias("event_type"),
        F.lit(V.SIEM_ADDRESS).alias("src_ip"),
        F.col("value").alias("id"),
    )


@plan(S.schema(timestamp="timestamp", event_type="string", src_ip="string", id="long"), mode="batch")
def siem_hunt(df: DataFrame) -> DataFrame:
    """A few marked events, the first by id."""
    return df.sparkSession.sql(
        f"SELECT * FROM {{siem}} WHERE event_type = '{V.SIEM_LABELS[0]}' ORDER BY id LIMIT {V.SIEM_SAMPLE}", siem=df
    )


@plan(S.CUSTOMER)
def customer_segments(df: DataFrame) -> DataFrame:
    return classify(df, "segment", [(F.col("spend") > V.VIP_SPEND, V.VIP)], V.REGULAR)


@plan(S.CUSTOMER, mode="batch")
def segment_spend(df: DataFrame) -> DataFrame:
    """Mean spend per segment."""
    segments = customer_segments.transform(df)
    return df.sparkSession.sql(
        "SELECT segment, avg(spend) AS avg_spend FROM {customers} GROUP BY segment", customers=segments
    )


@plan(S.SALE_TRX, mode="batch")
def sales_orders(df: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales with the status of their order."""
    return df.sparkSession.sql(
        "SELECT sale_id, amount, orderstatus FROM {sales} JOIN {orders} ON sale_id = orderkey",
        sales=df,
        orders=orders,
    )


@plan(S.SALE_TRX, mode="batch")
def sales_orders_sample(df: DataFrame, orders: DataFrame) -> DataFrame:
    """The first few of them by sale."""
    joined = sales_orders.transform(df, orders=orders)
    return joined.orderBy("sale_id").limit(V.JOIN_SAMPLE)
