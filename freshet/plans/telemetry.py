"""Rules and windows over event streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.functions.rules import classify
from freshet.functions.scalars import epoch_to_ts
from freshet.functions.text import keyword_label, polarity, polarity_label
from freshet.operators.aggregates import group_all, ranked, top_n, volume_alert
from freshet.operators.clusters import score
from freshet.operators.windows import windowed
from freshet.plans import values as V
from freshet.plans.base import plan


@plan(S.FLIGHT)
def aviation_status(df: DataFrame) -> DataFrame:
    """Flights by engine heat, then by fuel."""
    return classify(df, "status", V.AVIATION_RULES, V.AVIATION_DEFAULT)


@plan(S.FLIGHT)
def aviation_overheat(df: DataFrame) -> DataFrame:
    return df.filter(F.col("engine_temp") > V.AVIATION_HOT_ENGINE)


@plan(S.VITALS)
def vitals_status(df: DataFrame) -> DataFrame:
    return classify(df, "status", V.VITALS_RULES, V.VITALS_DEFAULT)


@plan(S.VITALS)
def vitals_critical(df: DataFrame) -> DataFrame:
    """Critical patients only, at a lower pulse limit."""
    return classify(df, "status", V.VITALS_STRICT_RULES, V.VITALS_DEFAULT).filter("status = 'CRITICAL'")


@plan(S.TRANSACTION)
def transaction_clusters(df: DataFrame, model) -> DataFrame:
    """Transactions with the cluster a fitted model puts them in."""
    columns = ["amount", "distance_km"]
    return score(model, df, columns).select("transaction_id", *columns, "prediction")


@plan(S.STOCK, mode="update")
def stock_averages(df: DataFrame, watermark: str | None = None) -> DataFrame:
    """Mean price per symbol over ten seconds, every five."""
    timed = df.withColumn("timestamp", epoch_to_ts("timestamp"))
    mean = {"average_price": F.avg("price")}
    return windowed(timed, "timestamp", V.STOCK_WINDOW, ["symbol"], mean, V.STOCK_SLIDE, watermark)


@plan(S.COMMENT)
def comment_keywords(df: DataFrame) -> DataFrame:
    lists = [(V.POSITIVE, V.POSITIVE_WORDS), (V.NEGATIVE, V.NEGATIVE_WORDS)]
    return keyword_label(df, "text", lists, "sentiment", V.NEUTRAL)


@plan(S.COMMENT)
def comment_sentiment(df: DataFrame, lexicon: Mapping[str, float]) -> DataFrame:
    """Mean word score of each comment, as a label."""
    scored = df.withColumn("polarity", polarity("text", lexicon))
    return scored.withColumn("sentiment", polarity_label("polarity", V.SENTIMENT_HIGH, V.SENTIMENT_LOW))


@plan(S.COMMENT, mode="per_batch")
def negative_volume(df: DataFrame, batch: str | None = None) -> DataFrame:
    """Batches with an unusual number of negative comments."""
    return volume_alert(df, batch, "sentiment = 'NEGATIVE'", V.NEGATIVES_PER_BATCH, "negatives")


@plan(S.GRID)
def grid_status(df: DataFrame) -> DataFrame:
    return classify(df, "status", V.GRID_RULES, V.GRID_DEFAULT)


@plan(S.GRID)
def grid_anomalies(df: DataFrame) -> DataFrame:
    return df.filter(V.GRID_RULES[0][0])


@plan(S.NETWORK, mode="update")
def intrusion_alerts(df: DataFrame) -> DataFrame:
    """Addresses with too many requests in five seconds."""
    counts = windowed(
        df, "timestamp", V.INTRUSION_WINDOW, ["source_ip"], {"count": F.count("*")}, watermark=V.INTRUSION_WATERMARK
    )
    return counts.filter(F.col("count") > V.INTRUSION_REQUESTS).withColumn("alert", F.lit(V.INTRUSION_LABEL))


@plan(S.SCORE, mode="complete")
def leaderboard(df: DataFrame) -> DataFrame:
    """All players by total score."""
    return ranked(group_all(df, "player_id", total_score=F.sum("score")), "total_score", ["player_id"])


@plan(S.SCORE, mode="complete")
def leaderboard_top(df: DataFrame) -> DataFrame:
    totals = group_all(df, "player_id", total_score=F.sum("score"))
    return top_n(totals, "total_score", V.LEADERBOARD_TOP, ["player_id"])


@plan(S.SALE, mode="update")
def sold_quantities(df: DataFrame) -> DataFrame:
    """Units sold per product since the start."""
    return group_all(df, "product_id", sold_quantity=F.sum("quantity"))


@plan(S.SALE, mode="update")
def restock_alerts(df: DataFrame) -> DataFrame:
    return group_all(df, "product_id", sold_quantity=F.sum("quantity")).filter(
        F.col("sold_quantity") > V.RESTOCK_SOLD
    )


@plan(S.SALE, mode="complete")
def low_stock(df: DataFrame) -> DataFrame:
    """Products whose stock, from a fixed start, has run low."""
    sold = group_all(df, "product_id", total_sold=F.sum("quantity"))
    left = sold.withColumn("current_stock", F.lit(V.INITIAL_STOCK) - F.col("total_sold"))
    return left.filter(F.col("current_stock") < V.STOCK_LOW)


@plan(S.RIDE, mode="update")
def surge_pricing(df: DataFrame) -> DataFrame:
    """Price multiplier per region from the requests of ten seconds."""
    timed = df.withColumn("timestamp", epoch_to_ts("timestamp"))
    counts = windowed(
        timed, "timestamp", V.SURGE_WINDOW, ["region"], {"count": F.count("*")}, watermark=V.SURGE_WATERMARK
    )
    return classify(counts, "multiplier", V.SURGE_RULES, V.SURGE_DEFAULT)


@plan(S.CLAIM)
def claim_risk(df: DataFrame) -> DataFrame:
    return classify(df, "risk", V.CLAIM_RULES, V.CLAIM_DEFAULT)


@plan(S.CLAIM)
def high_risk_claims(df: DataFrame) -> DataFrame:
    return classify(df, "risk", V.CLAIM_RULES, V.CLAIM_DEFAULT).filter("risk = 'HIGH'")


@plan(S.TYPED_EVENT, mode="update")
def event_type_counts(df: DataFrame, ts: str = "timestamp", watermark: str | None = None) -> DataFrame:
    """Events per type, counted anew every five seconds."""
    return windowed(df, ts, V.TYPE_WINDOW, ["tipo"], {"count": F.count("*")}, watermark=watermark)
