"""Plans that enrich each record from keyed state or a lookup.

Where state depends on the order of records, ``seq`` is the integer column that
gives it: the log offset, as a key's records share a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.functions.scalars import plain_number
from freshet.functions.rules import classify, label
from freshet.functions.text import tokens
from freshet.operators.lookups import first_written, lookup
from freshet.operators.ordered import changed, halving_fold, latched, running_count
from freshet.operators.ranking import rank_asof
from freshet.operators.windows import with_window
from freshet.operators.words import running_words
from freshet.plans import values as V
from freshet.plans.base import plan
from freshet.streaming import processors
from freshet.streaming.carried import changed_batches, latched_batches, rank_batches, running_count_batches
from freshet.streaming.ranks import rank_parts, ranks
from freshet.streaming.runs import Batch
from freshet.streaming.state import changed_stream, latched_stream, running_sum_stream, windowed_fold_stream

ORDER = ("offset",)


def _interest_on_stream(df: DataFrame, seq: str = "offset") -> DataFrame:
    return running_sum_stream(df, ["user_id", "category"], seq, None, "enriched_interest")


def _interest_on_batches(folder: str, sink: Batch, seq: str = "offset", **cut) -> Batch:
    return running_count_batches(["user_id", "category"], seq, "enriched_interest", folder, sink, **cut)


@plan(S.PAGE_VIEW, on_stream=_interest_on_stream, keep=ORDER, on_batches=_interest_on_batches)
def interest_profile(df: DataFrame, seq: str = "offset") -> DataFrame:
    """How often the user has seen the category so far."""
    return running_count(df, ["user_id", "category"], seq, "enriched_interest")


@plan(S.DEMAND)
def dynamic_prices(df: DataFrame, base_prices: DataFrame) -> DataFrame:
    """Base price of the item plus a step per point of demand."""
    priced = lookup(df, base_prices, "item_id", {"base_price": V.BASE_PRICE})
    factor = F.lit(1) + F.col("demand_index") * V.PRICE_STEP
    return priced.withColumn("calculated_price", F.col("base_price") * factor).drop("base_price")


def _card_alerts_on_stream(df: DataFrame, seq: str = "offset") -> DataFrame:
    return changed_stream(df, "card_id", seq, "country", "fraud_alert")


def _card_alerts_on_batches(folder: str, sink: Batch, seq: str = "offset", **cut) -> Batch:
    return changed_batches("card_id", seq, "country", "fraud_alert", folder, sink, **cut)


@plan(S.CARD_USE, on_stream=_card_alerts_on_stream, keep=ORDER, on_batches=_card_alerts_on_batches)
def card_alerts(df: DataFrame, seq: str = "offset") -> DataFrame:
    """Whether the card is used in another country than the time before."""
    return changed(df, "card_id", seq, "country", "fraud_alert")


@plan(S.THERMOSTAT)
def overheating_devices(df: DataFrame, limits: DataFrame) -> DataFrame:
    limited = lookup(df, limits, "device_id", {"limit": V.DEVICE_LIMIT})
    return classify(limited, "alert", [(F.col("temp") > F.col("limit"), V.DEVICE_HOT)], V.DEVICE_OK).drop("limit")


@plan(S.TRUCK)
def zone_violations(df: DataFrame, planned: DataFrame) -> DataFrame:
    """Whether the truck is elsewhere than planned."""
    expected = lookup(df, planned, "truck_id", {"planned_zone": V.PLANNED_ZONE})
    return expected.withColumn("violation", F.col("current_zone") != F.col("planned_zone")).drop("planned_zone")


def _claimed(rows: DataFrame) -> DataFrame:
    """Compares with the plan as it stood; the default stands in only where none was offered."""
    expected = F.coalesce("planned_zone", F.lit(V.PLANNED_ZONE))
    return rows.withColumn("violation", F.col("current_zone") != expected)


def _zones_on_stream(df: DataFrame, seq: str = "offset", planned: DataFrame | None = None) -> DataFrame:
    return _claimed(processors.first_written(df, "truck_id", seq, "offered_zone", "planned_zone", planned))


@plan(S.OFFERED_ZONE, on_stream=_zones_on_stream, keep=ORDER)
def claimed_zones(df: DataFrame, seq: str = "offset", planned: DataFrame | None = None) -> DataFrame:
    """The zone first planned for the truck, by a record or before, and whether it is elsewhere."""
    return _claimed(first_written(df, "truck_id", seq, "offered_zone", "planned_zone", planned))


def _ranks_on_batches(folder: str, sink: Batch, seq: str = "offset", **options) -> Batch:
    return rank_batches("player", seq, "points", folder, sink, **options)


def _ranks_on_stream(df: DataFrame, seq: str = "offset") -> DataFrame:
    return rank_parts(df, "player", seq, "points")


@plan(S.PLAYER, on_stream=_ranks_on_stream, keep=ORDER, on_batches=_ranks_on_batches, finish=ranks)
def player_ranks(df: DataFrame, seq: str = "offset") -> DataFrame:
    """Running score and rank among all players at each record."""
    return rank_asof(df, "player", seq, "points")


@plan(S.QUOTE)
def trade_actions(df: DataFrame) -> DataFrame:
    return classify(df, "action", [(F.col("price") < V.BUY_BELOW, V.BUY)], V.HOLD)


@plan(S.QUOTE, mode="update")
def trade_balance(df: DataFrame) -> DataFrame:
    """What the buys have cost so far, as a balance from zero."""
    bought = F.when(F.col("price") < V.BUY_BELOW, F.col("price")).otherwise(0)
    return df.groupBy().agg((-F.sum(bought)).alias("balance_usd"))


def _tags_on_stream(df: DataFrame, seq: str = "offset") -> DataFrame:
    return running_sum_stream(df, ["tag"], seq, None, "tag_total")


def _tags_on_batches(folder: str, sink: Batch, seq: str = "offset", **cut) -> Batch:
    return running_count_batches("tag", seq, "tag_total", folder, sink, **cut)


@plan(S.POST, on_stream=_tags_on_stream, keep=ORDER, on_batches=_tags_on_batches)
def tag_totals(df: DataFrame, seq: str = "offset") -> DataFrame:
    """How often the tag has been used so far."""
    return running_count(df, "tag", seq, "tag_total")


@plan(S.PATIENT)
def patient_risk(df: DataFrame, limits: DataFrame) -> DataFrame:
    limited = lookup(df, limits, "patient_id", {"max_bpm": V.PULSE_LIMIT})
    critical, elevated, low = V.PULSE_LABELS
    rules = [(F.col("bpm") > F.col("max_bpm"), critical), (F.col("bpm") > V.PULSE_ELEVATED, elevated)]
    return limited.withColumn("risk_level", label(rules, low)).drop("max_bpm")


def _logins_on_stream(df: DataFrame, seq: str = "offset", blacklist: DataFrame | None = None) -> DataFrame:
    seeded = None
    if blacklist is not None:
        known = blacklist.select("src_ip").distinct().withColumn("_seeded", F.lit(True))
        df, seeded = df.join(known, "src_ip", "left"), "_seeded"
    out = latched_stream(df, "src_ip", seq, "status", V.LOGIN_FAILED, "blocked", V.LOGIN_FAILURES, seeded)
    return out.drop("_seeded")


def _logins_on_batches(
    folder: str, sink: Batch, seq: str = "offset", blacklist: DataFrame | None = None, **cut
) -> Batch:
    failing = F.col("status") == V.LOGIN_FAILED
    return latched_batches("src_ip", seq, failing, "blocked", V.LOGIN_FAILURES, folder, sink, blacklist, **cut)


@plan(S.LOGIN, on_stream=_logins_on_stream, keep=ORDER, on_batches=_logins_on_batches)
def login_blocks(df: DataFrame, seq: str = "offset", blacklist: DataFrame | None = None) -> DataFrame:
    """Whether the address was blocked before this login."""
    failing = F.col("status") == V.LOGIN_FAILED
    return latched(df, "src_ip", seq, failing, "blocked", V.LOGIN_FAILURES, blacklist)


@plan(S.COMMENT, mode="complete")
def word_counts(df: DataFrame) -> DataFrame:
    return tokens(df.select("text"), "text").groupBy("word").agg(F.count("*").alias("count"))


def _word_counts_on_stream(df: DataFrame, seq: str = "offset") -> DataFrame:
    return processors.running_words(df, seq, "text")


@plan(S.COMMENT, on_stream=_word_counts_on_stream, keep=ORDER)
def running_word_counts(df: DataFrame, seq: str = "offset") -> DataFrame:
    """Every word with its count so far, in the order of texts and words."""
    return running_words(df, seq, "text")


@plan(S.PAYMENT)
def high_value_alerts(df: DataFrame) -> DataFrame:
    """A message per payment over the limit."""
    high = df.filter(F.col("amount") > V.HIGH_VALUE)
    message = F.format_string(V.HIGH_VALUE_MESSAGE, F.col("id"), plain_number("amount"))
    return high.select("id", message.alias("message"))


def _folds_on_stream(df: DataFrame, size: str = "5 seconds", watermark: str = "0 seconds") -> DataFrame:
    return windowed_fold_stream(df, "ts", size, ["sensor"], "seq", "temp", "folded", watermark)


@plan(S.SENSOR, on_stream=_folds_on_stream)
def sensor_folds(df: DataFrame, size: str = "5 seconds") -> DataFrame:
    """The halving fold of each sensor's values within each window."""
    return halving_fold(with_window(df, "ts", size), ["window_start", "window_end", "sensor"], "seq", "temp", "folded")


@plan(S.CLICK)
def click_profiles(df: DataFrame, users: DataFrame) -> DataFrame:
    """Clicks with the user's name and risk."""
    return lookup(df, users, "user_id", V.UNKNOWN_PROFILE)
