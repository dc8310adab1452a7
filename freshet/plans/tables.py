"""Statistics over file tables. On a stream each poll's files are taken alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.functions.rules import classify
from freshet.functions.scalars import calendar_date, count_true, iso_to_ts, safe_ratio
from freshet.operators.aggregates import agg_multi, corr_matrix, group_agg, group_mean, ranked, top_n
from freshet.plans import values as V
from freshet.plans.base import plan


@plan(S.VEHICLE, mode="per_batch")
def driving_styles(df: DataFrame) -> DataFrame:
    """Mean speed and speed per thousand turns, by driving style."""
    per_turns = df.withColumn("efficiency", safe_ratio("speed_kmh", F.col("engine_rpm") / 1000))
    return group_mean(per_turns, "driving_style", ["speed_kmh", "efficiency"])


@plan(S.VEHICLE_LOG, mode="per_batch")
def fast_vehicles(df: DataFrame) -> DataFrame:
    return group_mean(df, "vehicle_id", ["speed_kmh"]).filter(F.col("speed_kmh") > V.FAST_VEHICLE_KMH)


@plan(S.VEHICLE_LOG, mode="per_batch")
def engine_correlation(df: DataFrame) -> DataFrame:
    return corr_matrix(df, ["rpm", "oil_temp"])


@plan(S.TRAFFIC, mode="per_batch")
def traffic_signals(df: DataFrame) -> DataFrame:
    """What each intersection's signal should do, from its mean traffic."""
    means = group_mean(df, "intersection_id", ["vehicle_count", "avg_speed"])
    return classify(means, "action", V.SIGNAL_RULES, V.SIGNAL_DEFAULT)


@plan(S.TRAFFIC, mode="per_batch")
def green_light_seconds(df: DataFrame) -> DataFrame:
    means = group_mean(df, "intersection_id", ["vehicle_count", "avg_speed"])
    timed = classify(means, "green_light_sec", V.GREEN_RULES, V.GREEN_DEFAULT)
    return top_n(timed, "vehicle_count", V.GREEN_TOP, ["intersection_id"])


@plan(S.ROUTE, mode="per_batch")
def route_fuel(df: DataFrame) -> DataFrame:
    """Mean minutes and litres per 100 km by route."""
    used = df.withColumn("fuel_efficiency", safe_ratio("fuel_consumed_l", "distance_km") * 100)
    return group_mean(used, "route_id", ["duration_min", "fuel_efficiency"])


@plan(S.DELIVERY, mode="per_batch")
def route_pace(df: DataFrame) -> DataFrame:
    """Mean minutes and km per minute by route."""
    paced = df.withColumn("efficiency", safe_ratio("distance_km", "delivery_time_min"))
    return group_mean(paced, "route_id", ["delivery_time_min", "efficiency"])


def _machine_means(df: DataFrame) -> DataFrame:
    """Means per machine, with the mean health taken from the means of the measures.

    A row's health is 100 less weighted measures, so the mean is the same; but
    whole-number measures then give one result in whatever order rows come.
    """
    vibration, temperature = F.col("vibration"), F.col("temperature")
    means = group_agg(
        df,
        "machine_id",
        vibration=F.avg("vibration"),
        temperature=F.avg("temperature"),
        _shaking=F.avg(F.when(temperature.isNotNull(), vibration)),
        _heat=F.avg(F.when(vibration.isNotNull(), temperature)),
    )
    wear = F.col("_shaking") * V.HEALTH_VIBRATION + F.col("_heat") * V.HEALTH_TEMPERATURE
    return means.withColumn("health_score", F.lit(V.HEALTH_FULL) - wear).drop("_shaking", "_heat")


@plan(S.MACHINE, mode="per_batch")
def machine_health(df: DataFrame) -> DataFrame:
    return _machine_means(df)


@plan(S.MACHINE, mode="per_batch")
def machine_maintenance(df: DataFrame) -> DataFrame:
    """Machines in poor health."""
    return _machine_means(df).filter(F.col("health_score") < V.HEALTH_LOW)


@plan(S.MACHINE, mode="per_batch")
def machine_alerts(df: DataFrame) -> DataFrame:
    """Mean, max and deviation per machine, for those that shake or run hot."""
    stats = agg_multi(df, "machine_id", ["vibration", "temperature"], ["mean", "max", "std"])
    return stats.filter(
        (F.col("vibration_mean") > V.MACHINE_VIBRATION_HIGH) | (F.col("temperature_mean") > V.MACHINE_TEMPERATURE_HIGH)
    )


@plan(S.SOIL, mode="per_batch")
def irrigation_needs(df: DataFrame) -> DataFrame:
    return group_mean(df, "zone_id", ["moisture_percent"]).filter(F.col("moisture_percent") < V.MOISTURE_LOW)


@plan(S.SOIL, mode="per_batch")
def irrigation_actions(df: DataFrame) -> DataFrame:
    means = group_mean(df, "zone_id", ["moisture_percent"])
    return classify(means, "action", V.IRRIGATION_RULES, V.IRRIGATION_DEFAULT)


def _tower_drops(df: DataFrame) -> DataFrame:
    dropped = count_true(F.col("status") == V.DROPPED)
    counts = group_agg(df, "tower_id", total_calls=F.count("call_id"), dropped_calls=dropped)
    rates = counts.withColumn("drop_rate", safe_ratio("dropped_calls", "total_calls"))
    return rates.filter(F.col("drop_rate") > V.DROP_RATE_HIGH)


@plan(S.CALL, mode="per_batch")
def bad_towers(df: DataFrame) -> DataFrame:
    """Towers that drop too many calls, the worst first."""
    return ranked(_tower_drops(df), "drop_rate", ["tower_id"])


@plan(S.CALL, mode="per_batch")
def worst_towers(df: DataFrame) -> DataFrame:
    return top_n(_tower_drops(df), "drop_rate", V.TOWERS_TOP, ["tower_id"])


@plan(S.WEATHER, mode="per_batch")
def heatwaves(df: DataFrame) -> DataFrame:
    return group_agg(df, "station_id", temp_c=F.max("temp_c")).filter(F.col("temp_c") > V.HEATWAVE)


@plan(S.WEATHER_YEAR, mode="per_batch")
def hot_days(df: DataFrame) -> DataFrame:
    """The hottest days of all stations."""
    dated = df.withColumn("date", calendar_date(iso_to_ts("timestamp")))
    highs = group_agg(dated, ["station_id", "date"], temperature=F.max("temperature"))
    return top_n(
        highs.filter(F.col("temperature") > V.HOT_DAY), "temperature", V.HOT_DAYS_TOP, ["station_id", "date"]
    )


@plan(S.BOOKING, mode="per_batch")
def hotel_revenue(df: DataFrame) -> DataFrame:
    """Confirmed bookings: revenue as booked, and nights."""
    kept = df.filter(F.col("status") == V.CONFIRMED)
    return group_agg(kept, "hotel_id", total_revenue=F.sum("price"), total_nights=F.sum("nights"))


@plan(S.BOOKING_MONTH, mode="per_batch")
def hotel_performance(df: DataFrame) -> DataFrame:
    """Confirmed bookings: revenue as nights times price, the highest first."""
    kept = df.filter(F.col("status") == V.CONFIRMED)
    stats = group_agg(
        kept,
        "hotel_id",
        total_revenue=F.sum(F.col("nights") * F.col("price_per_night")),
        total_bookings=F.count("booking_id"),
        avg_stay=F.avg("nights"),
    )
    return ranked(stats, "total_revenue", ["hotel_id"])


@plan(S.EXAM_EVENT, mode="per_batch")
def tab_switchers(df: DataFrame) -> DataFrame:
    switches = group_agg(df, "student_id", switches=count_true(F.col("event") == V.TAB_SWITCH))
    return switches.filter(F.col("switches") > V.TAB_SWITCHES)


@plan(S.EXAM_LOG, mode="per_batch")
def exam_flags(df: DataFrame) -> DataFrame:
    """Students with many tab switches or many fast answers."""
    stats = group_agg(
        df,
        "student_id",
        tab_switches=count_true(F.col("event_type") == V.TAB_SWITCH),
        fast_answers=count_true(F.col("time_spent_sec") < V.FAST_ANSWER_SEC),
    )
    return stats.filter(
        (F.col("tab_switches") > V.TAB_SWITCHES_REVIEW) | (F.col("fast_answers") > V.FAST_ANSWERS_REVIEW)
    )
