"""Grouped aggregates, having, sort and top n."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.scalars import calendar_date, count_true, safe_ratio
from freshet.operators.aggregates import (
    agg_multi,
    corr_matrix,
    distinct_keys,
    group_agg,
    ranked,
    top_n,
    volume_alert,
)
from freshet.plans.catalog import PLANS
from freshet.session import shared_path
from freshet.sinks.tables import save_bucketed
from suite.base import EV, events, query, read, shortened, shortened_sql
from suite.projections import CUSTOMERS, customers

def total(column):
    return shortened_sql(f"sum({column}::DOUBLE)", 2)


def mean(column):
    return shortened_sql(f"avg({column}::DOUBLE)", 6)


@query(
    f"SELECT l_returnflag, l_linestatus, {mean('l_quantity')} AS mean_quantity, "
    f"{mean('l_extendedprice')} AS mean_price FROM lineitem GROUP BY 1, 2"
)
def group_mean(spark, d):
    means = group_agg(
        read(spark, d, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        mean_quantity=F.avg("l_quantity"),
        mean_price=F.avg("l_extendedprice"),
    )
    return shortened(means, mean_quantity=6, mean_price=6)


@query(f"SELECT user_id, {total('value')} AS total_value FROM events GROUP BY user_id")
def group_sum(spark, d):
    return shortened(group_agg(read(spark, d, "events"), "user_id", total_value=F.sum("value")), total_value=2)


@query("SELECT user_id, event_type, count(*) AS count FROM events GROUP BY 1, 2")
def group_count(spark, d):
    return group_agg(read(spark, d, "events"), ["user_id", "event_type"], count=F.count("*"))


@query("SELECT user_id, max(value) AS max_value FROM events GROUP BY user_id")
def group_max(spark, d):
    return group_agg(read(spark, d, "events"), "user_id", max_value=F.max("value"))


@query(
    "SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, max(value) AS max_value FROM events GROUP BY 1, 2"
)
def daily_max(spark, d):
    dated = read(spark, d, "events").withColumn("date", calendar_date("ts"))
    highs = group_agg(dated, ["event_type", "date"], max_value=F.max("value"))
    return highs.withColumn("date", F.col("date").cast("string"))


@query(
    "SELECT l_returnflag, round(avg(l_quantity), 6) AS l_quantity_mean, max(l_quantity) AS l_quantity_max, "
    "round(stddev_samp(l_quantity), 6) AS l_quantity_std, round(avg(l_extendedprice), 4) AS l_extendedprice_mean, "
    "max(l_extendedprice) AS l_extendedprice_max, round(stddev_samp(l_extendedprice), 4) AS l_extendedprice_std "
    "FROM lineitem GROUP BY l_returnflag"
)
def multi_stats(spark, d):
    stats = agg_multi(
        read(spark, d, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"], ["mean", "max", "std"]
    )
    digits = {"l_quantity": 6, "l_extendedprice": 4}
    return stats.withColumns({f"{c}_{f}": F.round(f"{c}_{f}", n) for c, n in digits.items() for f in ("mean", "std")})


@query(
    "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS finished, "
    "count(*) FILTER (o_totalprice > 300000) AS large FROM orders GROUP BY o_custkey"
)
def conditional_count(spark, d):
    return group_agg(
        read(spark, d, "orders"),
        "o_custkey",
        finished=count_true("o_orderstatus = 'F'"),
        large=count_true("o_totalprice > 300000"),
    )


CALLS = (
    "(SELECT event_id AS call_id, user_id AS tower_id, "
    "CASE WHEN event_type = 'error' THEN 'DROP' ELSE 'OK' END AS status FROM events)"
)
TOWERS = (
    "(SELECT tower_id, count(call_id) AS total_calls, count(*) FILTER (status = 'DROP') AS dropped_calls, "
    f"CAST(count(*) FILTER (status = 'DROP') AS DOUBLE) / count(call_id) AS drop_rate FROM {CALLS} GROUP BY tower_id)"
)


def calls(spark, d):
    return read(spark, d, "events").select(
        F.col("event_id").alias("call_id"),
        F.col("user_id").alias("tower_id"),
        F.when(F.col("event_type") == "error", "DROP").otherwise("OK").alias("status"),
    )


@query(f"SELECT * FROM {TOWERS}")
def drop_rate(spark, d):
    dropped = count_true("status = 'DROP'")
    counts = group_agg(calls(spark, d), "tower_id", total_calls=F.count("call_id"), dropped_calls=dropped)
    return counts.withColumn("drop_rate", safe_ratio("dropped_calls", "total_calls"))


@query(f"SELECT * FROM {TOWERS} WHERE drop_rate > 0.1")
def having_rate(spark, d):
    return PLANS["bad_towers"].run(calls(spark, d))


@query(f"SELECT * FROM {TOWERS} WHERE drop_rate > 0.1 ORDER BY drop_rate DESC, tower_id LIMIT 5")
def worst_towers(spark, d):
    return PLANS["worst_towers"].run(calls(spark, d))


@query(
    f"SELECT o_custkey, {total('o_totalprice')} AS total_revenue, count(o_orderkey) AS total_bookings, "
    f"{mean('o_totalprice')} AS mean_price FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey"
)
def revenue_stats(spark, d):
    stats = group_agg(
        read(spark, d, "orders").filter(F.col("o_orderstatus") == "F"),
        "o_custkey",
        total_revenue=F.sum("o_totalprice"),
        total_bookings=F.count("o_orderkey"),
        mean_price=F.avg("o_totalprice"),
    )
    return shortened(stats, total_revenue=2, mean_price=6)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem"
        for a in MEASURES
        for b in MEASURES
    ),
    name="corr_matrix",
)
def corr_matrix_query(spark, d):
    return corr_matrix(read(spark, d, "lineitem"), MEASURES).withColumn("r", F.round("r", 6) + 0.0)


@query("SELECT DISTINCT user_id FROM events WHERE value > 200")
def alert_keys(spark, d):
    return distinct_keys(read(spark, d, "events").filter(F.col("value") > 200), "user_id")


@query(f"SELECT user_id, {mean('value')} AS mean_value FROM events GROUP BY 1 HAVING avg(value::DOUBLE) > 50")
def having_mean(spark, d):
    means = group_agg(read(spark, d, "events"), "user_id", mean_value=F.avg("value"))
    return shortened(means.filter(F.col("mean_value") > 50), mean_value=6)


@query(f"SELECT user_id, CAST(sum(k) AS BIGINT) AS total FROM {EV} GROUP BY 1 HAVING sum(k) > 3300")
def having_sum(spark, d):
    return group_agg(events(spark, d), "user_id", total=F.sum("k")).filter(F.col("total") > 3300)


@query("SELECT user_id, max(value) AS max_value FROM events GROUP BY 1 HAVING max(value) > 300")
def having_max(spark, d):
    return group_agg(read(spark, d, "events"), "user_id", max_value=F.max("value")).filter(F.col("max_value") > 300)


@query(
    "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_type = 'error') AS hits FROM events "
    "GROUP BY 1 HAVING count(*) FILTER (event_type = 'error') > 5",
    name="volume_alert",
)
def volume_alert_query(spark, d):
    daily = read(spark, d, "events").withColumn("day", calendar_date("ts").cast("string"))
    return volume_alert(daily, "day", "event_type = 'error'", 5)


@query(
    "SELECT strftime(ts, '%Y-%m-%d %H') AS hour, count(*) FILTER (k < 50) AS negatives FROM "
    f"{EV} GROUP BY 1 HAVING count(*) FILTER (k < 50) > 5"
)
def negative_volume(spark, d):
    labelled = events(spark, d).select(
        F.date_format("ts", "yyyy-MM-dd HH").alias("hour"),
        F.when(F.col("k") < 50, "NEGATIVE").otherwise("NEUTRAL").alias("sentiment"),
    )
    return PLANS["negative_volume"].run(labelled, batch="hour")


PARTS = f"SELECT l_partkey, {mean('l_quantity')} AS mean_quantity, count(*) AS lines FROM lineitem GROUP BY 1"


def parts(spark, d):
    means = group_agg(read(spark, d, "lineitem"), "l_partkey", mean_quantity=F.avg("l_quantity"), lines=F.count("*"))
    return shortened(means, mean_quantity=6)


@query(f"{PARTS} ORDER BY mean_quantity DESC, l_partkey LIMIT 20", name="top_n")
def top_n_query(spark, d):
    return top_n(parts(spark, d), "mean_quantity", 20, ["l_partkey"])


@query(f"{PARTS} ORDER BY mean_quantity DESC, l_partkey")
def sorted_stats(spark, d):
    return ranked(parts(spark, d), "mean_quantity", ["l_partkey"])


TRAFFIC = (
    "(SELECT l_partkey AS intersection_id, avg(l_quantity) AS vehicle_count, avg(l_linenumber) AS avg_speed "
    "FROM lineitem GROUP BY 1)"
)


def traffic(spark, d):
    return read(spark, d, "lineitem").select(
        F.col("l_partkey").alias("intersection_id"),
        F.col("l_quantity").cast("int").alias("vehicle_count"),
        F.col("l_linenumber").cast("double").alias("avg_speed"),
    )


@query(
    "SELECT *, CASE WHEN vehicle_count > 35 THEN 'EXTEND_GREEN_30S' WHEN vehicle_count > 25 THEN 'EXTEND_GREEN_15S' "
    f"ELSE 'NORMAL_CYCLE' END AS action FROM {TRAFFIC}"
)
def tiered_action(spark, d):
    return PLANS["traffic_signals"].run(traffic(spark, d))


@query(
    "SELECT *, CASE WHEN vehicle_count > 25 THEN 45 WHEN vehicle_count > 20 THEN 35 ELSE 30 END AS green_light_sec "
    f"FROM {TRAFFIC} ORDER BY vehicle_count DESC, intersection_id LIMIT 10"
)
def green_seconds(spark, d):
    return PLANS["green_light_seconds"].run(traffic(spark, d))


SOIL = "(SELECT l_partkey AS zone_id, avg(l_quantity) AS moisture_percent FROM lineitem GROUP BY 1)"


def soil(spark, d):
    return read(spark, d, "lineitem").select(
        F.col("l_partkey").alias("zone_id"), F.col("l_quantity").alias("moisture_percent")
    )


@query(f"SELECT *, CASE WHEN moisture_percent < 30 THEN 'ATIVAR' ELSE 'AGUARDAR' END AS action FROM {SOIL}")
def irrigation(spark, d):
    return PLANS["irrigation_actions"].run(soil(spark, d))


@query(f"SELECT * FROM {SOIL} WHERE moisture_percent < 25")
def irrigation_needs(spark, d):
    return PLANS["irrigation_needs"].run(soil(spark, d))


SOLD = "(SELECT l_orderkey AS product_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS n FROM lineitem GROUP BY 1)"


def sales(spark, d):
    return read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity")
    )


@query(f"SELECT product_id, n AS total_sold, 300 - n AS current_stock FROM {SOLD} WHERE 300 - n < 250")
def inventory_left(spark, d):
    return PLANS["low_stock"].run(sales(spark, d))


@query(f"SELECT product_id, n AS sold_quantity FROM {SOLD} WHERE n > 10")
def restock_alerts(spark, d):
    return PLANS["restock_alerts"].run(sales(spark, d))


@query(f"SELECT product_id, n AS sold_quantity FROM {SOLD}")
def sold_quantities(spark, d):
    return PLANS["sold_quantities"].run(sales(spark, d))


@query(
    "SELECT l_returnflag AS route_id, avg(l_linenumber) AS duration_min, "
    "round(avg(l_extendedprice / l_quantity * 100), 3) AS fuel_efficiency FROM lineitem GROUP BY 1"
)
def fuel_per_100km(spark, d):
    routes = read(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("route_id"),
        F.col("l_quantity").alias("distance_km"),
        F.col("l_linenumber").cast("double").alias("duration_min"),
        F.col("l_extendedprice").alias("fuel_consumed_l"),
    )
    return PLANS["route_fuel"].run(routes).withColumn("fuel_efficiency", F.round("fuel_efficiency", 3))


@query(
    "SELECT l_returnflag AS route_id, avg(l_quantity) AS delivery_time_min, "
    "round(avg(l_extendedprice / l_quantity), 5) AS efficiency FROM lineitem GROUP BY 1"
)
def route_pace(spark, d):
    routes = read(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("route_id"),
        F.col("l_extendedprice").alias("distance_km"),
        F.col("l_quantity").alias("delivery_time_min"),
    )
    return PLANS["route_pace"].run(routes).withColumn("efficiency", F.round("efficiency", 5))


MACHINES = (
    "(SELECT l_partkey AS machine_id, l_quantity AS vibration, floor(l_extendedprice / 1000) AS temperature FROM lineitem)"
)
# From the means, whose sums of whole numbers are exact: a mean of exactly 40 must
# not depend on the order in which rows are added up.
MEAN_HEALTH = "100 - (avg(vibration) * 0.5::DOUBLE + avg(temperature) * 0.3::DOUBLE)"
HEALTH = (
    "(SELECT machine_id, avg(vibration) AS vibration, avg(temperature) AS temperature, "
    f"round({MEAN_HEALTH}, 6) AS health_score "
    f"FROM {MACHINES} GROUP BY 1)"
)


def machines(spark, d):
    return read(spark, d, "lineitem").select(
        F.col("l_partkey").alias("machine_id"),
        F.col("l_quantity").alias("vibration"),
        F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("temperature"),
    )


@query(f"SELECT * FROM {HEALTH}")
def health_score(spark, d):
    return PLANS["machine_health"].run(machines(spark, d)).withColumn("health_score", F.round("health_score", 6))


# The measures are doubled, so that some machines pass the alert limits.
def worn_machines(spark, d):
    return machines(spark, d).withColumns({c: F.col(c) * 2 for c in ("vibration", "temperature")})


@query(
    "SELECT machine_id, avg(vibration) AS vibration, avg(temperature) AS temperature, "
    f"round({MEAN_HEALTH}, 6) AS health_score "
    f"FROM (SELECT machine_id, vibration * 2 AS vibration, temperature * 2 AS temperature FROM {MACHINES}) GROUP BY 1 "
    f"HAVING {MEAN_HEALTH} < 40"
)
def machine_maintenance(spark, d):
    return PLANS["machine_maintenance"].run(worn_machines(spark, d)).withColumn(
        "health_score", F.round("health_score", 6)
    )


@query(
    "SELECT machine_id, avg(vibration) AS vibration_mean, max(vibration) AS vibration_max, "
    "round(stddev_samp(vibration), 6) AS vibration_std, avg(temperature) AS temperature_mean, "
    "max(temperature) AS temperature_max, round(stddev_samp(temperature), 6) AS temperature_std "
    f"FROM (SELECT machine_id, vibration * 2 AS vibration, temperature * 2 AS temperature FROM {MACHINES}) GROUP BY 1 "
    "HAVING avg(vibration) > 60 OR avg(temperature) > 85"
)
def machine_alerts(spark, d):
    out = PLANS["machine_alerts"].run(worn_machines(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("vibration_std", "temperature_std")})


VEHICLES = (
    f"(SELECT user_id AS vehicle_id, CAST(k * 2 AS DOUBLE) AS speed_kmh, floor(value) + 800 AS rpm, "
    f"CAST(event_id % 90 AS DOUBLE) AS oil_temp, event_type AS driving_style FROM {EV})"
)


def vehicles(spark, d):
    return events(spark, d).select(
        F.col("user_id").alias("vehicle_id"),
        (F.col("k") * 2).cast("double").alias("speed_kmh"),
        (F.floor("value") + 800).cast("double").alias("rpm"),
        (F.col("event_id") % 90).cast("double").alias("oil_temp"),
        F.col("event_type").alias("driving_style"),
    )


@query(
    "SELECT driving_style, avg(speed_kmh) AS speed_kmh, round(avg(speed_kmh / (rpm / 1000)), 6) AS efficiency "
    f"FROM {VEHICLES} GROUP BY 1"
)
def driving_styles(spark, d):
    out = PLANS["driving_styles"].run(vehicles(spark, d).withColumnRenamed("rpm", "engine_rpm"))
    return out.withColumn("efficiency", F.round("efficiency", 6))


@query(f"SELECT vehicle_id, avg(speed_kmh) AS speed_kmh FROM {VEHICLES} GROUP BY 1 HAVING avg(speed_kmh) > 110")
def fast_vehicles(spark, d):
    return PLANS["fast_vehicles"].run(vehicles(spark, d))


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {VEHICLES}"
        for a in ("rpm", "oil_temp")
        for b in ("rpm", "oil_temp")
    )
)
def engine_correlation(spark, d):
    return PLANS["engine_correlation"].run(vehicles(spark, d)).withColumn("r", F.round("r", 6))


SCORES = f"(SELECT CAST(user_id AS VARCHAR) AS player_id, CAST(sum(k) AS BIGINT) AS total_score FROM {EV} GROUP BY 1)"


def scores(spark, d):
    return events(spark, d).select(F.col("user_id").cast("string").alias("player_id"), F.col("k").alias("score"))


@query(f"SELECT * FROM {SCORES} ORDER BY total_score DESC, player_id")
def leaderboard(spark, d):
    return PLANS["leaderboard"].run(scores(spark, d))


@query(f"SELECT * FROM {SCORES} ORDER BY total_score DESC, player_id LIMIT 5")
def leaderboard_top(spark, d):
    return PLANS["leaderboard_top"].run(scores(spark, d))


@query("SELECT user_id AS station_id, max(value / 5) AS temp_c FROM events GROUP BY 1 HAVING max(value / 5) > 35")
def heatwaves(spark, d):
    weather = read(spark, d, "events").select(F.col("user_id").alias("station_id"), (F.col("value") / 5).alias("temp_c"))
    return PLANS["heatwaves"].run(weather)


@query(
    "SELECT event_type AS station_id, strftime(ts, '%Y-%m-%d') AS date, max(value / 5) AS temperature FROM events "
    "GROUP BY 1, 2 HAVING max(value / 5) > 40 ORDER BY temperature DESC, station_id, date LIMIT 20"
)
def hot_days(spark, d):
    weather = read(spark, d, "events").select(
        F.col("event_type").alias("station_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        (F.col("value") / 5).alias("temperature"),
    )
    return PLANS["hot_days"].run(weather).withColumn("date", F.col("date").cast("string"))


BOOKINGS = (
    "(SELECT l_suppkey AS hotel_id, l_orderkey AS booking_id, l_linenumber AS nights, floor(l_extendedprice) AS price, "
    "CASE WHEN l_returnflag = 'R' THEN 'CANCELLED' ELSE 'CONFIRMED' END AS status FROM lineitem)"
)


def bookings(spark, d, price):
    return read(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("hotel_id"),
        F.col("l_orderkey").alias("booking_id"),
        F.col("l_linenumber").alias("nights"),
        F.floor("l_extendedprice").cast("double").alias(price),
        F.when(F.col("l_returnflag") == "R", "CANCELLED").otherwise("CONFIRMED").alias("status"),
    )


@query(
    "SELECT hotel_id, sum(price) AS total_revenue, CAST(sum(nights) AS BIGINT) AS total_nights "
    f"FROM {BOOKINGS} WHERE status = 'CONFIRMED' GROUP BY 1"
)
def hotel_revenue(spark, d):
    return PLANS["hotel_revenue"].run(bookings(spark, d, "price"))


@query(
    "SELECT hotel_id, sum(nights * price) AS total_revenue, count(booking_id) AS total_bookings, avg(nights) AS avg_stay "
    f"FROM {BOOKINGS} WHERE status = 'CONFIRMED' GROUP BY 1 ORDER BY total_revenue DESC, hotel_id"
)
def hotel_performance(spark, d):
    return PLANS["hotel_performance"].run(bookings(spark, d, "price_per_night"))


EXAMS = (
    "(SELECT CAST(user_id AS VARCHAR) AS student_id, CASE WHEN event_type = 'click' THEN 'TAB_SWITCH' ELSE 'ANSWER' END "
    "AS event_type, value AS time_spent_sec FROM events)"
)


def exams(spark, d, event):
    return read(spark, d, "events").select(
        F.col("user_id").cast("string").alias("student_id"),
        F.when(F.col("event_type") == "click", "TAB_SWITCH").otherwise("ANSWER").alias(event),
        F.col("value").alias("time_spent_sec"),
    )


@query(
    f"SELECT student_id, count(*) FILTER (event_type = 'TAB_SWITCH') AS switches FROM {EXAMS} GROUP BY 1 "
    "HAVING count(*) FILTER (event_type = 'TAB_SWITCH') > 5"
)
def tab_switchers(spark, d):
    return PLANS["tab_switchers"].run(exams(spark, d, "event"))


@query(
    "SELECT * FROM (SELECT student_id, count(*) FILTER (event_type = 'TAB_SWITCH') AS tab_switches, "
    f"count(*) FILTER (time_spent_sec < 10) AS fast_answers FROM {EXAMS} GROUP BY 1) "
    "WHERE tab_switches > 20 OR fast_answers > 30"
)
def exam_flags(spark, d):
    return PLANS["exam_flags"].run(exams(spark, d, "event_type"))


# SQL over views.


@query("SELECT event_type AS level, count(*) AS count FROM events GROUP BY 1")
def sql_group_count(spark, d):
    return PLANS["log_levels"].run(read(spark, d, "events").select(F.col("event_type").alias("level")))


@query("SELECT p_name AS name, p_retailprice AS price FROM part WHERE p_type = 'ECONOMY' AND p_retailprice > 1000")
def sql_filter(spark, d):
    products = read(spark, d, "part").select(
        F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"), F.col("p_type").alias("category")
    )
    return PLANS["premium_products"].run(products, category="ECONOMY", price=1000.0)


@query(
    "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, 'MALICIOUS' AS event_type, '192.168.1.1' AS src_ip, "
    "event_id AS id FROM events WHERE event_id % 10 = 0 ORDER BY event_id LIMIT 5"
)
def sql_filter_limit(spark, d):
    numbered = read(spark, d, "events").select(F.col("ts").alias("timestamp"), F.col("event_id").alias("value"))
    out = PLANS["siem_hunt"].run(PLANS["siem_events"].run(numbered))
    return out.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query(
    "SELECT CASE WHEN spend > 500 THEN 'VIP' ELSE 'Regular' END AS segment, round(avg(spend), 6) AS avg_spend "
    f"FROM {CUSTOMERS} GROUP BY 1"
)
def sql_segment_avg(spark, d):
    return PLANS["segment_spend"].run(customers(spark, d)).withColumn("avg_spend", F.round("avg_spend", 6))


JOINED_SQL = (
    "SELECT l_orderkey AS sale_id, CAST(l_quantity AS BIGINT) AS amount, o_orderstatus AS orderstatus "
    "FROM lineitem, orders WHERE l_orderkey = o_orderkey"
)


def sales_and_orders(spark, d):
    sold = read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("sale_id"), F.col("l_quantity").cast("long").alias("amount")
    )
    orders = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("orderstatus")
    )
    return sold, orders


@query(JOINED_SQL)
def sql_join(spark, d):
    sold, orders = sales_and_orders(spark, d)
    return PLANS["sales_orders"].run(sold, orders=orders)


JOIN_BUCKETS = 32


@query(JOINED_SQL)
def sql_join_bucketed(spark, d):
    """The same join of two catalog tables that lie in buckets by order: no shuffle."""
    kept = {}
    for name, rows, key in zip(("sales", "orders"), sales_and_orders(spark, d), ("sale_id", "orderkey")):
        path = shared_path(spark, f"bucketed_{name}")
        kept[name] = f"bucketed_{name}_{path[-32:]}"
        save_bucketed(rows, kept[name], [key], JOIN_BUCKETS, path)
    return PLANS["sales_orders"].run(spark.table(kept["sales"]), orders=spark.table(kept["orders"]))


@query(
    "SELECT event_id AS sale_id, CAST(floor(value) AS BIGINT) AS amount, o_orderstatus AS orderstatus "
    "FROM events, orders WHERE event_id = o_orderkey ORDER BY event_id LIMIT 5"
)
def sql_join_sample(spark, d):
    sold = read(spark, d, "events").select(F.col("event_id").alias("sale_id"), F.floor("value").alias("amount"))
    orders = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("orderstatus")
    )
    return PLANS["sales_orders_sample"].run(sold, orders=orders)


@query(f"SELECT event_id AS id, k AS val, k * 2 AS doubled_val FROM {EV}")
def datagen_double(spark, d):
    return PLANS["doubled_values"].run(events(spark, d).select(F.col("event_id").alias("id"), F.col("k").alias("val")))
