"""Lookups, event-time windows and ordered state, as batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.rules import classify
from freshet.operators.clusters import fit_clusters, in_order_of_centres
from freshet.operators.lookups import lookup, member_flag, missing_keys
from freshet.operators.ordered import affine, changed, clamped, halving_fold, latched, ordered_fold, running_count, running_sum
from freshet.operators.ranking import rank_asof
from freshet.operators.windows import windowed
from freshet.plans.catalog import PLANS
from freshet.sources.log import replay
from suite.base import EV, clock, events, query, read, second, shortened, shortened_sql

# Suppliers are the lookup table of the users: they cover some of them.

PROFILES = (
    "(SELECT s_suppkey AS user_id, s_name AS name, CASE WHEN s_acctbal > 5000 THEN 'high' ELSE 'low' END AS risk "
    "FROM supplier)"
)


def profiles(spark, d):
    return read(spark, d, "supplier").select(
        F.col("s_suppkey").alias("user_id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 5000, "high").otherwise("low").alias("risk"),
    )


LOOKUP_SQL = (
    "SELECT user_id, event_id, coalesce(name, 'Unknown') AS name, coalesce(risk, 'unknown') AS risk "
    f"FROM events LEFT JOIN {PROFILES} USING (user_id)"
)


@query(LOOKUP_SQL)
def lookup_default(spark, d):
    clicks = read(spark, d, "events").select("user_id", "event_id")
    return PLANS["click_profiles"].run(clicks, users=profiles(spark, d))


@query(
    "SELECT doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic "
    "FROM documents LEFT JOIN labels USING (doc_id)"
)
def lookup_labels(spark, d):
    documents = read(spark, d, "documents").select("doc_id", "lang")
    return lookup(documents, read(spark, d, "labels"), "doc_id", {"quality": -1, "toxic": 0})


@query(
    "SELECT user_id AS device_id, event_id, k AS temp, CASE WHEN k > coalesce(s_nationkey * 4, 28) THEN 'OVERHEATING' "
    f"ELSE 'NORMAL' END AS alert FROM {EV} LEFT JOIN supplier ON user_id = s_suppkey"
)
def config_threshold(spark, d):
    limits = read(spark, d, "supplier").select(
        F.col("s_suppkey").alias("device_id"), (F.col("s_nationkey") * 4).alias("limit")
    )
    readings = events(spark, d).select(F.col("user_id").alias("device_id"), "event_id", F.col("k").alias("temp"))
    return PLANS["overheating_devices"].run(readings, limits=limits)


@query(
    "SELECT user_id AS item_id, event_id, k % 10 AS demand_index, "
    "coalesce(s_acctbal, 100.0::DOUBLE) * (1 + (k % 10) * 0.05::DOUBLE) AS calculated_price "
    f"FROM {EV} LEFT JOIN supplier ON user_id = s_suppkey"
)
def dynamic_price(spark, d):
    base = read(spark, d, "supplier").select(F.col("s_suppkey").alias("item_id"), F.col("s_acctbal").alias("base_price"))
    demand = events(spark, d).select(F.col("user_id").alias("item_id"), "event_id", (F.col("k") % 10).alias("demand_index"))
    return PLANS["dynamic_prices"].run(demand, base_prices=base)


@query(
    "SELECT user_id AS patient_id, event_id, 50 + k AS bpm, CASE WHEN 50 + k > coalesce(100 + s_nationkey, 120) "
    "THEN 'CRITICAL' WHEN 50 + k > 100 THEN 'ELEVATED' ELSE 'LOW' END AS risk_level "
    f"FROM {EV} LEFT JOIN supplier ON user_id = s_suppkey"
)
def patient_risk(spark, d):
    limits = read(spark, d, "supplier").select(
        F.col("s_suppkey").alias("patient_id"), (F.col("s_nationkey") + 100).alias("max_bpm")
    )
    pulses = events(spark, d).select(F.col("user_id").alias("patient_id"), "event_id", (F.col("k") + 50).alias("bpm"))
    return PLANS["patient_risk"].run(pulses, limits=limits)


@query(
    "SELECT user_id AS truck_id, event_id, event_type AS current_zone, event_type <> coalesce(CASE WHEN s_suppkey IS NULL "
    "THEN NULL WHEN s_nationkey < 8 THEN 'click' WHEN s_nationkey < 16 THEN 'view' ELSE 'error' END, 'transit') AS violation "
    "FROM events LEFT JOIN supplier ON user_id = s_suppkey"
)
def plan_deviation(spark, d):
    zone = F.when(F.col("s_nationkey") < 8, "click").when(F.col("s_nationkey") < 16, "view").otherwise("error")
    planned = read(spark, d, "supplier").select(F.col("s_suppkey").alias("truck_id"), zone.alias("planned_zone"))
    trucks = read(spark, d, "events").select(
        F.col("user_id").alias("truck_id"), "event_id", F.col("event_type").alias("current_zone")
    )
    return PLANS["zone_violations"].run(trucks, planned=planned)


CLAIMED_SQL = (
    "SELECT user_id AS truck_id, event_id, event_type AS current_zone, offered_zone, planned_zone, "
    "event_type <> coalesce(planned_zone, 'transit') AS violation FROM (SELECT *, coalesce(CASE WHEN s_suppkey IS NULL THEN NULL "
    "WHEN s_nationkey < 8 THEN 'click' WHEN s_nationkey < 16 THEN 'view' ELSE 'error' END, "
    "first_value(offered_zone IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)) AS planned_zone "
    f"FROM (SELECT *, CASE WHEN k % 5 = 0 THEN event_type END AS offered_zone FROM {EV}) "
    "LEFT JOIN supplier ON user_id = s_suppkey)"
)


def planned_zones(spark, d):
    zone = F.when(F.col("s_nationkey") < 8, "click").when(F.col("s_nationkey") < 16, "view").otherwise("error")
    return read(spark, d, "supplier").select(F.col("s_suppkey").alias("truck_id"), zone.alias("planned_zone"))


def offered_zones(rows):
    k = F.get_json_object("props", "$.k").cast("int")
    offered = F.when(k % 5 == 0, F.col("event_type")).alias("offered_zone")
    return rows.select(F.col("user_id").alias("truck_id"), "event_id", F.col("event_type").alias("current_zone"), offered)


@query(CLAIMED_SQL)
def plan_first_written(spark, d):
    """Plans that are set by the first record to offer one, unless they were there before."""
    trucks = offered_zones(read(spark, d, "events"))
    return PLANS["claimed_zones"].run(trucks, seq="event_id", planned=planned_zones(spark, d))


@query("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)")
def plan_missing_keys(spark, d):
    return missing_keys(read(spark, d, "events"), profiles(spark, d), "user_id")


@query(
    "SELECT user_id, event_id, user_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 2000) AS listed FROM events",
    name="member_flag",
)
def member_flag_query(spark, d):
    listed = read(spark, d, "supplier").filter("s_acctbal < 2000").select(F.col("s_suppkey").alias("user_id"))
    return member_flag(read(spark, d, "events").select("user_id", "event_id"), listed, "user_id", "listed")


# Windows over the event time: six and twelve hours divide the day.

SIX = 6 * 3600
SIX_START = clock(f"floor(epoch(ts) / {SIX}) * {SIX}")
SIX_END = clock(f"floor(epoch(ts) / {SIX}) * {SIX} + {SIX}")


def shown(df):
    return df.withColumns({c: second(c) for c in ("window_start", "window_end")})


SLIDING_SQL = (
    f"SELECT {clock('s')} AS window_start, {clock(f's + {2 * SIX}')} AS window_end, event_type, "
    f"{shortened_sql('avg(value::DOUBLE)', 6)} AS average_value "
    f"FROM (SELECT *, floor(epoch(ts) / {SIX}) * {SIX} AS s FROM events UNION ALL "
    f"SELECT *, floor(epoch(ts) / {SIX}) * {SIX} - {SIX} AS s FROM events) GROUP BY s, event_type"
)


@query(SLIDING_SQL)
def sliding_avg(spark, d):
    mean = {"average_value": F.avg("value")}
    means = windowed(read(spark, d, "events"), "ts", "12 hours", ["event_type"], mean, slide="6 hours")
    return shortened(shown(means), average_value=6)


TUMBLING_SQL = (
    f"SELECT {SIX_START} AS window_start, {SIX_END} AS window_end, event_type, count(*) AS count "
    "FROM events GROUP BY 1, 2, 3 HAVING count(*) > 15"
)


@query(TUMBLING_SQL)
def tumbling_count(spark, d):
    counts = windowed(read(spark, d, "events"), "ts", "6 hours", ["event_type"], {"count": F.count("*")})
    return shown(counts.filter(F.col("count") > 15))


SURGE_RULES = (("count > 20", 2.0), ("count > 15", 1.5))


@query(
    f"SELECT {SIX_START} AS window_start, {SIX_END} AS window_end, event_type, count(*) AS count, "
    "CASE WHEN count(*) > 20 THEN 2.0::DOUBLE WHEN count(*) > 15 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS multiplier "
    "FROM events GROUP BY 1, 2, 3"
)
def surge_price(spark, d):
    counts = windowed(read(spark, d, "events"), "ts", "6 hours", ["event_type"], {"count": F.count("*")})
    return shown(classify(counts, "multiplier", SURGE_RULES, 1.0))


# The plans' own windows are seconds long, so the events are put on a clock of
# twenty-five of them per second, counted from the first.

TICKS = "(SELECT *, event_id / 25.0::DOUBLE AS t FROM events)"


def ticks(spark, d):
    return read(spark, d, "events").withColumn("timestamp", F.col("event_id") / F.lit(25.0))


@query(
    f"SELECT {clock('floor(t / 10) * 10')} AS window_start, {clock('floor(t / 10) * 10 + 10')} AS window_end, "
    "event_type AS region, count(*) AS count, CASE WHEN count(*) > 50 THEN 2.0::DOUBLE WHEN count(*) > 20 "
    f"THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS multiplier FROM {TICKS} GROUP BY floor(t / 10), event_type"
)
def surge_pricing(spark, d):
    rides = ticks(spark, d).select(F.col("event_type").alias("region"), "timestamp")
    return shown(PLANS["surge_pricing"].run(rides))


@query(
    f"SELECT {clock('s')} AS window_start, {clock('s + 10')} AS window_end, event_type AS symbol, "
    f"avg(floor(value)) AS average_price FROM (SELECT *, floor(t / 5) * 5 AS s FROM {TICKS} UNION ALL "
    f"SELECT *, floor(t / 5) * 5 - 5 AS s FROM {TICKS}) GROUP BY s, event_type"
)
def stock_averages(spark, d):
    stocks = ticks(spark, d).select(F.col("event_type").alias("symbol"), F.floor("value").cast("float").alias("price"), "timestamp")
    return shown(PLANS["stock_averages"].run(stocks))


@query(
    f"SELECT {clock('floor(t / 5) * 5')} AS window_start, {clock('floor(t / 5) * 5 + 5')} AS window_end, source_ip, "
    f"count(*) AS count, 'POSSIBLE DDOS' AS alert FROM (SELECT *, CASE WHEN event_type IN ('click', 'view') "
    f"THEN 'shared' ELSE event_type END AS source_ip FROM {TICKS}) GROUP BY floor(t / 5), source_ip HAVING count(*) > 50"
)
def intrusion_alerts(spark, d):
    address = F.when(F.col("event_type").isin("click", "view"), "shared").otherwise(F.col("event_type"))
    requests = ticks(spark, d).select(address.alias("source_ip"), F.col("timestamp").cast("timestamp").alias("timestamp"))
    return shown(PLANS["intrusion_alerts"].run(requests))


@query(
    f"SELECT {clock('floor(t / 5) * 5')} AS window_start, {clock('floor(t / 5) * 5 + 5')} AS window_end, "
    f"event_type AS tipo, count(*) AS count FROM {TICKS} GROUP BY floor(t / 5), event_type"
)
def periodic_type_count(spark, d):
    typed = ticks(spark, d).select(F.col("event_type").alias("tipo"), F.col("timestamp").cast("timestamp").alias("timestamp"))
    return shown(PLANS["event_type_counts"].run(typed))


# Ordered state.

# A fold of values with two decimals often ends on a 5, so it is not rounded but
# cut at a place that no such value can hit.
FOLD_SQL = (
    "CAST(floor(list_reduce(list(value ORDER BY event_id), lambda a, b: (a + b) / 2) * 1000000 + 0.3::DOUBLE) AS BIGINT) "
    "AS folded_millionths"
)


def millionths(df):
    return df.withColumn("folded_millionths", F.floor(F.col("folded") * 1000000 + 0.3)).drop("folded")


@query(
    "SELECT event_id, user_id, event_type AS category, "
    "count(*) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS enriched_interest FROM events"
)
def running_interest(spark, d):
    views = read(spark, d, "events").select("event_id", "user_id", F.col("event_type").alias("category"))
    return PLANS["interest_profile"].run(views, seq="event_id")


@query("SELECT event_id, event_type AS tag, count(*) OVER (PARTITION BY event_type ORDER BY event_id) AS tag_total FROM events")
def running_tag_total(spark, d):
    posts = read(spark, d, "events").select("event_id", F.col("event_type").alias("tag"))
    return PLANS["tag_totals"].run(posts, seq="event_id")


@query(
    "SELECT event_id, event_type AS tag, count(*) OVER (PARTITION BY event_type ORDER BY event_id) AS tag_total FROM events"
)
def running_tag_total_cut(spark, d):
    """The same with every key cut into blocks, as on hot keys."""
    posts = read(spark, d, "events").select("event_id", F.col("event_type").alias("tag"))
    return running_count(posts, "tag", "event_id", "tag_total", span=100, hot_rows=100)


@query(
    "SELECT event_id, user_id AS card_id, event_type AS country, coalesce(lag(event_type) OVER "
    "(PARTITION BY user_id ORDER BY event_id) <> event_type, false) AS fraud_alert FROM events"
)
def location_change(spark, d):
    cards = read(spark, d, "events").select(
        "event_id", F.col("user_id").alias("card_id"), F.col("event_type").alias("country")
    )
    return PLANS["card_alerts"].run(cards, seq="event_id")


@query(
    "SELECT event_id, user_id, event_type, coalesce(lag(event_type) OVER "
    "(PARTITION BY user_id ORDER BY event_id) <> event_type, false) AS moved FROM events"
)
def location_change_cut(spark, d):
    rows = read(spark, d, "events").select("event_id", "user_id", "event_type")
    return changed(rows, "user_id", "event_id", "event_type", "moved", span=500, hot_rows=60)


@query(f"SELECT event_id, user_id, CAST(sum(k) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS total_score FROM {EV}")
def running_score(spark, d):
    rows = events(spark, d).select("event_id", "user_id", "k")
    return running_sum(rows, "user_id", "event_id", "k", "total_score").drop("k")


RANK_SQL = (
    "WITH s AS (SELECT event_id, CAST(user_id AS VARCHAR) AS player, k AS points, CAST(sum(k) OVER "
    f"(PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS total_score FROM {EV}), "
    "p AS (SELECT DISTINCT player FROM s), "
    "moments AS (SELECT event_id, p.player FROM (SELECT event_id FROM s) e CROSS JOIN p), "
    "held AS (SELECT m.event_id, s.player, s.total_score FROM moments m ASOF JOIN s "
    "ON m.player = s.player AND m.event_id >= s.event_id) "
    "SELECT s.event_id, s.player, s.points, s.total_score, count(*) FILTER (h.total_score > s.total_score OR "
    "(h.total_score = s.total_score AND h.player > s.player)) AS current_rank "
    "FROM s JOIN held h ON s.event_id = h.event_id GROUP BY 1, 2, 3, 4"
)


def players(spark, d):
    return events(spark, d).select("event_id", F.col("user_id").cast("string").alias("player"), F.col("k").alias("points"))


@query(RANK_SQL, name="rank_asof")
def rank_asof_query(spark, d):
    return PLANS["player_ranks"].run(players(spark, d), seq="event_id")


@query(RANK_SQL)
def rank_asof_cut(spark, d):
    """The same with narrow bands, so that all three parts of the count matter."""
    return rank_asof(players(spark, d), "player", "event_id", "points", band=500, hot_rows=50)


@query(
    "SELECT event_id, event_type AS symbol, CAST(floor(value) AS BIGINT) AS price, "
    "CASE WHEN floor(value) < 150 THEN 'BUY' ELSE 'HOLD' END AS action FROM events"
)
def trade_action(spark, d):
    return PLANS["trade_actions"].run(quotes(spark, d))


@query(
    "SELECT -CAST(sum(CASE WHEN floor(value) < 150 THEN CAST(floor(value) AS BIGINT) ELSE 0 END) AS BIGINT) "
    "AS balance_usd FROM events"
)
def trade_balance(spark, d):
    return PLANS["trade_balance"].run(quotes(spark, d))


def quotes(spark, d):
    return read(spark, d, "events").select(
        "event_id", F.col("event_type").alias("symbol"), F.floor("value").alias("price")
    )


def logins(spark, d):
    return read(spark, d, "events").select(
        "event_id",
        F.col("user_id").alias("src_ip"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("status"),
    )


def blacklist(spark, d):
    return read(spark, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("src_ip"))


BLOCKED_SQL = (
    "SELECT event_id, user_id AS src_ip, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS status, "
    "coalesce(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 5 "
    "OR user_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) AS blocked FROM events"
)


@query(BLOCKED_SQL)
def blacklist_latch(spark, d):
    return PLANS["login_blocks"].run(logins(spark, d), seq="event_id", blacklist=blacklist(spark, d))


@query(BLOCKED_SQL)
def blacklist_latch_cut(spark, d):
    failing = F.col("status") == "fail"
    return latched(
        logins(spark, d), "src_ip", "event_id", failing, "blocked", 5, blacklist(spark, d), span=500, hot_rows=60
    )


WORDS_SQL = (
    "SELECT \"offset\", position, word, count(*) OVER (PARTITION BY word ORDER BY \"offset\", position) AS count FROM "
    "(SELECT doc_id AS \"offset\", CAST(generate_subscripts(string_split(text, ' '), 1) - 1 AS INTEGER) AS position, "
    "unnest(string_split(text, ' ')) AS word FROM documents)"
)


@query(WORDS_SQL)
def running_word_count(spark, d):
    texts = read(spark, d, "documents").select(F.col("doc_id").alias("offset"), "text")
    return PLANS["running_word_counts"].run(texts)


@query(f"SELECT user_id, {FOLD_SQL} FROM events GROUP BY user_id")
def pairwise_fold(spark, d):
    folded = halving_fold(read(spark, d, "events"), "user_id", "event_id", "value", "folded")
    return millionths(folded)


@query(f"SELECT user_id, {FOLD_SQL} FROM events GROUP BY user_id")
def pairwise_fold_cut(spark, d):
    folded = halving_fold(read(spark, d, "events"), "user_id", "event_id", "value", "folded", span=300, hot_rows=60)
    return millionths(folded)


# Levels: what each event brings or takes, nulls among them, held between two bounds.
BOUNDS = (0, 120, 10)
CHANGE_SQL = "CASE WHEN k % 4 = 0 THEN NULL ELSE k - 60 END"
CLAMP_SQL = (
    f"CAST(list_reduce(list_prepend({BOUNDS[2]}, list({CHANGE_SQL} ORDER BY event_id) FILTER ({CHANGE_SQL} IS NOT NULL)), "
    f"lambda s, v: least(greatest(s + v, {BOUNDS[0]}), {BOUNDS[1]})) AS BIGINT) AS level"
)


def levels(rows):
    k = F.get_json_object("props", "$.k").cast("int")
    return rows.select("event_id", "user_id", F.when(k % 4 != 0, k - 60).alias("change"))


@query(f"SELECT user_id, {CLAMP_SQL} FROM {EV} GROUP BY user_id")
def fold_clamped(spark, d):
    return ordered_fold(levels(read(spark, d, "events")), "user_id", "event_id", "change", "level", clamped(*BOUNDS))


@query(f"SELECT user_id, {CLAMP_SQL} FROM {EV} GROUP BY user_id")
def fold_clamped_cut(spark, d):
    """The same in blocks of a few dozen rows, their partials folded again and again."""
    rows = levels(read(spark, d, "events"))
    return ordered_fold(rows, "user_id", "event_id", "change", "level", clamped(*BOUNDS), span=40, hot_rows=30)


@query(
    "SELECT user_id, CAST(floor(list_reduce(list_prepend(100.0::DOUBLE, list(value::DOUBLE ORDER BY event_id) "
    "FILTER (event_type <> 'view')), lambda s, v: 0.75 * s + 0.125 * v) * 1000000 + 0.3::DOUBLE) AS BIGINT) AS folded_millionths "
    "FROM events GROUP BY user_id"
)
def fold_affine(spark, d):
    """A level that fades and is fed; views are nulls and feed nothing."""
    fed = F.when(F.col("event_type") != "view", F.col("value"))
    rows = read(spark, d, "events").withColumn("fed", fed)
    return millionths(ordered_fold(rows, "user_id", "event_id", "fed", "folded", affine(0.75, 0.125, 100.0), span=40, hot_rows=30))


@query(
    f"SELECT {SIX_START} AS window_start, {SIX_END} AS window_end, event_type AS sensor, "
    f"{FOLD_SQL} FROM events GROUP BY 1, 2, 3"
)
def windowed_fold(spark, d):
    sensors = read(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("sensor"), F.col("value").alias("temp"), "ts"
    )
    folded = PLANS["sensor_folds"].run(sensors, size="6 hours")
    return millionths(shown(folded))


def as_log(df: DataFrame, key: str, value: str, seq: str, topic: str, partitions: int, **options) -> DataFrame:
    """The records that a topic would hold for these rows: one partition per key, offsets in ``seq`` order.

    ``key`` is an integer column; records of one key share a partition.
    """
    placed = df.withColumn("partition", F.pmod(F.col(key), F.lit(partitions)).cast("int"))
    numbered = running_count(placed, "partition", seq, "_number", **options)
    return numbered.withColumns(
        {
            "key": F.col(key).cast("string").cast("binary"),
            "value": F.col(value).cast("string").cast("binary"),
            "topic": F.lit(topic),
            "offset": F.col("_number") - 1,
        }
    ).drop("_number")


@query(
    "SELECT CAST(user_id % 3 AS INTEGER) AS partition, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 "
    "AS \"offset\", CAST(user_id AS VARCHAR) AS key, props AS value FROM events ORDER BY 1, 2"
)
def log_replay(spark, d):
    log = as_log(read(spark, d, "events"), "user_id", "props", "event_id", "events", 3)
    return replay(log).select("partition", "offset", F.col("key").cast("string"), F.col("value").cast("string"))


@query(
    "SELECT CAST(event_id AS VARCHAR) AS transaction_id, value + 1000000.0::DOUBLE * (event_id % 2) AS amount, "
    f"CAST(k AS DOUBLE) AS distance_km, CAST(event_id % 2 AS INTEGER) AS prediction FROM {EV}"
)
def kmeans_clusters(spark, d):
    """Two clusters that any start separates, numbered by their centres."""
    columns = ["amount", "distance_km"]
    payments = events(spark, d).select(
        F.col("event_id").cast("string").alias("transaction_id"),
        (F.col("value") + F.lit(1000000.0) * (F.col("event_id") % 2)).alias("amount"),
        F.col("k").cast("double").alias("distance_km"),
    )
    model = fit_clusters(payments, columns, k=2, seed=1)
    return in_order_of_centres(model, PLANS["transaction_clusters"].run(payments, model=model))
