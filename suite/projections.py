"""Decoding, scalar columns, rules, text, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.functions.scalars import epoch_to_ts, iso_to_ts, safe_ratio
from freshet.functions.text import lexicon_label
from freshet.operators.decode import (
    current_rows,
    decode_changes,
    decode_json,
    encode_json,
    living,
    merged_changes,
    newest_states,
    row_versions,
)
from freshet.plans import values as V
from freshet.plans.catalog import PLANS
from freshet.schemas import schema
from suite.base import COUNTER, EV, events, query, read

# A small scored word list; it stands for whatever list the user brings.
LEXICON = {"best": 1.0, "worthless": -0.8, "the": 0.05, "de": -0.05}


@query("SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_decode(spark, d):
    return decode_json(read(spark, d, "events"), COUNTER, "props", keep=["event_id"])


@query(
    "SELECT event_id, event_type, CAST(props->>'$.k' AS INTEGER) AS parsed_k, "
    "'{\"k\":' || (props->>'$.k') || '}' AS parsed_data FROM events"
)
def json_nested(spark, d):
    whole = decode_json(read(spark, d, "events"), COUNTER, "props", nested="parsed_data")
    return whole.select(
        "event_id", "event_type", F.col("parsed_data.k").alias("parsed_k"), F.to_json("parsed_data").alias("parsed_data")
    )


@query(
    "SELECT event_id, CAST(k AS INTEGER) AS k, event_type AS kind, event_id AS second, "
    """'{"k":' || k || ',"kind":"' || event_type || '","seen":[' || user_id || ',' || event_id || ']}' AS parsed_data """
    f"FROM {EV}"
)
def json_whole(spark, d):
    """A payload with fields that its schema does not declare."""
    text = F.format_string('{"kind": "%s", "seen": [%d, %d], "k": %d}', "event_type", "user_id", "event_id", "k")
    whole = decode_json(events(spark, d).withColumn("payload", text), COUNTER, "payload", nested="p", whole=True)
    return whole.select(
        "event_id",
        F.variant_get("p", "$.k", "int").alias("k"),
        F.variant_get("p", "$.kind", "string").alias("kind"),
        F.variant_get("p", "$.seen[1]", "bigint").alias("second"),
        F.to_json("p").alias("parsed_data"),
    )


@query(
    "SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 500 MILLISECONDS, '%Y-%m-%d %H:%M:%S.%f') AS at "
    "FROM events",
    name="epoch_to_ts",
)
def epoch_to_ts_query(spark, d):
    seconds = F.unix_seconds("ts").cast("double") + 0.5
    return read(spark, d, "events").select(
        "event_id", F.date_format(epoch_to_ts(seconds), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    )


@query("SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M:%S.%f') AS at, hour(ts) AS hour FROM events", name="iso_to_ts")
def iso_to_ts_query(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    parsed = read(spark, d, "events").select("event_id", iso_to_ts(text).alias("t"))
    return parsed.select(
        "event_id", F.date_format("t", "dd/MM/yyyy HH:mm:ss.SSSSSS").alias("at"), F.hour("t").alias("hour")
    )


FLIGHTS = f"(SELECT event_id, 400 + k * 6 AS engine_temp, CAST(floor(value) AS INTEGER) AS fuel_level FROM {EV})"


def flights(spark, d):
    return events(spark, d).select(
        "event_id", (F.col("k") * 6 + 400).alias("engine_temp"), F.floor("value").cast("int").alias("fuel_level")
    )


@query(
    "SELECT *, CASE WHEN engine_temp > 900 THEN 'CRITICAL' WHEN fuel_level < 20 THEN 'LOW_FUEL' ELSE 'NORMAL' END "
    f"AS status FROM {FLIGHTS}"
)
def case_aviation(spark, d):
    return PLANS["aviation_status"].run(flights(spark, d))


@query(f"SELECT * FROM {FLIGHTS} WHERE engine_temp > 850")
def aviation_overheat(spark, d):
    return PLANS["aviation_overheat"].run(flights(spark, d))


VITALS = (
    "(SELECT event_id, 50 + k AS heart_rate, CAST(90 + floor(value / 5) AS INTEGER) AS systolic_bp, "
    f"80 + k % 21 AS spo2 FROM {EV})"
)


def vitals(spark, d):
    return events(spark, d).select(
        "event_id",
        (F.col("k") + 50).alias("heart_rate"),
        (F.floor(F.col("value") / 5) + 90).cast("int").alias("systolic_bp"),
        (F.col("k") % 21 + 80).alias("spo2"),
    )


@query(
    "SELECT *, CASE WHEN spo2 < 90 OR heart_rate > 130 THEN 'CRITICAL' WHEN systolic_bp > 160 THEN 'WARNING' "
    f"ELSE 'NORMAL' END AS status FROM {VITALS}"
)
def case_vitals(spark, d):
    return PLANS["vitals_status"].run(vitals(spark, d))


@query(f"SELECT *, 'CRITICAL' AS status FROM {VITALS} WHERE spo2 < 90 OR heart_rate > 120")
def vitals_critical(spark, d):
    return PLANS["vitals_critical"].run(vitals(spark, d))


GRID = f"(SELECT event_id, 100 + k * 2 AS voltage FROM {EV})"


def grid(spark, d):
    return events(spark, d).select("event_id", (F.col("k") * 2 + 100).alias("voltage"))


@query(f"SELECT *, CASE WHEN voltage > 240 OR voltage < 110 THEN 'ANOMALY' ELSE 'NORMAL' END AS status FROM {GRID}")
def case_grid(spark, d):
    return PLANS["grid_status"].run(grid(spark, d))


@query(f"SELECT * FROM {GRID} WHERE voltage > 240 OR voltage < 110")
def grid_anomalies(spark, d):
    return PLANS["grid_anomalies"].run(grid(spark, d))


CLAIMS = f"(SELECT event_id, CAST(floor(value * 500) AS INTEGER) AS amount, k % 15 AS policy_age FROM {EV})"
RISK = "CASE WHEN amount > 50000 AND policy_age < 1 THEN 'HIGH' WHEN amount > 70000 THEN 'MEDIUM' ELSE 'LOW' END"


def claims(spark, d):
    return events(spark, d).select(
        "event_id", F.floor(F.col("value") * 500).cast("int").alias("amount"), (F.col("k") % 15).alias("policy_age")
    )


@query(f"SELECT *, {RISK} AS risk FROM {CLAIMS}")
def case_risk(spark, d):
    return PLANS["claim_risk"].run(claims(spark, d))


@query(f"SELECT *, 'HIGH' AS risk FROM {CLAIMS} WHERE {RISK} = 'HIGH'")
def label_filter(spark, d):
    return PLANS["high_risk_claims"].run(claims(spark, d))


CUSTOMERS = (
    "(SELECT c_custkey AS id, CAST(floor(c_acctbal / 10) AS BIGINT) AS spend, CAST(c_nationkey AS BIGINT) AS visits "
    "FROM customer)"
)


def customers(spark, d):
    return read(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.floor(F.col("c_acctbal") / 10).alias("spend"),
        F.col("c_nationkey").cast("long").alias("visits"),
    )


@query(f"SELECT *, CASE WHEN spend > 500 THEN 'VIP' ELSE 'Regular' END AS segment FROM {CUSTOMERS}")
def case_segment(spark, d):
    return PLANS["customer_segments"].run(customers(spark, d))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / (l_quantity / 1000) AS efficiency FROM lineitem")
def derived_ratio(spark, d):
    ratio = safe_ratio("l_extendedprice", F.col("l_quantity") / 1000)
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ratio.alias("efficiency"))


@query(
    "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, "
    "CASE WHEN event_id % 10 = 0 THEN 'MALICIOUS' ELSE 'NORMAL' END AS event_type, "
    "'192.168.1.1' AS src_ip, event_id AS id FROM events"
)
def siem_label(spark, d):
    numbered = read(spark, d, "events").select(F.col("ts").alias("timestamp"), F.col("event_id").alias("value"))
    out = PLANS["siem_events"].run(numbered)
    return out.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "SELECT event_id AS id, 'ALERT: High value transaction ' || event_id || ' detected: $' || amount AS message "
    "FROM (SELECT event_id, floor(value * 100) * 1000 AS amount FROM events) WHERE amount > 10000"
)
def alert_message(spark, d):
    payments = read(spark, d, "events").select(
        F.col("event_id").alias("id"), (F.floor(F.col("value") * 100) * 1000).cast("double").alias("amount")
    )
    return PLANS["high_value_alerts"].run(payments)


def _any(words):
    return " OR ".join(f"contains(lower(text), '{w}')" for w in words)


@query(
    f"SELECT doc_id, CASE WHEN {_any(V.POSITIVE_WORDS)} THEN 'POSITIVO' "
    f"WHEN {_any(V.NEGATIVE_WORDS)} THEN 'NEGATIVO' ELSE 'NEUTRO' END AS sentiment FROM documents"
)
def keyword_sentiment(spark, d):
    return PLANS["comment_keywords"].run(read(spark, d, "documents").select("doc_id", "text")).drop("text")


SENTIMENT_SQL = (
    "WITH lexicon(word, score) AS (VALUES "
    + ", ".join(f"('{w}', {s}::DOUBLE)" for w, s in LEXICON.items())
    + "), words AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents), "
    "means AS (SELECT doc_id, round(avg(score), 6) AS polarity FROM words JOIN lexicon USING (word) GROUP BY doc_id) "
    "SELECT doc_id, coalesce(polarity, 99) AS polarity, CASE WHEN polarity > 0.1 THEN 'POSITIVE' "
    "WHEN polarity < -0.1 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment FROM documents LEFT JOIN means USING (doc_id)"
)


def _shown(df):
    return df.select("doc_id", F.coalesce(F.round("polarity", 6), F.lit(99.0)).alias("polarity"), "sentiment")


@query(SENTIMENT_SQL)
def lexicon_sentiment(spark, d):
    documents = read(spark, d, "documents")
    words = spark.createDataFrame(list(LEXICON.items()), "word string, score double")
    return _shown(lexicon_label(documents, "doc_id", "text", words))


@query(SENTIMENT_SQL)
def comment_sentiment(spark, d):
    return _shown(PLANS["comment_sentiment"].run(read(spark, d, "documents").select("doc_id", "text"), lexicon=LEXICON))


@query("SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word")
def word_count(spark, d):
    return PLANS["word_counts"].run(read(spark, d, "documents"))


@query(
    "SELECT CAST(user_id AS VARCHAR) AS key, '{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || "
    "'\",\"value\":' || value || '}' AS value FROM events"
)
def publish_encode(spark, d):
    return encode_json(read(spark, d, "events"), "user_id", ["event_id", "event_type", "value"])


@query("SELECT event_id, event_type, value FROM events WHERE value > 200")
def filter_gt(spark, d):
    return read(spark, d, "events").select("event_id", "event_type", "value").filter(F.col("value") > 200)


@query(f"SELECT event_id, k FROM {EV} WHERE k > 80 OR k < 10")
def range_violation(spark, d):
    return events(spark, d).filter((F.col("k") > 80) | (F.col("k") < 10)).select("event_id", "k")


# Every order as change events: inserted as O, then updated to its status; an
# order whose status is P is deleted again.
def order_changes(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.unix_millis("o_orderdate").alias("at"))
    row = lambda status: F.struct(F.col("o_orderkey").alias("id"), status.alias("status"))
    none = F.lit(None).cast("struct<id: bigint, status: string>")
    steps = F.array(
        F.struct(F.lit("c").alias("op"), none.alias("before"), row(F.lit("O")).alias("after"), F.col("at").alias("ts")),
        F.struct(
            F.lit("u").alias("op"),
            row(F.lit("O")).alias("before"),
            row(F.col("o_orderstatus")).alias("after"),
            (F.col("at") + 1000).alias("ts"),
        ),
        F.struct(
            F.when(F.col("o_orderstatus") == "P", "d").otherwise("u").alias("op"),
            row(F.col("o_orderstatus")).alias("before"),
            F.when(F.col("o_orderstatus") != "P", row(F.col("o_orderstatus"))).alias("after"),
            (F.col("at") + 1000).alias("ts"),
        ),
    )
    changes = orders.select("o_orderkey", F.posexplode(steps).alias("step", "change"))
    return changes.select(
        (F.col("o_orderkey") * 3 + F.col("step")).alias("offset"), F.to_json("change").alias("value")
    )


CHANGED = schema(id="long", status="string")


@query(
    "WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS st, epoch_ms(o_orderdate) AS ms FROM orders) "
    "SELECT id * 3 AS \"offset\", 'c' AS op, -1 AS before_id, 'none' AS before_status, id AS after_id, "
    "'O' AS after_status, ms AS ts FROM o "
    "UNION ALL SELECT id * 3 + 1, 'u', id, 'O', id, st, ms + 1000 FROM o "
    "UNION ALL SELECT id * 3 + 2, CASE WHEN st = 'P' THEN 'd' ELSE 'u' END, id, st, "
    "CASE WHEN st = 'P' THEN -1 ELSE id END, CASE WHEN st = 'P' THEN 'none' ELSE st END, ms + 1000 FROM o"
)
def cdc_decode(spark, d):
    shown = decode_changes(order_changes(spark, d), CHANGED)
    ids = [F.coalesce(F.col(f"{side}.id"), F.lit(-1)).alias(f"{side}_id") for side in ("before", "after")]
    states = [F.coalesce(F.col(f"{s}.status"), F.lit("none")).alias(f"{s}_status") for s in ("before", "after")]
    return shown.select("offset", "op", *ids, *states, "ts")


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'")
def cdc_current(spark, d):
    return current_rows(decode_changes(order_changes(spark, d), CHANGED), "id", ["ts", "offset"])


VERSIONS_SQL = (
    "WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS st, epoch_ms(o_orderdate) AS ms FROM orders), "
    "c AS (SELECT id * 3 AS n, 'u' AS op, id, 'O' AS status, ms AS ts FROM o "
    "UNION ALL SELECT id * 3 + 1, 'u', id, st, ms + 1000 FROM o "
    "UNION ALL SELECT id * 3 + 2, CASE WHEN st = 'P' THEN 'd' ELSE 'u' END, id, st, ms + 1000 FROM o), "
    "v AS (SELECT *, lead(ts) OVER (PARTITION BY id ORDER BY ts, n) AS valid_to FROM c) "
    "SELECT id, status, ts AS valid_from, valid_to FROM v WHERE op <> 'd'"
)


def doubled_changes(spark, d):
    """The changes, every second one delivered twice."""
    log = order_changes(spark, d)
    return decode_changes(log.union(log.filter("offset % 2 = 0")), CHANGED)


@query(VERSIONS_SQL)
def cdc_versions(spark, d):
    return row_versions(doubled_changes(spark, d), "id", ["ts", "offset"])


@query(VERSIONS_SQL)
def cdc_versions_cut(spark, d):
    """The same with every key cut into blocks of rows."""
    return row_versions(doubled_changes(spark, d), "id", ["ts", "offset"], span=2000, hot_rows=2)


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'")
def cdc_merged(spark, d):
    """A base of the first changes and two overlapping deltas, compacted."""
    changes = decode_changes(order_changes(spark, d), CHANGED)
    states = newest_states(changes, "id", ["ts", "offset"])
    parts = [newest_states(changes.filter(c), "id", ["ts", "offset"]) for c in ("offset % 3 = 0", "offset % 3 > 0")]
    return living(merged_changes(merged_changes(parts[0], parts[1]), states))
