"""The same results through Structured Streaming, and through sinks.

Each query streams a whole table into a folder under the shared checkpoint
folder, to its end, and reads that folder back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.operators.aggregates import group_agg
from freshet.operators.decode import decode_changes, living, merged_changes
from freshet.operators.ordered import clamped
from freshet.operators.windows import windowed
from freshet.plans.catalog import PLANS
from freshet.session import configure, shared_path
from freshet.sinks.documents import append_documents, write_documents
from freshet.sinks.tables import append_batch, counted, latest_rows
from freshet.sinks.versions import compact, expire, read_compacted, read_snapshot
from freshet.sources.files import documents, parquet_arrivals, zoned
from freshet.streaming import runs
from freshet.streaming import processors
from freshet.streaming.carried import ordered_fold_batches
from freshet.streaming.late import split_late
from freshet.streaming.state import halving_fold_stream
from suite.base import EV, clock, events, query, read, second, shortened
from suite.grouped import CALLS, SCORES
from suite.keyed import (
    BLOCKED_SQL,
    BOUNDS,
    CLAIMED_SQL,
    CLAMP_SQL,
    FOLD_SQL,
    LOOKUP_SQL,
    RANK_SQL,
    SIX,
    SIX_END,
    SIX_START,
    SLIDING_SQL,
    WORDS_SQL,
    blacklist,
    levels,
    millionths,
    offered_zones,
    planned_zones,
    profiles,
    shown,
)
from suite.projections import CHANGED, FLIGHTS, order_changes


ARRIVALS, ARRIVAL_ROWS = 4, 1_000_000  # micro-batches that a table arrives in: four, and more if they would be larger
FILE_BYTES = 16_000_000  # texts and fields of one file of a micro-batch, as one task reads a file


def arriving(spark, d, name, order=None):
    """A table as a stream of its files.

    The table may be one file, which a stream takes only as a glob. With ``order``
    the table is written again as files that arrive in the order of that column, as
    many to each micro-batch, so state goes from one to the next.
    """
    rows = configure(spark).read.parquet(f"{d}/{name}.parquet")
    if order is None:
        return zoned(parquet_arrivals(spark, f"{d}/{name}.parque[t]", rows.schema))
    folder, parts = arrivals(spark, rows, name, order)
    return zoned(parquet_arrivals(spark, folder, rows.schema, files_per_trigger=parts))


def arrivals(spark, rows, name, order):
    """The folder of a table's files in the order they arrive, and how many make a micro-batch.

    The order is cut into ranges, one file each. Every micro-batch but the last has the same
    number of files, none of them empty, so no file joins the micro-batch before its own.
    The table is dealt to micro-batches once by all tasks; then each is a copy of its own rows.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in rows.schema if f.dataType.typeName() == "string"]
    width = sum(texts, F.lit(8 * len(rows.columns)).cast("long"))
    low, high, size, taken = rows.agg(F.min(order), F.max(order), F.count("*"), F.sum(width)).first()
    turns = max(ARRIVALS, -(-size // ARRIVAL_ROWS))
    parts = max(1, -(-(taken or 0) // (turns * FILE_BYTES)))
    step = -(-((high or 0) - (low or 0) + 1) // (turns * parts))
    dealt = rows.withColumn("_range", F.coalesce(F.floor((F.col(order) - F.lit(low or 0)) / step), F.lit(0)).cast("int"))
    folder, made = shared_path(spark, f"arrivals-{name}"), shared_path(spark, f"turns-{name}")
    ranges = sorted(r[0] for r in dealt.select("_range").distinct().collect())  # at most one for each file
    if not ranges:
        rows.write.parquet(folder)
        return folder, 1
    places = [(r, n // parts, n % parts) for n, r in enumerate(ranges)]
    known = F.broadcast(spark.createDataFrame(places, "_range int, _turn int, _place int"))  # one row for each file
    placed = dealt.join(known, "_range").drop("_range")
    placed.write.partitionBy("_turn").parquet(made)
    kept = placed.drop("_turn").schema
    for n in range(-(-len(ranges) // parts)):
        turn = spark.read.schema(kept).parquet(f"{made}/_turn={n}")
        turn.repartitionById(parts, "_place").drop("_place").write.mode("append").parquet(folder)
    return folder, parts


def through(spark, name, writer):
    """Runs ``writer(path, checkpoint)`` to the end of the data; the path."""
    folder = shared_path(spark, name)
    runs.finish(runs.start(writer(f"{folder}/out", f"{folder}/checkpoint")))
    return f"{folder}/out"


def updates(spark, name, df, keys):
    out = through(spark, name, lambda path, check: runs.to_changes(df, path, check))
    return latest_rows(spark.read.parquet(out), keys)


def appended(spark, name, df):
    out = through(spark, name, lambda path, check: runs.to_changes(df, path, check, "append"))
    return spark.read.parquet(out).drop("batch_id")


def carried(spark, name, plan, stream, **tables):
    """A plan whose state goes from micro-batch to micro-batch, with small blocks."""
    write = lambda path, check: PLANS[plan].write(
        stream, path, check, seq="event_id", span=500, hot_rows=60, **tables
    )
    return spark.read.parquet(through(spark, name, write)).drop("batch_id")


@query(SLIDING_SQL)
def stream_sliding_avg(spark, d):
    stream = arriving(spark, d, "events", "event_id")
    means = windowed(
        stream, "ts", "12 hours", ["event_type"], {"average_value": F.avg("value")}, "6 hours", "1 day"
    )
    return shortened(shown(updates(spark, "sliding", means, ["window_start", "window_end", "event_type"])), average_value=6)


@query(
    f"SELECT {clock('floor(t / 10) * 10')} AS window_start, {clock('floor(t / 10) * 10 + 10')} AS window_end, "
    "event_type AS region, count(*) AS count, CASE WHEN count(*) > 50 THEN 2.0::DOUBLE WHEN count(*) > 20 "
    "THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS multiplier "
    "FROM (SELECT *, event_id / 25.0::DOUBLE AS t FROM events) GROUP BY floor(t / 10), event_type"
)
def stream_surge_pricing(spark, d):
    rides = arriving(spark, d, "events", "event_id").select(
        F.col("event_type").alias("region"), (F.col("event_id") / F.lit(25.0)).alias("timestamp")
    )
    return shown(updates(spark, "surge", PLANS["surge_pricing"].run(rides), ["window_start", "window_end", "region"]))


@query(
    "SELECT event_id, user_id, event_type AS category, "
    "count(*) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS enriched_interest FROM events"
)
def stream_running_interest(spark, d):
    views = arriving(spark, d, "events", "event_id").select("event_id", "user_id", F.col("event_type").alias("category"))
    return appended(spark, "interest", PLANS["interest_profile"].run(views, seq="event_id"))


@query(
    "SELECT event_id, event_type AS tag, count(*) OVER (PARTITION BY event_type ORDER BY event_id) AS tag_total FROM events"
)
def stream_tag_totals(spark, d):
    """State carried between micro-batches, the few hot tags cut into blocks."""
    posts = arriving(spark, d, "events", "event_id").select("event_id", F.col("event_type").alias("tag"))
    return carried(spark, "tags", "tag_totals", posts)


@query(
    "SELECT event_id, user_id AS card_id, event_type AS country, coalesce(lag(event_type) OVER "
    "(PARTITION BY user_id ORDER BY event_id) <> event_type, false) AS fraud_alert FROM events"
)
def stream_location_change(spark, d):
    cards = arriving(spark, d, "events", "event_id").select(
        "event_id", F.col("user_id").alias("card_id"), F.col("event_type").alias("country")
    )
    return appended(spark, "cards", PLANS["card_alerts"].run(cards, seq="event_id"))


def login_stream(spark, d):
    return arriving(spark, d, "events", "event_id").select(
        "event_id",
        F.col("user_id").alias("src_ip"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("status"),
    )


@query(BLOCKED_SQL)
def stream_blacklist_latch(spark, d):
    blocked = PLANS["login_blocks"].run(login_stream(spark, d), seq="event_id", blacklist=blacklist(spark, d))
    return appended(spark, "logins", blocked)


@query(BLOCKED_SQL)
def stream_blacklist_carried(spark, d):
    return carried(spark, "blocked", "login_blocks", login_stream(spark, d), blacklist=blacklist(spark, d))


@query(f"SELECT user_id, {FOLD_SQL} FROM events GROUP BY user_id")
def stream_pairwise_fold(spark, d):
    rows = arriving(spark, d, "events", "event_id").select("event_id", "user_id", "value")
    steps = appended(spark, "fold", halving_fold_stream(rows, ["user_id"], "event_id", "value", "folded"))
    last = steps.groupBy("user_id").agg(F.max_by("folded", "event_id").alias("folded"))
    return millionths(last)


@query(LOOKUP_SQL)
def stream_lookup_default(spark, d):
    clicks = arriving(spark, d, "events").select("user_id", "event_id")
    return appended(spark, "clicks", PLANS["click_profiles"].run(clicks, users=profiles(spark, d)))


@query(
    "SELECT *, CASE WHEN engine_temp > 900 THEN 'CRITICAL' WHEN fuel_level < 20 THEN 'LOW_FUEL' ELSE 'NORMAL' END "
    f"AS status FROM {FLIGHTS}"
)
def stream_aviation_archive(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    flights = arriving(spark, d, "events").select(
        "event_id", (k * 6 + 400).alias("engine_temp"), F.floor("value").cast("int").alias("fuel_level")
    )
    status = PLANS["aviation_status"].run(flights)
    return spark.read.parquet(through(spark, "flights", lambda path, check: runs.to_archive(status, path, check)))


@query(f"SELECT * FROM {SCORES}")
def stream_leaderboard(spark, d):
    scores = arriving(spark, d, "events", "event_id").select(
        F.col("user_id").cast("string").alias("player_id"), F.get_json_object("props", "$.k").cast("int").alias("score")
    )
    plan = PLANS["leaderboard"]
    return spark.read.parquet(through(spark, "scores", lambda path, check: plan.write(scores, path, check)))


@query("SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def stream_running_totals(spark, d):
    counts = group_agg(arriving(spark, d, "events", "event_id"), "user_id", count=F.count("*"))
    return updates(spark, "totals", counts, ["user_id"])


@query(
    "SELECT tower_id, count(call_id) AS total_calls, count(*) FILTER (status = 'DROP') AS dropped_calls, "
    f"CAST(count(*) FILTER (status = 'DROP') AS DOUBLE) / count(call_id) AS drop_rate FROM {CALLS} GROUP BY 1 "
    "HAVING CAST(count(*) FILTER (status = 'DROP') AS DOUBLE) / count(call_id) > 0.1"
)
def stream_poll_statistics(spark, d):
    """Each poll's files are aggregated alone; here all files are one poll."""
    calls = arriving(spark, d, "events").select(
        F.col("event_id").alias("call_id"),
        F.col("user_id").alias("tower_id"),
        F.when(F.col("event_type") == "error", "DROP").otherwise("OK").alias("status"),
    )
    plan = PLANS["bad_towers"]
    out = through(spark, "calls", lambda path, check: plan.write(calls, path, check))
    return spark.read.parquet(out).drop("batch_id")


@query(
    "SELECT 'archive' AS sink, event_type, count(*) AS rows FROM events GROUP BY 2 UNION ALL "
    "SELECT 'documents' AS sink, event_type, count(*) AS rows FROM events WHERE value > 200 GROUP BY 2"
)
def stream_fan_out(spark, d):
    """One stream, two sinks, each micro-batch computed once."""
    folder = shared_path(spark, "fan")
    rows = arriving(spark, d, "events").select("event_id", "event_type", "value")
    both = runs.fan_out(
        lambda batch, n: append_batch(batch, f"{folder}/archive", n),
        lambda batch, n: append_documents(batch.filter("value > 200"), folder, "alerts", n),
    )
    runs.finish(runs.start(runs.to_batches(rows, both, f"{folder}/checkpoint")))
    kept = spark.read.parquet(f"{folder}/archive").select(F.lit("archive").alias("sink"), "event_type")
    alerts = documents(spark, folder, "alerts", rows.schema).select(F.lit("documents").alias("sink"), "event_type")
    return kept.union(alerts).groupBy("sink", "event_type").agg(F.count("*").alias("rows"))


@query(f"SELECT event_type, count(*) AS rows, CAST(sum(k) AS BIGINT) AS total FROM {EV} GROUP BY 1")
def sink_count(spark, d):
    """Rows written as nested documents, read back and counted."""
    root = shared_path(spark, "index")
    rows = events(spark, d).select("event_id", "event_type", F.struct("k").alias("parsed_data"))
    write_documents(rows, root, "events")
    back = documents(spark, root, "events", rows.schema, view="indexed_events")
    return back.groupBy("event_type").agg(F.count("*").alias("rows"), F.sum("parsed_data.k").alias("total"))


@query(f"SELECT count(*) AS rows, count(*) FILTER (k > 50) AS large, CAST(sum(k) AS BIGINT) AS total FROM {EV}")
def sink_count_on_the_way(spark, d):
    """Rows written and counted in one pass, nothing read back."""
    root = shared_path(spark, "index")
    seen = counted(
        events(spark, d).select("event_id", "k"),
        lambda rows: write_documents(rows, root, "events"),
        large=F.count_if(F.col("k") > 50),
        total=F.sum("k"),
    )
    return spark.createDataFrame([(seen["rows"], seen["large"], seen["total"])], "rows long, large long, total long")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_archive_compacted(spark, d):
    """An archive whose micro-batches are compacted as they settle, what is no longer needed deleted."""
    folder = shared_path(spark, "compacted")
    rows = arriving(spark, d, "events", "event_id").select("event_id", "user_id", "event_type", "value")

    def each(batch, n):
        append_batch(batch, f"{folder}/archive", n)
        compact(spark, f"{folder}/archive", f"{folder}/table", n - 1, ["user_id"], fan=2, file_rows=ARRIVAL_ROWS)
        expire(spark, f"{folder}/archive", f"{folder}/table")

    runs.finish(runs.start(runs.to_batches(rows, each, f"{folder}/checkpoint")))
    return read_compacted(spark, f"{folder}/archive", f"{folder}/table").drop("batch_id")


@query("SELECT event_type, count(*) AS rows, CAST(sum(k) AS BIGINT) AS total FROM " + EV + " GROUP BY 1")
def stream_snapshot_versions(spark, d):
    """Whole results, a version per micro-batch, of which readers see the newest."""
    k = F.get_json_object("props", "$.k").cast("long")
    rows = arriving(spark, d, "events", "event_id")
    totals = group_agg(rows, "event_type", rows=F.count("*"), total=F.sum(k))
    return read_snapshot(spark, through(spark, "versions", lambda path, check: runs.to_versions(totals, path, check)))


# One row in eleven arrives a file late.
LATE_FILE = "least({files} - 1, event_id * {files} div {size} + if(event_id % 11 = 0, 1, 0))"
LATE_SQL = (
    f"WITH s AS (SELECT count(*) AS size, greatest({ARRIVALS}, CAST(ceil(count(*) / {ARRIVAL_ROWS}.0) AS BIGINT)) AS files FROM events), "
    "a AS (SELECT event_id, epoch_us(ts) AS us, least(files - 1, event_id * files // size + CASE WHEN event_id % 11 = 0 "
    "THEN 1 ELSE 0 END) AS file FROM events, s), m AS (SELECT file, max(max(us)) OVER (ORDER BY file ROWS BETWEEN "
    "UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000000 AS mark FROM a GROUP BY file) "
    "SELECT event_id, coalesce(us < mark, false) AS late, CASE WHEN us < mark THEN mark - us END AS late_by_us FROM a JOIN m USING (file)"
)


@query(LATE_SQL)
def stream_late_rows(spark, d):
    """Rows behind the watermark, kept apart with their lateness; with the others they are the whole input."""
    events = read(spark, d, "events").select("event_id", "ts")
    size = events.count()
    files = max(ARRIVALS, -(-size // ARRIVAL_ROWS))
    folder = shared_path(spark, "late")
    turn = F.expr(LATE_FILE.format(files=files, size=max(1, size)))
    for n in range(files):
        events.filter(turn == n).coalesce(1).write.mode("append").parquet(f"{folder}/in")  # of bounded size
    stream = parquet_arrivals(spark, f"{folder}/in", events.schema, files_per_trigger=1)
    parted = split_late(
        "ts", "1 day", f"{folder}/mark",
        lambda batch, n: append_batch(batch, f"{folder}/on_time", n),
        lambda batch, n: append_batch(batch, f"{folder}/late", n),
    )
    runs.finish(runs.start(runs.to_batches(stream, parted, f"{folder}/checkpoint")))
    back = spark.read.schema("event_id long, late_by_us long")  # there may be no late row
    on_time = back.parquet(f"{folder}/on_time").select("event_id", F.lit(False).alias("late"))
    late = back.parquet(f"{folder}/late").select("event_id", F.lit(True).alias("late"), "late_by_us")
    return on_time.unionByName(late, allowMissingColumns=True)


@query("SELECT event_type AS level, count(*) AS count FROM events GROUP BY 1")
def sql_over_documents(spark, d):
    root = shared_path(spark, "logs")
    logs = read(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("level"))
    write_documents(logs, root, "server_logs")
    return PLANS["log_levels"].run(documents(spark, root, "server_logs", logs.schema, view="logs"))


def player_stream(spark, d):
    return arriving(spark, d, "events", "event_id").select(
        "event_id",
        F.col("user_id").cast("string").alias("player"),
        F.get_json_object("props", "$.k").cast("int").alias("points"),
    )


@query(RANK_SQL)
def stream_rank_asof(spark, d):
    """Ranks from counts in keyed state: a micro-batch reads and changes only the bands it falls in."""
    write = lambda path, check: PLANS["player_ranks"].write(
        player_stream(spark, d), path, check, keyed_state=True, seq="event_id"
    )
    return spark.read.parquet(through(spark, "ranks", write)).drop("batch_id")


@query(RANK_SQL)
def stream_rank_carried(spark, d):
    """Ranks on micro-batches, with the totals before each carried along."""
    write = lambda path, check: PLANS["player_ranks"].write(player_stream(spark, d), path, check, seq="event_id")
    return spark.read.parquet(through(spark, "ranks", write)).drop("batch_id")


@query("SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word")
def stream_word_count(spark, d):
    plan = PLANS["word_counts"]
    texts = arriving(spark, d, "documents", "doc_id").select("text")
    return spark.read.parquet(through(spark, "words", lambda path, check: plan.write(texts, path, check)))


@query(
    f"SELECT event_type AS sensor, {SIX_START} AS window_start, {SIX_END} AS window_end, {FOLD_SQL} FROM events "
    f"WHERE floor(epoch(ts) / {SIX}) < (SELECT floor(epoch(max(ts)) / {SIX}) FROM events) GROUP BY 1, 2, 3"
)
def stream_windowed_fold(spark, d):
    """Folds of the windows the watermark has closed: all but the newest."""
    rows = arriving(spark, d, "events", "event_id").select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("sensor"), F.col("value").alias("temp"), "ts"
    )
    return millionths(shown(appended(spark, "folds", PLANS["sensor_folds"].run(rows, size="6 hours"))))


@query(WORDS_SQL)
def stream_running_word_count(spark, d):
    """Every word with its count so far, the counts held in keyed state."""
    texts = arriving(spark, d, "documents", "doc_id").select(F.col("doc_id").alias("offset"), "text")
    return appended(spark, "running-words", PLANS["running_word_counts"].run(texts))


@query(BLOCKED_SQL)
def stream_seeded_latch(spark, d):
    """The blocklist is the first state of the stream, and is joined with no micro-batch."""
    rows = login_stream(spark, d).withColumn("failing", F.col("status") == "fail")
    return appended(spark, "latch", processors.latched(rows, "src_ip", "event_id", "failing", "blocked", 5, blacklist(spark, d)))


@query(CLAIMED_SQL)
def stream_plan_deviation(spark, d):
    """Plans that are set by the first record to offer one, unless they were there before."""
    trucks = offered_zones(arriving(spark, d, "events", "event_id"))
    plan = PLANS["claimed_zones"]
    return appended(spark, "zones", plan.run(trucks, seq="event_id", planned=planned_zones(spark, d)))


@query(f"SELECT user_id, {CLAMP_SQL} FROM {EV} GROUP BY user_id")
def stream_fold_clamped(spark, d):
    """A level held between two bounds, its partial carried from micro-batch to micro-batch."""
    rows = levels(arriving(spark, d, "events", "event_id"))
    fold = clamped(*BOUNDS)
    write = lambda path, check: runs.to_batches(
        rows,
        ordered_fold_batches(
            "user_id", "event_id", "change", "level", fold, f"{check}-carried", lambda b, n: append_batch(b, path, n), span=300, hot_rows=60
        ),
        check,
    )
    return latest_rows(spark.read.parquet(through(spark, "levels", write)), ["user_id"])


@query(
    f"SELECT event_type, {SIX_END} AS window_end, CAST(sum(k) AS BIGINT) AS total FROM {EV} "
    f"WHERE floor(epoch(ts) / {SIX}) < (SELECT floor(epoch(max(ts)) / {SIX}) FROM events) GROUP BY 1, 2"
)
def stream_window_totals(spark, d):
    """Totals that timers give out once the watermark has closed their window."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = arriving(spark, d, "events", "event_id").select("event_type", "ts", k.alias("k"))
    sums = processors.windowed_totals(rows, "event_type", "ts", 6 * 3600 * 1000, "k", "total", "0 seconds")
    made = appended(spark, "window-totals", sums)
    return made.select("event_type", second("window_end"), F.col("total").cast("long").alias("total"))


def change_stream(spark, d):
    """The log of changes as it arrives out of order: by hash, the second half of it twice."""
    folder = shared_path(spark, "change-log")
    log = order_changes(spark, d).select("offset", F.col("value").cast("string").alias("value"))
    # Made once by all tasks; then each turn is a copy of its own rows, in as many files as any other.
    turn = F.pmod(F.xxhash64("offset"), F.lit(ARRIVALS))
    made = shared_path(spark, "change-turns")
    log.withColumn("turn", turn).write.partitionBy("turn").parquet(made)
    turns = spark.read.schema("offset long, value string, turn int").parquet(made)
    width = F.sum(8 + F.coalesce(F.octet_length("value"), F.lit(0))).alias("width")
    parts = max(1, -(-(turns.groupBy("turn").agg(width).agg(F.max("width")).first()[0] or 0) // FILE_BYTES))
    for n in (2, 0, 3, 1, 3):  # late and doubled
        own = turns.filter(F.col("turn") == n).drop("turn").withColumn("_place", F.expr(f"int(monotonically_increasing_id() % {parts})"))
        own.repartitionById(parts, "_place").drop("_place").write.mode("append").parquet(folder)
    return parquet_arrivals(spark, folder, log.schema, files_per_trigger=parts)


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'")
def stream_cdc_current(spark, d):
    """States folded in keyed state; the micro-batches' deltas are merged with tombstones."""
    changes = decode_changes(change_stream(spark, d), CHANGED)
    deltas = appended(spark, "cdc", processors.newest_changes(changes, "id", ["ts", "offset"]))
    return living(merged_changes(deltas.limit(0), deltas))
