"""A user's own functions: of rows, of rows in SQL, of groups, and table functions.

The functions are defined inside the queries, so they travel with them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.operators.custom import apply_batches, apply_groups, flat_rows, fold_groups, row_function
from suite.base import query, read

BANDS = (10.0, 50.0, 100.0, 200.0)  # of values, upper ends outside
BAND_SQL = "CASE " + " ".join(f"WHEN value < {b}::DOUBLE THEN {i}" for i, b in enumerate(BANDS)) + f" ELSE {len(BANDS)} END"


def band_function():
    import numpy as np

    bands = np.array(BANDS)

    def band(value):
        return np.searchsorted(bands, value.to_numpy(), side="right")

    return row_function(band, "int")


@query(f"SELECT event_id, {BAND_SQL} AS band FROM events WHERE value IS NOT NULL")
def custom_row_label(spark, d):
    rows = read(spark, d, "events").filter("value IS NOT NULL")
    return rows.select("event_id", band_function()("value").alias("band"))


@query(f"SELECT event_type, band, count(*) AS count FROM (SELECT event_type, {BAND_SQL} AS band FROM events WHERE value IS NOT NULL) GROUP BY 1, 2")
def custom_row_label_in_sql(spark, d):
    read(spark, d, "events").createOrReplaceTempView("custom_events")
    spark.udf.register("value_band", band_function())
    return spark.sql(
        "SELECT event_type, band, count(*) AS count FROM "
        "(SELECT event_type, value_band(value) AS band FROM custom_events WHERE value IS NOT NULL) GROUP BY 1, 2"
    )


@query(
    "SELECT user_id, count(*) AS events, coalesce(max(value, 2)[2], max(value)) AS second_highest, "
    "CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) / count(*) AS click_rate FROM events GROUP BY user_id"
)
def custom_group_fold(spark, d):
    """The second highest value and the share of clicks of each user, from parts that merge."""

    def part(rows):
        two = rows["value"].dropna().nlargest(2).tolist() + [None, None]
        return len(rows), int((rows["event_type"] == "click").sum()), two[0], two[1]

    def merge(states):
        both = sorted((v for c in ("first", "second") for v in states[c] if v is not None), reverse=True)
        two = both[:2] + [None, None]
        return int(states["events"].sum()), int(states["clicks"].sum()), two[0], two[1]

    return fold_groups(
        read(spark, d, "events"), "user_id", ["value", "event_type"], part, merge,
        "events long, clicks long, first double, second double",
        events=F.col("events"),
        second_highest=F.coalesce("second", "first"),
        click_rate=F.col("clicks") / F.col("events"),
    )


GAPS_SQL = (
    "SELECT user_id, count(*) AS events, coalesce(max(gap), 0) AS longest_gap FROM (SELECT user_id, "
    "epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events) GROUP BY user_id"
)


@query(GAPS_SQL)
def custom_group_apply(spark, d):
    """Each user's longest time between events, in microseconds: needs the whole group in order."""

    def gaps(rows):
        import pandas as pd

        at = rows["at"].astype("int64").sort_values()
        return pd.DataFrame({"events": [len(at)], "longest_gap": [int(at.diff().max()) if len(at) > 1 else 0]})

    rows = read(spark, d, "events").select("user_id", F.unix_micros("ts").alias("at"))
    return apply_groups(rows, "user_id", gaps, "events long, longest_gap long")


@query("SELECT l_suppkey, count(*) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS numbers FROM lineitem WHERE l_discount > 0.05 GROUP BY 1")
def custom_group_batches(spark, d):
    """Groups read a batch at a time, so that none is held whole."""

    def totals(frames):
        import pandas as pd

        lines = numbers = 0
        for frame in frames:
            lines, numbers = lines + len(frame), numbers + int(frame["l_linenumber"].sum())
        yield pd.DataFrame({"lines": [lines], "numbers": [numbers]})

    rows = read(spark, d, "lineitem").filter("l_discount > 0.05").select("l_suppkey", "l_linenumber")
    return apply_batches(rows, "l_suppkey", totals, "lines long, numbers long")


LINES_SQL = "SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) > 0) AS lines FROM documents"


@query(
    "SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(length(lines[place]) AS INTEGER) AS chars FROM "
    f"(SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS place FROM ({LINES_SQL}))"
)
def custom_flat_map(spark, d):
    """One row per line of a text that is not empty, with its place and length."""

    def lines(text):
        for place, line in enumerate(filter(None, text.split("\n")), 1):
            yield place, len(line)

    documents = read(spark, d, "documents").select("doc_id", "text")
    return flat_rows(documents, lines, "text", "place int, chars long").drop("text")
