"""Decoding, rules, text, lookups, aggregates, sources and sinks on small fixtures."""

import datetime as dt
import json
import math

import pytest
from feeds import log_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.functions.rules import classify, label
from freshet.functions.scalars import epoch_to_ts, exact_avg, exact_sum, iso_to_ts, plain_number, safe_ratio
from freshet.functions.text import keyword_label, lexicon_label, polarity, tokens
from freshet.operators.aggregates import agg_multi, corr_matrix, group_agg, group_all, group_mean, top_n, volume_alert
from freshet.operators.clusters import fit_clusters, in_order_of_centres, score
from freshet.operators.decode import bad_rows, current_rows, decode_changes, decode_json, encode_json, good_rows
from freshet.operators.lookups import lookup, member_flag, missing_keys
from freshet.operators.ranking import positions, weight_above
from freshet.session import RUNTIME_SETTINGS, checkpoint_dir, shared_path
from freshet.sinks import documents as docs
from freshet.sinks import tables as sink
from freshet.sources import files, generated, log
from suite.keyed import as_log

PAYLOAD = S.schema(name="string", size="integer")


def values(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def records(spark):
    payloads = [{"name": "a", "size": 1}, "no json", {"name": "b"}, {"name": "c", "size": "wide"}]
    return spark.createDataFrame(log_rows(payloads), S.LOG)


def test_bad_json_becomes_nulls_and_can_be_split_off(records):
    assert values(decode_json(records, PAYLOAD).fillna({"name": "-", "size": -1})) == [
        ("-", -1), ("a", 1), ("b", -1), ("c", -1)
    ]
    marked = decode_json(records, PAYLOAD, keep=["offset"], keep_bad=True)
    assert values(good_rows(marked).fillna(-1)) == [(0, "a", 1), (2, "b", -1)]
    assert values(bad_rows(marked)) == [("no json",), ('{"name": "c", "size": "wide"}',)]


def test_payload_kept_nested(records):
    out = decode_json(records, PAYLOAD, nested="parsed_data").filter("offset = 0").first()
    assert out["parsed_data"].asDict() == {"name": "a", "size": 1} and out["topic"] == "t"


def test_undeclared_fields_kept_in_a_whole_payload(spark):
    df = spark.createDataFrame([('{"name": "a", "more": {"x": [1, null]}}',), ("no json",), (None,)], "value string")
    out = decode_json(df, PAYLOAD, nested="p", whole=True).select(F.to_json("p").alias("p"))
    assert [r["p"] for r in out.collect()] == ['{"more":{"x":[1,null]},"name":"a"}', None, None]


def test_encode_then_decode(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], PAYLOAD)
    sent = encode_json(df, "name")
    assert values(sent) == [("a", '{"name":"a","size":1}'), ("b", '{"name":"b"}')]
    assert values(decode_json(sent, PAYLOAD).fillna(-1)) == [("a", 1), ("b", -1)]


def test_timestamps(spark):
    df = spark.createDataFrame([(1700000001.5, "2024-02-29T01:02:03.5"), (None, "yesterday")], "s double, t string")
    out = df.select(epoch_to_ts("s").alias("s"), iso_to_ts("t").alias("t")).collect()
    assert out[0]["s"] == dt.datetime(2023, 11, 14, 22, 13, 21, 500000)
    assert out[0]["t"] == dt.datetime(2024, 2, 29, 1, 2, 3, 500000)
    assert out[1]["s"] is None and out[1]["t"] is None


def test_first_rule_wins_and_null_falls_through(spark):
    df = spark.createDataFrame([(95,), (15,), (None,), (50,)], "x int")
    out = classify(df, "y", [("x > 90", "high"), (F.col("x") > 40, "mid")], "low")
    assert {r["x"]: r["y"] for r in out.collect()} == {95: "high", 15: "low", None: "low", 50: "mid"}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=8), st.integers(-20, 20))
def test_rules_against_a_loop(spark, xs, limit):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x int")
    out = df.withColumn("y", label([(f"x > {limit}", 2), (f"x > {limit} - 10", 1)], 0))
    want = [0 if x is None else 2 if x > limit else 1 if x > limit - 10 else 0 for x in xs]
    assert [r["y"] for r in out.orderBy("i").collect()] == want


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, 1.5]


def test_groups_skip_null_keys_and_nan(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", math.nan), ("a", 3.0), ("a", None), (None, 9.0)], "k string, v double"
    )
    assert values(group_agg(df, "k", n=F.count("v"), m=F.avg("v"))) == [("a", 2, 2.0)]
    assert values(group_mean(df, "k", ["v"])) == [("a", 2.0)]
    stats = agg_multi(df, "k", ["v"], ["mean", "max", "std"])
    assert stats.columns == ["k", "v_mean", "v_max", "v_std"]
    assert stats.first()["v_std"] == pytest.approx(math.sqrt(2))


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v double")
    assert df.agg(exact_sum("v"), exact_avg("v")).first() == (1.0, 0.1)


def test_correlation_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (math.nan, 1.0)], "a double, b double")
    out = {(r["a"], r["b"]): r["r"] for r in corr_matrix(df, ["a", "b"]).collect()}
    assert set(out) == {("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")}
    assert all(v == pytest.approx(1.0) for v in out.values())


def test_volume_alert(spark):
    df = spark.createDataFrame([("x", 1)] * 6 + [("y", 1)] * 5 + [("y", 0)] * 9, "batch string, bad int")
    assert values(volume_alert(df, "batch", "bad = 1", 5)) == [("x", 6)]
    assert values(volume_alert(df, None, "bad = 1", 5)) == [(11,)]


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", None)], "k string, v int")
    assert [r["k"] for r in top_n(df, "v", 3, ["k"]).collect()] == ["c", "a", "b"]


def test_keywords_first_list_wins(spark):
    df = spark.createDataFrame([("Muito BOM mas lento",), ("LENTO",), ("nada",), (None,)], "text string")
    out = keyword_label(df, "text", [("P", ["bom"]), ("N", ["lento"])], "s", "-")
    assert [r["s"] for r in out.collect()] == ["P", "N", "-", "-"]


def test_both_forms_of_lexicon_scoring_agree(spark):
    words = {"Good": 0.5, "BAD": -0.5, "so": 0.0}
    texts = [(1, "Good good bad"), (2, "bad so so so so so"), (3, "bad"), (4, "nothing"), (5, None), (6, "")]
    df = spark.createDataFrame(texts, "id int, text string")
    lexicon = spark.createDataFrame(list(words.items()), "word string, score double")
    joined = {r["id"]: r for r in lexicon_label(df, "id", "text", lexicon).collect()}
    assert {i: r["sentiment"] for i, r in joined.items()} == {
        1: "POSITIVE", 2: "NEUTRAL", 3: "NEGATIVE", 4: "NEUTRAL", 5: "NEUTRAL", 6: "NEUTRAL"
    }
    direct = {r["id"]: r["p"] for r in df.select("id", polarity("text", words).alias("p")).collect()}
    assert {i: r["polarity"] for i, r in joined.items()} == pytest.approx(direct)


def test_a_long_word_list_gives_the_same_labels(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Good good bad"), (2, "so bad"), (3, "none"), (4, None)], "id int, text string")
    words = spark.createDataFrame([("good", 1.0), ("BAD", -0.5)], "word string, score double")
    sent = values(lexicon_label(df, "id", "text", words))
    monkeypatch.setattr("freshet.functions.text.KNOWN_WORDS", 1)
    assert values(lexicon_label(df, "id", "text", words)) == sent
    assert sent == [(1, 0.5, "POSITIVE"), (2, -0.5, "NEGATIVE"), (3, None, "NEUTRAL"), (4, None, "NEUTRAL")]


def test_tokens_keep_empty_ones_and_positions(spark):
    df = spark.createDataFrame([("a  b ",)], "text string")
    assert values(tokens(df, "text", position="at").drop("text")) == [(0, "a"), (1, ""), (2, "b"), (3, "")]


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(1, 0, "x"), (2, 7, None)], "k int, limit int, name string")


def test_lookup_keeps_stored_zero_and_fills_misses(spark, dim):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    out = lookup(df, dim, "k", {"limit": 28, "name": "Unknown"})
    assert {r["k"]: (r["limit"], r["name"]) for r in out.collect()} == {
        1: (0, "x"), 2: (7, "Unknown"), 3: (28, "Unknown"), None: (28, "Unknown")
    }


def test_missing_keys_and_membership(spark, dim):
    df = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    assert values(missing_keys(df, dim, "k")) == [(3,)]
    twice = dim.union(dim)
    flags = [(r["k"], r["m"]) for r in member_flag(df, twice, "k", "m").collect()]
    assert sorted(flags, key=str) == [(1, True), (3, False), (3, False), (None, False)]


def test_change_events_fold_to_the_current_table(spark):
    def change(op, before, after, ts):
        row = lambda status: None if status is None else {"id": status[0], "status": status[1]}
        return json.dumps({"op": op, "before": row(before), "after": row(after), "ts": ts})

    events = [
        change("c", None, (1, "new"), 10),
        change("u", (1, "new"), (1, "paid"), 30),
        change("u", (1, "new"), (1, "late"), 20),  # arrives after the newer one
        change("c", None, (2, "new"), 10),
        change("d", (2, "new"), None, 11),
        change("u", (10, "pendente"), (10, "pago"), 5),
    ]
    df = spark.createDataFrame(list(enumerate(events)), "offset long, value string")
    decoded = decode_changes(df, S.CHANGED_ROW)
    assert decoded.columns == ["offset", "op", "before", "after", "ts"]
    assert values(current_rows(decoded, "id", ["ts", "offset"])) == [(1, "paid"), (10, "pago")]


def test_weight_above_against_all_pairs():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 17, 64, 100):
        when, level, weight = rng.permutation(n), rng.permutation(n), rng.integers(-1, 2, n)
        want = [sum(weight[j] for j in range(n) if when[j] < when[i] and level[j] > level[i]) for i in range(n)]
        assert weight_above(when, np.argsort(-level), weight).tolist() == want


def test_positions_number_all_rows(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert values(positions(df, [F.col("x")], "at")) == [(i, i) for i in range(1000)]


def test_clusters(spark):
    df = spark.createDataFrame([(float(i % 5), 1.0) for i in range(50)] + [(1000.0 + i, 500.0) for i in range(5)], "a double, b double")
    model = fit_clusters(df, ["a", "b"])
    assert len(model.clusterCenters()) == 2
    sizes = sorted(r["count"] for r in score(model, df, ["a", "b"]).groupBy("prediction").count().collect())
    assert sizes == [5, 50]
    far = score(model, df, ["a", "b"], distance="far").filter("b = 1").groupBy("a").agg(F.max("far").alias("far")).orderBy("a")
    assert [round(r["far"], 6) for r in far.collect()] == [2.0, 1.0, 0.0, 1.0, 2.0]
    named = in_order_of_centres(model, score(model, df, ["a", "b"]))
    assert {(r["b"], r["prediction"]) for r in named.collect()} == {(1.0, 0), (500.0, 1)}


# Sources and sinks.


def test_csv_tables_with_and_without_schema(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"log_{i}.csv").write_text(f"k,v\nx,{i}.5\n")
    paths = [str(tmp_path / f"log_{i}.csv") for i in range(3)]
    declared = files.csv_table(spark, str(tmp_path / "log_*.csv"), S.schema(k="string", v="double"))
    inferred = files.csv_table(spark, paths)
    assert values(declared) == values(inferred) == [("x", 0.5), ("x", 1.5), ("x", 2.5)]
    assert inferred.schema["v"].dataType.typeName() == "double"


def test_generated_sources(spark):
    ids = generated.sequence(spark, 1, 20, 1, 100, seed=4).collect()
    assert [r["id"] for r in ids] == list(range(1, 21))
    assert all(1 <= r["val"] <= 100 for r in ids)
    assert values(generated.rows(spark, [(1, "US")], "id int, country string")) == [(1, "US")]


def test_log_offsets_and_replay(spark):
    df = spark.createDataFrame([(s, s % 4, f"m{s}") for s in range(40)], "seq long, user long, body string")
    made = as_log(df, "user", "body", "seq", "s5_keys", 3, span=5, hot_rows=4)
    shown = made.select("partition", "offset", F.col("key").cast("string"), F.col("value").cast("string"))
    by_partition = {}
    for r in shown.orderBy("partition", "offset").collect():
        by_partition.setdefault(r["partition"], []).append((r["offset"], r["key"], r["value"]))
    for p, records in by_partition.items():
        assert [o for o, _, _ in records] == list(range(len(records)))
        assert [v for _, _, v in records] == sorted((v for _, _, v in records), key=lambda v: int(v[1:]))
        assert {int(k) % 3 for _, k, _ in records} == {p}
    again = log.replay(made, {0: 5, 1: 2})
    assert again.filter("partition = 0").count() == len(by_partition[0]) - 5
    assert again.filter("partition = 2").count() == len(by_partition[2])


def test_topic_settings():
    assert log.topic_options("b:9092", "t", "earliest", {"failOnDataLoss": "false"}) == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false"
    }
    sent = docs.publish_options("b:9092", "t", acks="1")
    assert sent["kafka.acks"] == "1" and sent["kafka.compression.type"] == "gzip" and sent["kafka.linger.ms"] == "50"


def test_archive_appends_with_the_declared_types(spark, tmp_path):
    path = str(tmp_path / "a")
    sink.archive(spark.createDataFrame([("x", "1")], "name string, size string"), path, PAYLOAD)
    sink.archive(spark.createDataFrame([("y", 2)], "name string, size long"), path, PAYLOAD)
    back = spark.read.parquet(path)
    assert back.schema == PAYLOAD and values(back) == [("x", 1), ("y", 2)]


def test_batch_delivered_twice_is_kept_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first, again, second = ([("a", 1)], [("a", 1), ("b", 2)], [("c", 3)])
    for rows, n in ((first, 0), (second, 1), (again, 0)):
        sink.append_batch(spark.createDataFrame(rows, PAYLOAD), path, n)
    sink.append_batch(spark.createDataFrame([], PAYLOAD), path, 2)
    assert values(spark.read.parquet(path)) == [("a", 1, 0), ("b", 2, 0), ("c", 3, 1)]


def test_catalog_table_append_and_replace(spark):
    for rows, n in (([("a", 1)], 0), ([("b", 2)], 1), ([("b", 3)], 1), ([], 2)):
        sink.append_to_table(spark.createDataFrame(rows, PAYLOAD), "alerts", n)
    assert values(spark.table("alerts")) == [("a", 1, 0), ("b", 3, 1)]
    for rows in ([("a", 1), ("b", 2)], [("c", 3)]):
        sink.replace_table(spark.createDataFrame(rows, PAYLOAD), "top")
    assert values(spark.table("top")) == [("c", 3)]


def test_rows_already_in_the_target_are_left_out(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    there = spark.createDataFrame([(2, "b", 7)], "id int, v string, batch_id int")
    assert values(sink.not_yet_there(batch, there, ["id"])) == [(1, "a"), (3, "c")]


def test_documents_written_read_and_queried(spark, tmp_path):
    df = spark.createDataFrame([("v", 1, ("a", 2))], "value string, seen long, parsed_data struct<name: string, size: int>")
    docs.write_documents(df, str(tmp_path), "interest")
    docs.write_documents(df, str(tmp_path), "interest", mode="append")
    back = files.documents(spark, str(tmp_path), "interest", df.schema, view="interest")
    assert back.count() == 2 and back.schema == df.schema
    assert spark.sql("SELECT sum(parsed_data.size) AS s FROM interest").first()["s"] == 4


def test_insert_into_a_table_with_sql(spark):
    generated.sequence(spark, 1, 20, 1, 100).createOrReplaceTempView("source_table")
    spark.sql("CREATE TABLE IF NOT EXISTS doubled (id BIGINT, val INT, doubled_val INT) USING parquet")
    spark.sql("INSERT INTO doubled SELECT id, val, val * 2 FROM source_table")
    out = spark.table("doubled").collect()
    assert len(out) == 20 and all(r["doubled_val"] == 2 * r["val"] for r in out)


def test_shared_folder(spark):
    assert shared_path(spark, "x") != shared_path(spark, "x")
    assert shared_path(spark, "x").startswith(checkpoint_dir(spark).rstrip("/"))
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_SETTINGS.items())


def test_null_keys_are_a_group_where_asked(spark):
    df = spark.createDataFrame([(None, 5), ("a", 3), (None, 1)], "k string, v int")
    assert {tuple(r) for r in group_all(df, "k", s=F.sum("v")).collect()} == {("a", 3), (None, 6)}
    assert values(group_agg(df, "k", s=F.sum("v"))) == [("a", 3)]


def test_large_amounts_have_no_exponent(spark):
    amounts = [9999.5, 15000000.0, 123456789.25, 9007199254740992.0, 12000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    assert [r[0] for r in df.select(plain_number("x")).collect()] == [repr(a) for a in amounts]


def test_a_connector_gets_its_resource(spark, tmp_path):
    df = spark.range(3)
    docs.write_documents(df, "unused", str(tmp_path / "index"), connector="json")
    assert spark.read.json(str(tmp_path / "index")).count() == 3
