"""Plans on fixtures with a known anomaly, from log records and files to results."""

import datetime as dt
import random

import pytest
from feeds import log_rows, write_files, write_log
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.operators.clusters import fit_clusters
from freshet.operators.decode import decode_json
from freshet.plans.base import PLANS as REGISTERED
from freshet.plans.catalog import PLANS
from freshet.sinks.documents import append_documents
from freshet.sources.files import csv_arrivals, csv_table, documents, parquet_arrivals
from freshet.sources.log import folder_stream
from freshet.streaming import runs

AT = dt.datetime(2024, 1, 1)


def frame(spark, schema, rows):
    """Rows given as dicts; absent columns are null."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def run(spark, name, rows, **tables):
    return PLANS[name].run(frame(spark, PLANS[name].schema, rows), **tables)


def column(df, *names):
    return [tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect()]


def logged(spark, payloads):
    return spark.createDataFrame(log_rows(payloads), S.LOG)


def test_all_plans_are_registered():
    assert PLANS is REGISTERED and len(PLANS) >= 60
    assert {p.mode for p in PLANS.values()} <= {"append", "update", "complete", "per_batch", "batch", "carried"}


def test_aviation(spark):
    log = logged(
        spark,
        [
            {"timestamp": "2024-01-01T00:00:00", "flight_id": f, "engine_temp": t, "fuel_level": fuel}
            for f, t, fuel in (("A", 901, 10), ("B", 900, 19), ("C", 860, 20), ("D", 850, 99))
        ],
    )
    assert column(PLANS["aviation_status"].run_log(log), "status") == ["CRITICAL", "LOW_FUEL", "NORMAL", "NORMAL"]
    assert column(PLANS["aviation_overheat"].run_log(log), "flight_id") == ["A", "B", "C"]


def test_vitals(spark):
    rows = [
        {"patient_id": 1, "spo2": 89, "heart_rate": 60, "systolic_bp": 100},
        {"patient_id": 2, "spo2": 95, "heart_rate": 125, "systolic_bp": 161},
        {"patient_id": 3, "spo2": 95, "heart_rate": 131, "systolic_bp": 100},
        {"patient_id": 4, "spo2": 95, "heart_rate": 80, "systolic_bp": 100},
    ]
    assert column(run(spark, "vitals_status", rows), "status") == ["CRITICAL", "WARNING", "CRITICAL", "NORMAL"]
    assert column(run(spark, "vitals_critical", rows), "patient_id") == [1, 2, 3]


def test_grid_and_claims(spark):
    volts = [{"transformer_id": str(v), "voltage": v} for v in (109, 110, 240, 241)]
    assert column(run(spark, "grid_status", volts), "status") == ["ANOMALY", "NORMAL", "NORMAL", "ANOMALY"]
    assert column(run(spark, "grid_anomalies", volts), "voltage") == [109, 241]
    claims = [{"claim_id": i, "amount": a, "policy_age": y} for i, (a, y) in enumerate([(50001, 0), (50001, 1), (70001, 3)])]
    assert column(run(spark, "claim_risk", claims), "risk") == ["HIGH", "LOW", "MEDIUM"]
    assert column(run(spark, "high_risk_claims", claims), "claim_id") == [0]


def test_transactions_are_scored_by_a_fitted_model(spark):
    normal = [{"transaction_id": str(i), "amount": 10.0 + i, "distance_km": 1.0 + i % 20} for i in range(100)]
    odd = [{"transaction_id": f"odd{i}", "amount": 9000.0 + i, "distance_km": 900.0} for i in range(5)]
    model = fit_clusters(frame(spark, S.TRANSACTION, normal + odd), ["amount", "distance_km"])
    out = run(spark, "transaction_clusters", normal + odd, model=model)
    assert out.columns == ["transaction_id", "amount", "distance_km", "prediction"]
    clusters = {r["transaction_id"]: r["prediction"] for r in out.collect()}
    assert len({clusters[f"odd{i}"] for i in range(5)}) == 1
    assert clusters["odd0"] not in {clusters[str(i)] for i in range(100)}


def test_stock_windows_overlap(spark):
    rows = [{"symbol": "X", "price": p, "timestamp": float(t)} for t, p in ((0, 10.0), (4.5, 20.0), (6, 30.0))]
    out = run(spark, "stock_averages", rows).orderBy("window_start")
    assert column(out, "average_price") == [15.0, 20.0, 30.0]
    assert out.columns == ["window_start", "window_end", "symbol", "average_price"]


def test_comments(spark):
    rows = [{"text": t} for t in ("Amei o produto", "Achei HORRÍVEL", "ok", "bom mas ruim")]
    assert column(run(spark, "comment_keywords", rows), "sentiment") == ["POSITIVO", "NEGATIVO", "NEUTRO", "POSITIVO"]
    lexicon = {"love": 0.5, "awful": -1.0}
    said = run(spark, "comment_sentiment", [{"text": "I love it"}] + [{"text": "awful"}] * 6, lexicon=lexicon)
    assert column(said, "sentiment") == ["POSITIVE"] + ["NEGATIVE"] * 6
    assert column(PLANS["negative_volume"].run(said), "negatives") == [6]
    assert column(PLANS["negative_volume"].run(said.limit(6)), "negatives") == []


def test_intrusion_burst(spark):
    burst = [{"source_ip": "10.0.0.666", "timestamp": AT + dt.timedelta(milliseconds=50 * i)} for i in range(60)]
    calm = [{"source_ip": "10.0.0.1", "timestamp": AT + dt.timedelta(seconds=i)} for i in range(60)]
    out = run(spark, "intrusion_alerts", burst + calm)
    assert column(out, "source_ip", "count", "alert") == [("10.0.0.666", 60, "POSSIBLE DDOS")]


def test_leaderboard_and_stock(spark):
    scores = [{"player_id": f"p{i % 7}", "score": 10 * (i % 7)} for i in range(70)]
    assert column(run(spark, "leaderboard_top", scores), "player_id", "total_score") == [
        (f"p{i}", 100 * i) for i in (6, 5, 4, 3, 2)
    ]
    assert column(run(spark, "leaderboard", scores), "player_id") == [f"p{i}" for i in range(6, -1, -1)]
    sales = [{"product_id": "hot", "quantity": 3}] * 20 + [{"product_id": "cold", "quantity": 1}] * 10
    assert column(run(spark, "restock_alerts", sales), "product_id", "sold_quantity") == [("hot", 60)]
    assert column(run(spark, "low_stock", sales), "product_id", "current_stock") == [("hot", 240)]


def test_surge(spark):
    rows = [{"region": "Airport", "timestamp": i / 10} for i in range(60)]
    rows += [{"region": "Centro", "timestamp": i / 3} for i in range(30)] + [{"region": "Sul", "timestamp": 1.0}]
    out = {r["region"]: (r["count"], r["multiplier"]) for r in run(spark, "surge_pricing", rows).collect()}
    assert out == {"Airport": (60, 2.0), "Centro": (30, 1.5), "Sul": (1, 1.0)}


def test_vehicles(spark):
    rows = [{"driving_style": "AGGRESSIVE", "speed_kmh": 150.0, "engine_rpm": 3000.0}] * 2
    rows += [{"driving_style": "NORMAL", "speed_kmh": 60.0, "engine_rpm": 0.0}, {"driving_style": None, "speed_kmh": 1.0}]
    out = {r["driving_style"]: (r["speed_kmh"], r["efficiency"]) for r in run(spark, "driving_styles", rows).collect()}
    assert out == {"AGGRESSIVE": (150.0, 50.0), "NORMAL": (60.0, None)}
    logs = [{"vehicle_id": v, "speed_kmh": s, "rpm": s * 30, "oil_temp": 90 + s} for v, s in ((1, 100.0), (1, 121.0), (2, 90.0))]
    assert column(run(spark, "fast_vehicles", logs), "vehicle_id", "speed_kmh") == [(1, 110.5)]
    assert all(r == pytest.approx(1.0) for r in column(run(spark, "engine_correlation", logs), "r"))


def test_traffic(spark):
    rows = [{"intersection_id": i, "vehicle_count": n, "avg_speed": 30.0} for i, n in (("a", 36), ("b", 26), ("c", 21), ("d", 20))]
    signals = {r["intersection_id"]: r["action"] for r in run(spark, "traffic_signals", rows).collect()}
    assert signals == {"a": "EXTEND_GREEN_30S", "b": "EXTEND_GREEN_15S", "c": "NORMAL_CYCLE", "d": "NORMAL_CYCLE"}
    assert column(run(spark, "green_light_seconds", rows), "green_light_sec") == [45, 45, 35, 30]


def test_routes(spark):
    fuel = [{"route_id": "R3", "distance_km": d, "duration_min": 60.0, "fuel_consumed_l": 5.0} for d in (50.0, 100.0, 0.0)]
    assert column(run(spark, "route_fuel", fuel), "fuel_efficiency") == [7.5]
    pace = [{"route_id": "R3", "distance_km": 30.0, "delivery_time_min": m} for m in (30.0, 60.0)]
    assert column(run(spark, "route_pace", pace), "delivery_time_min", "efficiency") == [(45.0, 0.75)]


def test_machines(spark):
    rows = [{"machine_id": "MAC-120", "vibration": 70.0 + i, "temperature": 90.0} for i in (0, 2)]
    rows += [{"machine_id": "MAC-001", "vibration": 40.0, "temperature": 60.0}]
    health = {r["machine_id"]: r["health_score"] for r in run(spark, "machine_health", rows).collect()}
    assert health == pytest.approx({"MAC-120": 37.5, "MAC-001": 62.0})
    assert column(run(spark, "machine_maintenance", rows), "machine_id") == ["MAC-120"]
    alert = run(spark, "machine_alerts", rows).first()
    assert (alert["machine_id"], alert["vibration_mean"], alert["vibration_max"]) == ("MAC-120", 71.0, 72.0)
    assert alert["vibration_std"] == pytest.approx(2**0.5) and alert["temperature_std"] == 0.0


def test_soil(spark):
    rows = [{"zone_id": "ZONE-3", "moisture_percent": m} for m in (20.0, 24.0)] + [{"zone_id": "ZONE-1", "moisture_percent": 30.0}]
    assert column(run(spark, "irrigation_needs", rows), "zone_id", "moisture_percent") == [("ZONE-3", 22.0)]
    actions = {r["zone_id"]: r["action"] for r in run(spark, "irrigation_actions", rows).collect()}
    assert actions == {"ZONE-3": "ATIVAR", "ZONE-1": "AGUARDAR"}


def test_towers(spark):
    rows = [{"call_id": i, "tower_id": "TOWER-042", "status": "DROP" if i < 4 else "OK"} for i in range(10)]
    rows += [{"call_id": i, "tower_id": "TOWER-001", "status": "DROP" if i < 1 else "OK"} for i in range(10)]
    for name in ("bad_towers", "worst_towers"):
        assert column(run(spark, name, rows), "tower_id", "total_calls", "dropped_calls", "drop_rate") == [
            ("TOWER-042", 10, 4, 0.4)
        ]


def test_weather(spark):
    rows = [{"station_id": s, "temp_c": t} for s, t in (("STATION-05", 36.0), ("STATION-05", 20.0), ("STATION-01", 35.0))]
    assert column(run(spark, "heatwaves", rows), "station_id", "temp_c") == [("STATION-05", 36.0)]
    year = [
        {"station_id": "STATION-05", "timestamp": f"2020-01-0{d} {h}:00:00", "temperature": 40.0 + d + h / 100}
        for d in (1, 2) for h in (10, 12)
    ]
    assert column(run(spark, "hot_days", year), "date", "temperature") == [
        (dt.date(2020, 1, 2), 42.12), (dt.date(2020, 1, 1), 41.12)
    ]


def test_hotels(spark):
    rows = [{"hotel_id": "H", "booking_id": i, "nights": n, "status": s} for i, (n, s) in enumerate([(1, "CONFIRMED"), (3, "CONFIRMED"), (9, "CANCELLED")])]
    script = [dict(r, price=100.0) for r in rows]
    assert column(run(spark, "hotel_revenue", script), "total_revenue", "total_nights") == [(200.0, 4)]
    notebook = [dict(r, price_per_night=100.0) for r in rows]
    assert column(run(spark, "hotel_performance", notebook), "total_revenue", "total_bookings", "avg_stay") == [(400.0, 2, 2.0)]


def test_exams(spark):
    rows = [{"student_id": "STUDENT-1042", "event": "TAB_SWITCH"}] * 6 + [{"student_id": "STUDENT-1", "event": "TAB_SWITCH"}] * 5
    assert column(run(spark, "tab_switchers", rows), "student_id", "switches") == [("STUDENT-1042", 6)]
    logs = [{"student_id": "a", "event_type": "TAB_SWITCH", "time_spent_sec": 60.0}] * 21
    logs += [{"student_id": "b", "event_type": "ANSWER", "time_spent_sec": 9.0}] * 31
    logs += [{"student_id": "c", "event_type": "ANSWER", "time_spent_sec": 10.0}] * 99
    assert sorted(column(run(spark, "exam_flags", logs), "student_id")) == ["a", "b"]


def test_interest_documents(spark):
    views = [{"user_id": u, "product_id": 1, "category": c} for u, c in (("u1", "books"), ("u1", "books"), ("u1", "toys"))]
    out = PLANS["interest_profile"].run_documents(logged(spark, views))
    assert out.columns == ["value", "enriched_interest", "parsed_data"]
    assert sorted((r["parsed_data"]["category"], r["enriched_interest"]) for r in out.collect()) == [
        ("books", 1), ("books", 2), ("toys", 1)
    ]


def test_prices_limits_and_zones(spark):
    prices = spark.createDataFrame([("item_A", 0.0), ("item_B", 50.0)], "item_id string, base_price double")
    demand = [{"item_id": i, "demand_index": 2} for i in ("item_A", "item_B", "item_C")]
    assert column(run(spark, "dynamic_prices", demand, base_prices=prices), "calculated_price") == pytest.approx([0.0, 55.0, 110.0])
    limits = spark.createDataFrame([("d1", 20)], "device_id string, limit int")
    temps = [{"device_id": d, "temp": t} for d, t in (("d1", 21), ("d2", 28), ("d2", 29))]
    assert column(run(spark, "overheating_devices", temps, limits=limits), "alert") == ["OVERHEATING", "NORMAL", "OVERHEATING"]
    pulses = [{"patient_id": p, "bpm": b} for p, b in (("p1", 95), ("p2", 121), ("p2", 101), ("p2", 100))]
    bounds = spark.createDataFrame([("p1", 90)], "patient_id string, max_bpm int")
    assert column(run(spark, "patient_risk", pulses, limits=bounds), "risk_level") == ["CRITICAL", "CRITICAL", "ELEVATED", "LOW"]
    planned = spark.createDataFrame([("t1", "north")], "truck_id string, planned_zone string")
    trucks = [{"truck_id": t, "current_zone": z} for t, z in (("t1", "north"), ("t1", "transit"), ("t2", "transit"))]
    assert column(run(spark, "zone_violations", trucks, planned=planned), "violation") == [False, True, False]


def test_cards_trades_and_logins(spark):
    uses = logged(spark, [{"card_id": "c", "amount": 1, "country": x} for x in ("BR", "BR", "US", "BR")])
    out = PLANS["card_alerts"].run_log(uses).orderBy("offset")
    assert column(out, "fraud_alert") == [False, False, True, True]
    quotes = [{"symbol": "S", "price": p} for p in (149, 150, 100)]
    assert column(run(spark, "trade_actions", quotes), "action") == ["BUY", "HOLD", "BUY"]
    assert column(run(spark, "trade_balance", quotes), "balance_usd") == [-249]
    tries = logged(spark, [{"src_ip": "x", "status": "fail"}] * 7 + [{"src_ip": "x", "status": "success"}])
    assert column(PLANS["login_blocks"].run_log(tries).orderBy("offset"), "blocked") == [False] * 6 + [True] * 2


def test_player_ranks(spark):
    log = logged(spark, [{"player": p, "points": n} for p, n in (("a", 10), ("b", 10), ("a", 5), ("b", 5), ("c", 99))])
    out = PLANS["player_ranks"].run_log(log).orderBy("offset")
    assert column(out, "total_score", "current_rank") == [(10, 0), (10, 0), (15, 0), (15, 0), (99, 0)]


def test_words(spark):
    # The texts and their counts.
    texts = ["hello flink", "streaming is cool", "hello cloud", "flink is fast"]
    out = {r["word"]: r["count"] for r in run(spark, "word_counts", [{"text": t} for t in texts]).collect()}
    assert out == {"hello": 2, "flink": 2, "is": 2, "streaming": 1, "cool": 1, "cloud": 1, "fast": 1}
    log = logged(spark, [{"text": t} for t in texts])
    running = PLANS["running_word_counts"].run_log(log).orderBy("offset", "position")
    assert column(running, "word", "count") == [
        ("hello", 1), ("flink", 1), ("streaming", 1), ("is", 1), ("cool", 1), ("hello", 2), ("cloud", 1), ("flink", 2),
        ("is", 2), ("fast", 1),
    ]


def test_high_value_messages(spark):
    rows = [{"id": i, "amount": a, "country": c} for i, a, c in ((1, 50.0, "US"), (2, 12000.0, "US"), (3, 20.0, "BR"), (4, 15000.0, "RU"))]
    assert column(run(spark, "high_value_alerts", rows), "message") == [
        "ALERT: High value transaction 2 detected: $12000.0",
        "ALERT: High value transaction 4 detected: $15000.0",
    ]


def test_sensor_folds(spark):
    # The readings in their order and the two folds.
    temps = [("s1", 20), ("s1", 22), ("s2", 15), ("s1", 25), ("s2", 18), ("s1", 23), ("s2", 16), ("s1", 24)]
    rows = [{"seq": i, "sensor": s, "temp": float(t), "ts": AT} for i, (s, t) in enumerate(temps)]
    assert {r["sensor"]: r["folded"] for r in run(spark, "sensor_folds", rows).collect()} == {"s1": 23.5, "s2": 16.25}


def test_click_profiles(spark):
    users = spark.createDataFrame([(101, "Alice", "low"), (102, "Bob", "high")], "user_id int, name string, risk string")
    rows = [{"user_id": u, "url": "/"} for u in (101, 102, 101, 999)]
    assert column(run(spark, "click_profiles", rows, users=users), "name", "risk") == [
        ("Alice", "low"), ("Bob", "high"), ("Alice", "low"), ("Unknown", "unknown")
    ]


def test_sql_plans(spark):
    assert column(run(spark, "doubled_values", [{"id": 1, "val": 7}]), "doubled_val") == [14]
    logs = [{"id": str(i), "level": "INFO" if i % 3 else "ERROR"} for i in range(9)]
    assert sorted(column(run(spark, "log_levels", logs), "level", "count")) == [("ERROR", 3), ("INFO", 6)]
    goods = [{"name": n, "category": c, "price": p} for n, c, p in (("a", "Electronics", 201.0), ("b", "Electronics", 200.0), ("c", "Home", 300.0))]
    assert column(run(spark, "premium_products", goods), "name") == ["a"]
    siem = PLANS["siem_events"].run(spark.range(0, 100).select(F.lit(AT).alias("timestamp"), F.col("id").alias("value")))
    assert column(PLANS["siem_hunt"].run(siem), "id", "src_ip") == [(10 * i, "192.168.1.1") for i in range(5)]
    customers = [{"id": i, "spend": s, "visits": 1} for i, s in enumerate((500, 501, 699))]
    assert column(run(spark, "customer_segments", customers), "segment") == ["Regular", "VIP", "VIP"]
    assert sorted(column(run(spark, "segment_spend", customers), "segment", "avg_spend")) == [("Regular", 500.0), ("VIP", 600.0)]
    sold = [{"sale_id": i, "customer_id": i % 5, "amount": 100} for i in range(20)]
    orders = spark.createDataFrame([(i, "O") for i in range(1, 60, 2)], "orderkey long, orderstatus string")
    assert sorted(column(run(spark, "sales_orders", sold, orders=orders), "sale_id")) == list(range(1, 20, 2))
    assert column(run(spark, "sales_orders_sample", sold, orders=orders), "sale_id") == [1, 3, 5, 7, 9]


def test_change_plans(spark):
    log = spark.createDataFrame(
        [(0, '{"op":"u","before":{"id":10,"status":"pendente"},"after":{"id":10,"status":"pago"},"ts":5}')],
        "offset long, value string",
    )
    event = PLANS["change_events"].run(log).first()
    assert (event["op"], event["before"]["status"], event["after"]["status"], event["ts"]) == ("u", "pendente", "pago", 5)
    assert column(PLANS["changed_table"].run(log), "id", "status") == [(10, "pago")]


# From the source to the sink, as streams.


def finish(writer):
    runs.finish(runs.start(writer), 120)


def test_log_to_table_and_archive(spark, tmp_path):
    folder = str(tmp_path / "log")
    flights = [{"timestamp": "2024-01-01T00:00:00", "flight_id": str(i), "engine_temp": 895 + i, "fuel_level": 50} for i in range(10)]
    write_log(spark, folder, flights, 2)
    plan = PLANS["aviation_status"]
    rows = decode_json(folder_stream(spark, folder, 1), plan.schema)
    finish(plan.write(rows, str(tmp_path / "t"), str(tmp_path / "c1")))
    finish(runs.to_archive(plan.run(rows), str(tmp_path / "a"), str(tmp_path / "c2")))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.select("batch_id").distinct().count() == 2
    assert table.filter("status = 'CRITICAL'").count() == 4
    assert spark.read.parquet(str(tmp_path / "a")).count() == 10


def test_csv_folder_to_alert_table(spark, tmp_path):
    plan = PLANS["tab_switchers"]
    folder = tmp_path / "in"
    folder.mkdir()
    header = "student_id,exam_id,event,duration\n"
    (folder / "a.csv").write_text(header + "STUDENT-1042,E,TAB_SWITCH,1.0\n" * 6 + "STUDENT-1,E,ANSWER,1.0\n")
    assert plan.run(csv_table(spark, str(folder), plan.schema)).count() == 1
    write = lambda: finish(plan.write(csv_arrivals(spark, str(folder), plan.schema), str(tmp_path / "t"), str(tmp_path / "c")))
    write()
    (folder / "b.csv").write_text(header + "STUDENT-1,E,TAB_SWITCH,1.0\n")
    write()
    out = spark.read.parquet(str(tmp_path / "t"))
    assert column(out, "batch_id", "student_id", "switches") == [(0, "STUDENT-1042", 6)]


def test_ranks_and_totals_on_a_stream(spark, tmp_path):
    folder = str(tmp_path / "log")
    scores = [{"player": p, "points": n} for p, n in (("a", 10), ("b", 30), ("a", 5), ("b", 5), ("c", 99), ("a", 200))]
    write_log(spark, folder, scores, 3)
    plan = PLANS["player_ranks"]
    rows = decode_json(folder_stream(spark, folder, 1), plan.schema, keep=plan.keep)
    finish(plan.write(rows, str(tmp_path / "t"), str(tmp_path / "c")))
    out = spark.read.parquet(str(tmp_path / "t")).orderBy("offset")
    assert column(out, "total_score", "current_rank") == [(10, 0), (30, 0), (15, 1), (35, 0), (99, 0), (215, 0)]


def test_enriched_documents_on_a_stream(spark, tmp_path):
    folder = str(tmp_path / "log")
    views = [{"user_id": "u", "product_id": i, "category": "books"} for i in range(6)]
    write_log(spark, folder, views, 3)
    out = PLANS["interest_profile"].run_documents(folder_stream(spark, folder, 1))
    each = lambda batch, n: append_documents(batch, str(tmp_path), "profiles", n)
    finish(runs.to_batches(out, each, str(tmp_path / "c")))
    back = documents(spark, str(tmp_path), "profiles", out.schema)
    assert sorted((r["parsed_data"]["product_id"], r["enriched_interest"]) for r in back.collect()) == [
        (i, i + 1) for i in range(6)
    ]


def test_sensor_folds_on_a_stream(spark, tmp_path):
    """Windows come out once the watermark has passed them, their state is gone then."""
    rng = random.Random(8)
    rows = [(i, rng.choice("ab"), float(rng.randint(10, 30)), AT + dt.timedelta(seconds=i)) for i in range(60)]
    closing = [(1000 + i, "a", 0.0, AT + dt.timedelta(seconds=1000 + i)) for i in range(3)]
    folder = str(tmp_path / "in")
    write_files(spark, folder, rows + closing, S.SENSOR, 9)
    plan = PLANS["sensor_folds"]
    stream = parquet_arrivals(spark, folder, S.SENSOR, files_per_trigger=1)
    finish(plan.write(stream, str(tmp_path / "t"), str(tmp_path / "c")))
    got = spark.read.parquet(str(tmp_path / "t"))
    want = plan.run(spark.createDataFrame(rows, S.SENSOR))
    by_window = lambda df: {(r["window_start"], r["window_end"], r["sensor"]): r["folded"] for r in df.collect()}
    assert got.count() == want.count() and by_window(got) == pytest.approx(by_window(want))


def test_scores_by_a_model_on_a_stream(spark, tmp_path):
    rows = [(str(i), 10.0 * i, 1.0, 0.0) for i in range(20)]
    spark.createDataFrame(rows, S.TRANSACTION).write.parquet(str(tmp_path / "in"))
    model = fit_clusters(spark.createDataFrame(rows, S.TRANSACTION), ["amount", "distance_km"])
    stream = parquet_arrivals(spark, str(tmp_path / "in"), S.TRANSACTION)
    finish(PLANS["transaction_clusters"].write(stream, str(tmp_path / "t"), str(tmp_path / "c"), model=model))
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("prediction").count().count() == 2


def test_every_streaming_plan_starts_on_an_empty_stream(spark, tmp_path):
    """Analysis of each plan as a stream: schema, output mode and state fit together."""
    dims = {
        "dynamic_prices": {"base_prices": spark.createDataFrame([], "item_id string, base_price double")},
        "overheating_devices": {"limits": spark.createDataFrame([], "device_id string, limit int")},
        "zone_violations": {"planned": spark.createDataFrame([], "truck_id string, planned_zone string")},
        "patient_risk": {"limits": spark.createDataFrame([], "patient_id string, max_bpm int")},
        "click_profiles": {"users": spark.createDataFrame([], "user_id int, name string, risk string")},
        "comment_sentiment": {"lexicon": {"good": 1.0}},
    }
    for name, plan in PLANS.items():
        if plan.mode == "batch" or name in ("transaction_clusters", "event_type_counts", "negative_volume"):
            continue
        schema = S.schema(**{c: "long" for c in plan.keep})
        for field in plan.schema.fields:
            schema.add(field)
        folder = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(f"{folder}/in")
        stream = parquet_arrivals(spark, f"{folder}/in", schema)
        finish(plan.write(stream, f"{folder}/out", f"{folder}/check", **dims.get(name, {})))


def test_documents_with_undeclared_fields(spark):
    views = [{"user_id": "u1", "product_id": 1, "category": "books", "page": {"from": "x"}}]
    out = PLANS["interest_profile"].run_documents(logged(spark, views), whole=True).select(F.to_json("parsed_data").alias("p"))
    assert out.first()["p"] == '{"category":"books","page":{"from":"x"},"product_id":1,"user_id":"u1"}'
