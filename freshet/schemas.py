"""Declared schemas of the event payloads and file tables.

Epoch columns are double: a float32 near the present has steps of 128 seconds.
"""

from __future__ import annotations

from pyspark.sql import types as T


def schema(**fields: str) -> T.StructType:
    """A schema from column names and simple type names."""
    made = T.StructType()
    for name, kind in fields.items():
        made.add(name, kind)
    return made


# A log record as the message broker delivers it.
LOG = schema(
    key="binary", value="binary", topic="string", partition="integer", offset="long", timestamp="timestamp",
)

# JSON payloads.
FLIGHT = schema(
    timestamp="timestamp", flight_id="string", altitude="integer", speed="integer", engine_temp="integer",
    fuel_level="integer",
)
VITALS = schema(
    patient_id="integer", timestamp="double", heart_rate="integer", systolic_bp="integer",
    diastolic_bp="integer", spo2="integer",
)
TRANSACTION = schema(transaction_id="string", amount="double", distance_km="double", timestamp="double")
STOCK = schema(symbol="string", price="float", timestamp="double")
COMMENT = schema(text="string", timestamp="double")
GRID = schema(transformer_id="string", voltage="integer", load="integer", timestamp="double")
NETWORK = schema(source_ip="string", port="string", timestamp="timestamp")
SCORE = schema(player_id="string", score="integer", timestamp="double")
SALE = schema(store_id="string", product_id="string", quantity="integer", timestamp="double")
RIDE = schema(region="string", user_id="string", timestamp="double")
CLAIM = schema(claim_id="integer", policy_age="integer", amount="integer", timestamp="double")
PAGE_VIEW = schema(user_id="string", product_id="integer", category="string")
DEMAND = schema(item_id="string", demand_index="integer", timestamp="double")
CARD_USE = schema(card_id="string", amount="integer", country="string")
THERMOSTAT = schema(device_id="string", temp="integer")
TRUCK = schema(truck_id="string", current_zone="string")
OFFERED_ZONE = schema(truck_id="string", current_zone="string", offered_zone="string")
PLAYER = schema(player="string", points="integer")
QUOTE = schema(symbol="string", price="integer")
POST = schema(post_id="integer", tag="string")
PATIENT = schema(patient_id="string", bpm="integer")
LOGIN = schema(src_ip="string", action="string", status="string")
TYPED_EVENT = schema(tipo="string")
CHANGED_ROW = schema(id="integer", status="string")

# CSV tables.
VEHICLE = schema(
    vehicle_id="integer", speed_kmh="double", engine_rpm="double", oil_temp="double", timestamp="timestamp",
    driving_style="string",
)
VEHICLE_LOG = schema(
    vehicle_id="integer", speed_kmh="double", rpm="double", oil_temp="double", timestamp="timestamp",
    aggressive_flag="double",
)
TRAFFIC = schema(intersection_id="string", timestamp="timestamp", vehicle_count="integer", avg_speed="double")
ROUTE = schema(
    route_id="string", truck_id="integer", timestamp="timestamp", distance_km="double",
    duration_min="double", fuel_consumed_l="double",
)
DELIVERY = schema(
    route_id="string", truck_id="integer", delivery_time_min="double", distance_km="double",
    fuel_consumed_l="double",
)
MACHINE = schema(machine_id="string", timestamp="timestamp", vibration="double", temperature="double")
SOIL = schema(
    zone_id="string", sensor_id="string", timestamp="timestamp", moisture_percent="double",
    temperature_c="double",
)
CALL = schema(
    call_id="integer", tower_id="string", timestamp="timestamp", duration_sec="double", status="string",
)
WEATHER = schema(station_id="string", timestamp="timestamp", temp_c="double", humidity="double")
WEATHER_YEAR = schema(station_id="string", timestamp="string", temperature="double", humidity="double")
BOOKING = schema(
    hotel_id="string", booking_id="integer", check_in="timestamp", nights="integer", price="double",
    status="string",
)
BOOKING_MONTH = schema(
    booking_id="integer", hotel_id="string", check_in="timestamp", nights="integer",
    price_per_night="double", status="string",
)
EXAM_EVENT = schema(student_id="string", exam_id="string", event="string", duration="double")
EXAM_LOG = schema(exam_id="string", student_id="string", event_type="string", time_spent_sec="double")

# Row collections and documents.
CLICK = schema(user_id="integer", url="string")
PAYMENT = schema(id="integer", amount="double", country="string")
SENSOR = schema(seq="long", sensor="string", temp="double", ts="timestamp")
SEQUENCE = schema(id="long", val="integer")
SERVER_LOG = schema(id="string", level="string", service="string", message="string", timestamp="long")
PRODUCT = schema(sku="string", name="string", category="string", price="double")
CUSTOMER = schema(id="long", spend="long", visits="long")
SALE_TRX = schema(sale_id="long", customer_id="long", amount="long")
