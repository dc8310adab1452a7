"""Values the plans are defined by."""

# Thresholds, labels, window sizes, defaults and word lists that
# results must agree on. Rules are (condition, label), the first that holds wins.

AVIATION_RULES = (("engine_temp > 900", "CRITICAL"), ("fuel_level < 20", "LOW_FUEL"))
AVIATION_DEFAULT = "NORMAL"
AVIATION_HOT_ENGINE = 850

FAST_VEHICLE_KMH = 110

VITALS_RULES = (("spo2 < 90 or heart_rate > 130", "CRITICAL"), ("systolic_bp > 160", "WARNING"))
VITALS_STRICT_RULES = (("spo2 < 90 or heart_rate > 120", "CRITICAL"),)
VITALS_DEFAULT = "NORMAL"

CLUSTERS = 2
CLUSTER_SEED = 1

SIGNAL_RULES = (("vehicle_count > 35", "EXTEND_GREEN_30S"), ("vehicle_count > 25", "EXTEND_GREEN_15S"))
SIGNAL_DEFAULT = "NORMAL_CYCLE"
GREEN_RULES = (("vehicle_count > 25", 45), ("vehicle_count > 20", 35))
GREEN_DEFAULT = 30
GREEN_TOP = 10

STOCK_WINDOW = "10 seconds"
STOCK_SLIDE = "5 seconds"

SENTIMENT_HIGH = 0.1
SENTIMENT_LOW = -0.1
NEGATIVES_PER_BATCH = 5
POSITIVE_WORDS = ("amei", "ótimo", "excelente", "fantástico", "bom")
NEGATIVE_WORDS = ("odiei", "péssimo", "horrível", "ruim", "lento")
POSITIVE, NEGATIVE, NEUTRAL = "POSITIVO", "NEGATIVO", "NEUTRO"

GRID_RULES = (("voltage > 240 or voltage < 110", "ANOMALY"),)
GRID_DEFAULT = "NORMAL"

HEALTH_FULL = 100
HEALTH_VIBRATION = 0.5
HEALTH_TEMPERATURE = 0.3
HEALTH_LOW = 40
MACHINE_VIBRATION_HIGH = 60
MACHINE_TEMPERATURE_HIGH = 85

INTRUSION_WINDOW = "5 seconds"
INTRUSION_WATERMARK = "10 seconds"
INTRUSION_REQUESTS = 50
INTRUSION_LABEL = "POSSIBLE DDOS"

MOISTURE_LOW = 25
IRRIGATION_RULES = (("moisture_percent < 30", "ATIVAR"),)
IRRIGATION_DEFAULT = "AGUARDAR"

LEADERBOARD_TOP = 5

DROPPED = "DROP"
DROP_RATE_HIGH = 0.10
TOWERS_TOP = 5

RESTOCK_SOLD = 10
INITIAL_STOCK = 300
STOCK_LOW = 250

HEATWAVE = 35
HOT_DAY = 40
HOT_DAYS_TOP = 20

SURGE_WINDOW = "10 seconds"
SURGE_WATERMARK = "10 seconds"
SURGE_RULES = (("count > 50", 2.0), ("count > 20", 1.5))
SURGE_DEFAULT = 1.0

CONFIRMED = "CONFIRMED"

CLAIM_RULES = (("amount > 50000 and policy_age < 1", "HIGH"), ("amount > 70000", "MEDIUM"))
CLAIM_DEFAULT = "LOW"

TAB_SWITCH = "TAB_SWITCH"
TAB_SWITCHES = 5
TAB_SWITCHES_REVIEW = 20
FAST_ANSWER_SEC = 10
FAST_ANSWERS_REVIEW = 30

BASE_PRICE = 100.0
PRICE_STEP = 0.05

DEVICE_LIMIT = 28
DEVICE_HOT, DEVICE_OK = "OVERHEATING", "NORMAL"

PLANNED_ZONE = "transit"

BUY_BELOW = 150
BUY, HOLD = "BUY", "HOLD"

PULSE_LIMIT = 120
PULSE_ELEVATED = 100
PULSE_LABELS = ("CRITICAL", "ELEVATED", "LOW")

LOGIN_FAILED = "fail"
LOGIN_FAILURES = 5

HIGH_VALUE = 10000
HIGH_VALUE_MESSAGE = "ALERT: High value transaction %s detected: $%s"

UNKNOWN_PROFILE = {"name": "Unknown", "risk": "unknown"}

PREMIUM_CATEGORY = "Electronics"
PREMIUM_PRICE = 200

SIEM_EVERY = 10
SIEM_LABELS = ("MALICIOUS", "NORMAL")
SIEM_ADDRESS = "192.168.1.1"
SIEM_SAMPLE = 5

VIP_SPEND = 500
VIP, REGULAR = "VIP", "Regular"

JOIN_SAMPLE = 5

TYPE_WINDOW = "5 seconds"
