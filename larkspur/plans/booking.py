"""Ready-made declarations for a table of bookings that are kept or cancelled.

Everything here is a fixed value: column names, types and label codes of the input table, of the logged requests and of
the monitoring table.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from larkspur.operators.prep import FeatureSpec

KEY = "Booking_ID"
TARGET = "booking_status"
LABELS = {"Canceled": 1, "Not_Canceled": 0}

NUMERIC = (
    "no_of_adults",
    "no_of_children",
    "no_of_weekend_nights",
    "no_of_week_nights",
    "required_car_parking_space",
    "lead_time",
    "arrival_year",
    "arrival_month",
    "arrival_date",
    "repeated_guest",
    "no_of_previous_cancellations",
    "no_of_previous_bookings_not_canceled",
    "avg_price_per_room",
    "no_of_special_requests",
)
PRICE = "avg_price_per_room"
CATEGORICAL = ("type_of_meal_plan", "room_type_reserved", "market_segment_type")

# Columns that drift doubles, and the column it moves to later years.
DRIFT_SCALED = ("no_of_previous_cancellations", "no_of_previous_bookings_not_canceled")
DRIFT_YEAR = "arrival_year"

TEST_SIZE, SEED = 0.2, 42
MODEL = "lightgbm"
MODEL_PARAMS = {"random_state": 42, "n_estimators": 300, "max_depth": 6, "learning_rate": 0.01}


def _declared(name: str, dtype: str) -> dict[str, str]:
    return {"name": name, "alias": name, "dtype": dtype}


SPEC = FeatureSpec(
    keys=[KEY],
    numeric=[_declared(c, "float64" if c == PRICE else "int16") for c in NUMERIC],
    categorical=[_declared(c, "category") for c in CATEGORICAL],
    target={"name": TARGET, "alias": TARGET, "dtype": "int", "mapping": LABELS},
)


def _fields(names, kind, special):
    return [StructField(c, special.get(c, kind)) for c in names]


# The columns of a logged request's record, and those the monitoring table takes from it.
RECORD = StructType(
    [
        StructField(KEY, StringType()),
        *_fields(NUMERIC, IntegerType(), {PRICE: DoubleType()}),
        *_fields(CATEGORICAL, StringType(), {}),
    ]
)
_RENAMED = ("arrival_year", "arrival_month", "arrival_date")
MONITORED = {c: f"hotel_{c}" if c in _RENAMED else c for c in (KEY, *NUMERIC)}

FEATURE_TABLE = StructType(
    [
        StructField(KEY, StringType(), False),
        *_fields(NUMERIC, LongType(), {PRICE: DoubleType()}),
        *_fields(CATEGORICAL, StringType(), {}),
        StructField("update_timestamp_utc", TimestampType()),
    ]
)
