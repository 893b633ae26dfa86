"""Column lists and ``StructType`` definitions shared by every module.

The names and their order are the data contract: any store written by this
package can be read by name or by position.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column families of an enriched event, in table order.
ROUTE_KEYS = ["road_name", "district", "city"]
AREA_KEYS = ["district", "city"]
POSITION = ["latitude", "longitude"]
FLOW = ["vehicle_count", "avg_speed", "min_speed", "max_speed", "avg_delay_minutes"]
CLASS_COUNTS = ["truck_count", "bus_count", "motorbike_count", "car_count", "taxi_count"]
CLASS_RATIOS = ["truck_ratio", "bus_ratio", "motorbike_ratio", "car_ratio", "taxi_ratio"]
WEATHER = [
    "accident_count",
    "temperature_celsius",
    "humidity_percentage",
    "weather_condition",
    "is_rain",
]
CALENDAR = ["hour", "day_of_week", "is_weekend", "is_peak_hour"]
LAGS = {
    "avg_speed": "prev_avg_speed",
    "vehicle_count": "prev_vehicle_count",
    "avg_delay_minutes": "prev_delay",
}
LAG_COLUMNS = [f"{prefix}_{k}" for prefix in LAGS.values() for k in (1, 2, 3)]
ROLLING = {
    "avg_speed": "rolling_avg_speed_3",
    "vehicle_count": "rolling_vehicle_count_3",
    "avg_delay_minutes": "rolling_delay_3",
}
ROLLING_COLUMNS = list(ROLLING.values())
TARGETS = ["target_15m", "target_30m", "target_60m"]
LONGTERM_FEATURES = [
    "baseline_speed_7d",
    "avg_speed_hour_dow_4w",
    "avg_delay_hour_dow_4w",
    "avg_delay_same_hour_yesterday",
    "avg_speed_same_hour_yesterday",
]

BUSINESS_COLUMNS = (
    ROUTE_KEYS
    + POSITION
    + FLOW
    + CLASS_COUNTS
    + CLASS_RATIOS
    + WEATHER
    + CALENDAR
    + LAG_COLUMNS
    + ROLLING_COLUMNS
)
SERVING_COLUMNS = ["timestamp"] + BUSINESS_COLUMNS
LINEAGE = [
    "timestamp",
    "event_ts",
    "dt",
    "ingested_at",
    "source_topic",
    "source_partition",
    "source_offset",
]
ENRICHED_COLUMNS = LINEAGE + BUSINESS_COLUMNS
MODEL_FEATURES = (
    FLOW
    + CLASS_RATIOS
    + ["accident_count", "temperature_celsius", "humidity_percentage", "is_rain"]
    + CALENDAR
    + LAG_COLUMNS
    + ROLLING_COLUMNS
    + LONGTERM_FEATURES
)

# Topic names of the event bus.
TOPIC_SENSOR = "trafic.raw_sensor"
TOPIC_WEATHER = "trafic.raw_weather"
TOPIC_ENRICHED = "trafic.enriched_events"
TOPIC_PREDICTIONS = "trafic.predictions"
TOPIC_CONGESTION = "trafic.congestion_alerts"
TOPIC_ACCIDENT = "trafic.accident_anomaly_alerts"

_STRING, _DOUBLE, _LONG, _INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_NTZ, _DATE, _BOOL = T.TimestampNTZType(), T.DateType(), T.BooleanType()

_TYPES: dict[str, T.DataType] = {
    **{c: _STRING for c in ["timestamp", "source_topic", "weather_condition", *ROUTE_KEYS]},
    **{c: _NTZ for c in ["event_ts", "ingested_at", "source_cutoff", "updated_at", "created_at"]},
    **{c: _INT for c in ["source_partition", "is_rain", *CALENDAR]},
    **{c: _LONG for c in ["source_offset", "vehicle_count", "accident_count", *CLASS_COUNTS]},
    "dt": _DATE,
}


def struct_of(columns: list[str], **overrides: T.DataType) -> T.StructType:
    """A schema for ``columns``; anything not typed above is a double."""
    types = {**_TYPES, **overrides}
    return T.StructType([T.StructField(c, types.get(c, _DOUBLE)) for c in columns])


SENSOR_SCHEMA = struct_of(
    ["timestamp", *ROUTE_KEYS, *POSITION, *FLOW, *CLASS_COUNTS, *CLASS_RATIOS, *WEATHER, *CALENDAR]
)
WEATHER_SCHEMA = struct_of(AREA_KEYS + WEATHER)
TOPIC_SCHEMA = struct_of(SERVING_COLUMNS)
ENRICHED_SCHEMA = struct_of(ENRICHED_COLUMNS)
LONGTERM_SCHEMA = struct_of(
    ROUTE_KEYS + ["hour", "day_of_week"] + LONGTERM_FEATURES + ["source_cutoff", "dt", "updated_at"]
)
TRAINING_SCHEMA = struct_of(
    ["training_run_id", "dt", "created_at", "event_ts", *ROUTE_KEYS]
    + MODEL_FEATURES
    + ["feature_source_cutoff"],
    training_run_id=_STRING,
    vehicle_count=_DOUBLE,
    accident_count=_DOUBLE,
    is_rain=_DOUBLE,
    is_weekend=_DOUBLE,
    is_peak_hour=_DOUBLE,
    feature_source_cutoff=_NTZ,
)
PREDICTION_STRUCT = T.StructType(
    [
        T.StructField("forecast_horizon_minutes", _INT),
        T.StructField("current_cluster", _INT),
        T.StructField("predicted_cluster", _INT),
        T.StructField("traffic_status", _STRING),
        T.StructField("expected_avg_speed", _DOUBLE),
        T.StructField("expected_avg_delay_minutes", _DOUBLE),
        T.StructField("model_status", _STRING),
    ]
)
PREDICTION_SCHEMA = T.StructType(
    [T.StructField(c, _STRING) for c in [*ROUTE_KEYS, "timestamp"]]
    + [T.StructField("prediction_30m", PREDICTION_STRUCT)]
)
CONGESTION_SCHEMA = T.StructType(
    [T.StructField(c, _STRING) for c in ["alert_type", "severity", *ROUTE_KEYS, "timestamp"]]
    + [
        T.StructField("avg_speed", _DOUBLE),
        T.StructField("vehicle_count", _LONG),
        T.StructField("low_speed_event_count", _LONG),
        T.StructField("low_speed_duration_minutes", _LONG),
        T.StructField("rule", _STRING),
        T.StructField(
            "matched_by",
            T.StructType(
                [T.StructField(c, _BOOL) for c in ["consecutive_events", "duration"]]
            ),
        ),
    ]
)
ACCIDENT_SCHEMA = T.StructType(
    [T.StructField(c, _STRING) for c in ["alert_type", "severity", *ROUTE_KEYS, "timestamp"]]
    + [
        T.StructField("accident_count", _LONG),
        T.StructField("history_avg_accident_count", _DOUBLE),
        T.StructField("history_max_accident_count", _LONG),
        T.StructField("avg_speed", _DOUBLE),
        T.StructField("vehicle_count", _LONG),
        T.StructField("rule", _STRING),
        T.StructField(
            "matched_by",
            T.StructType(
                [
                    T.StructField(c, _BOOL)
                    for c in [
                        "first_accident_after_clean_history",
                        "spike_vs_history",
                        "multi_accident",
                    ]
                ]
            ),
        ),
    ]
)
