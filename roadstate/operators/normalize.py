"""Raw JSON messages to typed rows; the same functions serve batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from roadstate.functions.scalars import (
    best_effort_time,
    first_json,
    json_doc,
    json_double,
    json_int,
    json_long,
    json_text,
)
from roadstate.operators.clusters import HORIZON_MINUTES
from roadstate.schemas import PREDICTION_STRUCT, ROUTE_KEYS, TOPIC_ACCIDENT, TOPIC_CONGESTION, TOPIC_PREDICTIONS, TOPIC_SCHEMA

# Defaults of the alert feeds.
DEFAULT_MESSAGE = "Congestion alert"
DEFAULT_SEVERITY = "warning"
FEED_TOPICS = {"congestion": TOPIC_CONGESTION, "accident": TOPIC_ACCIDENT}

CORRUPT = "_corrupt"


def parse_records(
    raw: DataFrame, schema: T.StructType, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Split messages into typed rows and rejected rows.

    Rejected: text that is not a JSON object of the schema's types. Other
    columns (topic coordinates) stay next to the fields; ``present`` lists the
    fields the message carried, null ones included.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    others = [c for c in raw.columns if c != value]
    text = F.col(value).cast("string")
    parsed = raw.select(
        *others,
        text.alias("raw_message"),
        F.from_json(text, wide, {"columnNameOfCorruptRecord": CORRUPT}).alias("_record"),
    )
    bad = F.col("_record").isNull() | F.col(f"_record.{CORRUPT}").isNotNull()
    good = parsed.where(~bad).select(
        *others, *[F.col(f"_record.{f.name}").alias(f.name) for f in schema.fields],
        F.json_object_keys("raw_message").alias("present"),
    )
    return good, parsed.where(bad).select(*others, "raw_message")


def typed_events(raw: DataFrame, schema: T.StructType = TOPIC_SCHEMA, value: str = "value") -> DataFrame:
    """Enriched-event messages as typed columns with ``event_time`` in front."""
    rows, _ = parse_records(raw, schema, value)
    names = [f.name for f in schema.fields]
    return rows.select(best_effort_time(F.col("timestamp")).alias("event_time"), *names)


ALERT_FIELDS = [
    "alert_time", "timestamp", "event_time", "road_name", "road", "district", "city", "severity", "level",
    "avg_speed", "avg_delay_minutes", "accident_count", "message", "reason",
]
PREDICTION_FIELDS = PREDICTION_STRUCT.names


def normalize_alerts(
    raw: DataFrame,
    category: str,
    default_message: str = DEFAULT_MESSAGE,
    source_topic: str | None = None,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Alert messages of one feed as rows of the common alert table."""
    text = F.col(value).cast("string")
    docs = raw.select(*keep, text.alias("raw_message"), json_doc(text, *ALERT_FIELDS).alias("_doc"))
    doc = F.col("_doc")
    return docs.select(
        *keep,
        best_effort_time(
            json_text(doc["alert_time"]), json_text(doc["timestamp"]), json_text(doc["event_time"])
        ).alias("alert_time"),
        F.lit(category).alias("alert_category"),
        first_json(doc["road_name"], doc["road"], default="").alias("road_name"),
        first_json(doc["district"], default="").alias("district"),
        first_json(doc["city"], default="").alias("city"),
        first_json(doc["severity"], doc["level"], default=DEFAULT_SEVERITY).alias("severity"),
        json_double(doc["avg_speed"]).alias("avg_speed"),
        json_double(doc["avg_delay_minutes"]).alias("avg_delay_minutes"),
        json_long(doc["accident_count"]).alias("accident_count"),
        first_json(doc["message"], doc["reason"], default=default_message).alias("message"),
        F.lit(source_topic or FEED_TOPICS[category]).alias("source_topic"),
        "raw_message",
    )


def normalize_predictions(
    raw: DataFrame, source_topic: str = TOPIC_PREDICTIONS, value: str = "value"
) -> DataFrame:
    """Prediction messages as flat rows."""
    text = F.col(value).cast("string")
    wanted = json_doc(text, "timestamp", *ROUTE_KEYS, prediction_30m=PREDICTION_FIELDS)
    docs = raw.select(text.alias("raw_message"), wanted.alias("_doc"))
    doc, inner = F.col("_doc"), F.col("_doc.prediction_30m")
    return docs.select(
        best_effort_time(json_text(doc["timestamp"])).alias("prediction_time"),
        *[first_json(doc[c], default="").alias(c) for c in ROUTE_KEYS],
        json_int(inner["forecast_horizon_minutes"], 0).alias("forecast_horizon_minutes"),
        json_int(inner["current_cluster"]).alias("current_cluster"),
        json_int(inner["predicted_cluster"]).alias("predicted_cluster"),
        first_json(inner["traffic_status"], default="").alias("predicted_traffic_status"),
        json_double(inner["expected_avg_speed"]).alias("expected_avg_speed"),
        json_double(inner["expected_avg_delay_minutes"]).alias("expected_avg_delay_minutes"),
        first_json(inner["model_status"], default="").alias("model_status"),
        F.lit(source_topic).alias("source_topic"),
        "raw_message",
    )


def flatten_predictions(df: DataFrame) -> DataFrame:
    """Nested prediction records as flat rows; the horizon is constant."""
    nested = [
        "current_cluster",
        "predicted_cluster",
        "traffic_status",
        "expected_avg_speed",
        "expected_avg_delay_minutes",
        "model_status",
    ]
    return df.select(
        *ROUTE_KEYS,
        "timestamp",
        F.lit(HORIZON_MINUTES).alias("forecast_horizon_minutes"),
        *[F.col(f"prediction_30m.{c}").alias(c) for c in nested],
    )
