"""The given ``events`` table read as road-traffic records.

``event_id`` is the arrival order, a user is a route, ``value`` is the speed.
Sign-ups stand for weather reports of the district, the rest for sensor records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadstate.functions.scalars import calendar
from roadstate.schemas import CLASS_COUNTS, CLASS_RATIOS, SENSOR_SCHEMA

# Class shares of the record builder.
CLASS_SHARES = {"truck": 0.02, "bus": 0.03, "motorbike": 0.8, "car": 0.1, "taxi": 0.05}

_ROUTE = {
    "road_name": "concat('r', user_id)",
    "district": "concat('d', user_id % 12)",
    "city": "concat('c', user_id % 3)",
}
_WEATHER = {
    "accident_count": "IF(event_type = 'error', CAST(floor(value / 30) AS BIGINT), 0L)",
    "temperature_celsius": "20.0D + event_id % 15",
    "humidity_percentage": "60.0D + event_id % 40",
    "weather_condition": (
        "CASE event_id % 4 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Rain' END"
    ),
    "is_rain": "CAST(event_id % 4 = 2 AS INT)",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_traffic(events: DataFrame) -> DataFrame:
    """All events as complete records, weather columns included."""
    base = events.select(
        F.col("event_id").alias("seq"),
        "event_type",
        "props",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("ts").alias("event_ts"),
        F.to_date("ts").alias("dt"),
        *[F.expr(e).alias(c) for c, e in _ROUTE.items()],
        # Every tenth position is missing.
        F.expr("IF(event_id % 10 = 0, NULL, 21.0D + (event_id % 1000) / 10000.0D)").alias("latitude"),
        F.expr("IF(event_id % 10 = 0, NULL, 105.0D + (event_id % 1000) / 10000.0D)").alias("longitude"),
        F.expr("event_id % 500").alias("vehicle_count"),
        F.col("value").alias("avg_speed"),
        F.expr("value * 0.5D").alias("min_speed"),
        F.expr("value * 1.6D").alias("max_speed"),
        F.expr("round(greatest(0.0D, (25.0D - value) * 0.8D), 2)").alias("avg_delay_minutes"),
        *[
            F.expr(f"CAST(floor((event_id % 500) * {share}D) AS BIGINT)").alias(c)
            for c, share in zip(CLASS_COUNTS, CLASS_SHARES.values(), strict=True)
        ],
        *[
            F.lit(share).alias(c)
            for c, share in zip(CLASS_RATIOS, CLASS_SHARES.values(), strict=True)
        ],
        *[F.expr(e).alias(c) for c, e in _WEATHER.items()],
    )
    return base.withColumns(calendar("event_ts"))


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_traffic(read_events(spark, sf_dir))


def sensor_part(records: DataFrame) -> DataFrame:
    """Sensor records: no weather fields, except that every fifth record carries
    an explicit null temperature."""
    fields = [*_WEATHER]
    carried = F.when(F.col("seq") % 5 == 0, F.array(F.lit("temperature_celsius"))).otherwise(
        F.array().cast("array<string>")
    )
    rows = records.where(F.col("event_type") != "signup")
    blank = {c: F.lit(None).cast(SENSOR_SCHEMA[c].dataType) for c in fields}
    return rows.withColumns(blank | {"present": carried})


def weather_part(records: DataFrame) -> DataFrame:
    """Weather reports: district, city and the weather fields."""
    return records.where(F.col("event_type") == "signup").select("seq", "district", "city", *_WEATHER)


def sensor_stream(spark: SparkSession, sf_dir: str, options: dict[str, str] | None = None) -> DataFrame:
    """The events table as a stream of records."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet")
    return as_traffic(reader.options(**(options or {})).parquet(sf_dir))
