"""Serving queries over enriched events, alerts and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roadstate.functions.scalars import blank_to, road_status
from roadstate.operators.aggregates import count_where, summary, top, value_counts
from roadstate.operators.enrich import latest_non_null, latest_row
from roadstate.schemas import ROUTE_KEYS

# Row limits of the reports.
BOARD_ROWS, ALERT_ROWS, PREDICTION_ROWS, TOP_ROADS = 500, 300, 500, 20

BOARD_VALUES = [
    "latitude",
    "longitude",
    "avg_speed",
    "vehicle_count",
    "avg_delay_minutes",
    "accident_count",
    "weather_condition",
    "is_rain",
]
ALERT_COLUMNS = [
    "alert_time",
    "alert_category",
    *ROUTE_KEYS,
    "severity",
    "avg_speed",
    "avg_delay_minutes",
    "accident_count",
    "message",
    "source_topic",
]
PREDICTION_COLUMNS = [
    "prediction_time",
    *ROUTE_KEYS,
    "forecast_horizon_minutes",
    "current_cluster",
    "predicted_cluster",
    "predicted_traffic_status",
    "expected_avg_speed",
    "expected_avg_delay_minutes",
    "model_status",
]


def _by_route() -> list[Column]:
    return [F.col(c).asc() for c in ROUTE_KEYS]


def _worst_first() -> list[Column]:
    """Longest delay, then lowest speed; the route settles ties."""
    return [
        F.col("avg_delay_minutes").desc_nulls_last(),
        F.col("avg_speed").asc_nulls_last(),
        *_by_route(),
    ]


def road_states(events: DataFrame, order: Sequence[str] = ("event_ts", "seq")) -> DataFrame:
    """Latest known values and status of every route, unlimited."""
    latest = latest_non_null(events, BOARD_VALUES, ROUTE_KEYS, order)
    status = road_status("accident_count", "avg_speed", "avg_delay_minutes")
    return latest.withColumn("road_status", status)


def road_status_board(
    events: DataFrame, n: int = BOARD_ROWS, order: Sequence[str] = ("event_ts", "seq")
) -> DataFrame:
    return top(road_states(events, order), _worst_first(), n)


def top_delayed(board: DataFrame, n: int = TOP_ROADS) -> DataFrame:
    columns = [*ROUTE_KEYS, "avg_delay_minutes", "avg_speed"]
    return top(board.select(*columns), _worst_first(), n)


def recent_alerts(alerts: DataFrame, n: int = ALERT_ROWS) -> DataFrame:
    """Newest alerts; the remaining columns settle ties."""
    ties = [F.col(c).asc_nulls_last() for c in ALERT_COLUMNS[1:]]
    return top(alerts.select(*ALERT_COLUMNS), [F.col("alert_time").desc_nulls_last(), *ties], n)


def newest_predictions(predictions: DataFrame) -> DataFrame:
    """The last prediction of every route, unlimited."""
    ties = [F.col(c).asc_nulls_last() for c in PREDICTION_COLUMNS[4:]]
    order = [F.col("prediction_time").desc_nulls_last(), *ties]
    return latest_row(predictions.select(*PREDICTION_COLUMNS), ROUTE_KEYS, order)


def latest_predictions(predictions: DataFrame, n: int = PREDICTION_ROWS) -> DataFrame:
    order = [F.col("prediction_time").desc_nulls_last(), *_by_route()]
    return top(newest_predictions(predictions), order, n)


def board_with_predictions(board: DataFrame, predictions: DataFrame) -> DataFrame:
    """Board rows with the prediction of their route where there is one."""
    return board.join(predictions, ROUTE_KEYS, "left")


def traffic_summary(events: DataFrame) -> DataFrame:
    return summary(events)


def status_counters(board: DataFrame) -> DataFrame:
    """Routes per problem status and their sum."""
    status = F.col("road_status")
    counts = count_where(
        board,
        {
            "congested_roads": status == "CONGESTED",
            "slow_roads": status == "SLOW",
            "accident_roads": status == "ACCIDENT",
        },
    )
    total = F.col("congested_roads") + F.col("slow_roads") + F.col("accident_roads")
    return counts.withColumn("problem_roads", total)


def alert_counters(alerts: DataFrame) -> DataFrame:
    category = F.col("alert_category")
    return count_where(
        alerts,
        {
            "recent_alerts": F.lit(True),
            "accident_alerts": category == "accident",
            "congestion_alerts": category == "congestion",
        },
    )


def prediction_counters(predictions: DataFrame) -> DataFrame:
    status = F.col("model_status")
    return count_where(
        predictions,
        {
            "prediction_rows": F.lit(True),
            "loaded_predictions": status == "loaded",
            "unavailable_predictions": status == "unavailable",
        },
    )


def predicted_status_distribution(predictions: DataFrame) -> DataFrame:
    named = predictions.select(blank_to("predicted_traffic_status").alias("predicted_status"))
    return value_counts(named, "predicted_status", "count")
