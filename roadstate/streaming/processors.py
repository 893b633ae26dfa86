"""Stateful processors: keyed state around the step functions.

A micro-batch bounds the rows one key can bring (set the rate option of the
source: ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``); state is one value or
a handful of rows per key. Rows of a key inside a micro-batch are put into
arrival order here, because a shuffle does not keep it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadstate.schemas import (
    ACCIDENT_SCHEMA,
    CONGESTION_SCHEMA,
    ROUTE_KEYS,
)
from roadstate.streaming import steps

# Columns with a leading underscore do not reach a processor.
SIDE = "side_tag"
# Prefix of the flags that tell which fields a record did carry.
CARRIED = "carried_"


def _arrived(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    return pd.concat(frames, ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)


def _plain(value):
    """A value the state store accepts."""
    if value is None or (not isinstance(value, (list, np.ndarray)) and pd.isna(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    if isinstance(value, np.ndarray):
        return value.tolist()
    return value.item() if isinstance(value, np.generic) else value


def _state_row(values, schema: T.StructType) -> tuple:
    """Plain values in schema order; integers that pandas widened come back."""
    whole = (T.IntegerType, T.LongType)
    return tuple(
        int(v) if v is not None and isinstance(f.dataType, whole) else v
        for v, f in zip(map(_plain, values), schema.fields, strict=True)
    )


class LatestFill(StatefulProcessor):
    """Latest update per key, applied to the events that follow it."""

    def __init__(self, schema: T.StructType, fields: Sequence[str], order: Sequence[str], present: str | None):
        self.schema, self.fields, self.order, self.present = schema, list(fields), list(order), present

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state_schema = T.StructType([self.schema[f] for f in self.fields])
        self.latest = handle.getValueState("latest", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        data = _arrived(rows, [*self.order, SIDE])
        known = self.latest.get() if self.latest.exists() else None
        before = None if known is None else dict(zip(self.fields, known, strict=True))
        is_update = (data[SIDE] == 0).to_numpy()
        newest, after = steps.latest_update(before, data, is_update, self.fields)
        if is_update.any():
            self.latest.update(_state_row([after[f] for f in self.fields], self.state_schema))
        events = data[~is_update]
        if len(events) == 0:
            return
        filled = {}
        for f in self.fields:
            own, new = events[f].astype(object), newest.loc[events.index, f]
            if self.present is None:
                filled[f] = own.where(own.notna(), new)
            else:
                filled[f] = own.where(events[f"{CARRIED}{f}"].astype(bool), new)
        out = events.assign(**filled)[self.schema.names]
        for f in self.schema.fields:
            if f.name in filled and not isinstance(f.dataType, T.StringType):
                out[f.name] = pd.to_numeric(out[f.name])
        yield out


class LagWindow(StatefulProcessor):
    """Look-back columns and the count window, on the last few rows of a key."""

    def __init__(
        self,
        schema: T.StructType,
        output: T.StructType,
        lags: Mapping[str, str],
        rolling: Mapping[str, str],
        order: Sequence[str],
        n: int,
        size: int,
        time_text: str,
        full_only: bool,
        emitted: Mapping[str, str],
    ):
        self.schema, self.output, self.order = schema, output, list(order)
        self.options = (dict(lags), dict(rolling), n, size, time_text, full_only, dict(emitted))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getListState("tail", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        data = _arrived(rows, self.order)[self.schema.names]
        earlier = pd.DataFrame(list(self.tail.get()), columns=self.schema.names)
        if len(earlier):
            earlier = earlier.astype({c: data[c].dtype for c in earlier if data[c].notna().any()}, errors="ignore")
        out, tail = steps.lags_and_window(earlier, data, *self.options)
        self.tail.put([_state_row(r, self.schema) for r in tail.itertuples(index=False, name=None)])
        if len(out):
            yield out[self.output.names]


def _pick(data: pd.DataFrame, mask: np.ndarray, columns: Sequence[str]) -> pd.DataFrame:
    return data.loc[mask, list(columns)].reset_index(drop=True)


class CongestionDetector(StatefulProcessor):
    """Open low-speed run per route: its length and start."""

    def __init__(self, order: Sequence[str], speed: float, events: int, minutes: int, rule: str, high: float):
        self.order, self.rule, self.high = list(order), rule, high
        self.speed, self.events, self.minutes = speed, events, minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "length bigint, since timestamp_ntz")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        data = _arrived(rows, self.order)
        length, since = self.run.get() if self.run.exists() else (0, None)
        speed = data["avg_speed"].astype("float64").fillna(0.0).to_numpy()
        times = data["row_time"].to_numpy().astype("datetime64[us]")
        low, lengths, starts, length, since = steps.low_speed_run(length, since, speed, times, self.speed)
        if length:
            self.run.update((length, pd.Timestamp(since).to_pydatetime()))
        elif self.run.exists():
            self.run.clear()
        elapsed = (times - starts).astype("timedelta64[us]").astype("int64")
        minutes = np.trunc(elapsed / 60_000_000).astype("int64")
        by_events, by_time = lengths >= self.events, minutes >= self.minutes
        fired = low & (by_events | by_time)
        if not fired.any():
            return
        out = _pick(data, fired, [*self.order, *ROUTE_KEYS, "timestamp", "vehicle_count"])
        yield out.assign(
            alert_type="long_congestion",
            severity=np.where(speed[fired] < self.high, "high", "medium"),
            avg_speed=speed[fired],
            low_speed_event_count=lengths[fired],
            low_speed_duration_minutes=np.maximum(minutes[fired], 0),
            rule=self.rule,
            matched_by=[
                {"consecutive_events": bool(a), "duration": bool(b)}
                for a, b in zip(by_events[fired], by_time[fired], strict=True)
            ],
        )[[*self.order, *CONGESTION_SCHEMA.names]]


class AccidentDetector(StatefulProcessor):
    """The last accident counts per route."""

    def __init__(self, order: Sequence[str], history: int, multiplier: float, rule: str, high: int):
        self.order, self.rule, self.high = list(order), rule, high
        self.size, self.multiplier = history, multiplier

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getListState("counts", "value bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        data = _arrived(rows, self.order)
        history = [v for (v,) in self.counts.get()]
        current = np.trunc(data["accident_count"].astype("float64").fillna(0.0).to_numpy()).astype("int64")
        mean, peak, history = steps.accident_history(history, current, self.size)
        self.counts.put([(v,) for v in history])
        some = current > 0
        rules = {
            "first_accident_after_clean_history": some & (peak == 0),
            "spike_vs_history": some & (current >= np.maximum(1.0, mean * self.multiplier)),
            "multi_accident": current >= 2,
        }
        fired = np.logical_or.reduce(list(rules.values()))
        if not fired.any():
            return
        out = _pick(data, fired, [*self.order, *ROUTE_KEYS, "timestamp", "avg_speed", "vehicle_count"])
        yield out.assign(
            alert_type="accident_anomaly",
            severity=np.where(current[fired] >= self.high, "high", "medium"),
            accident_count=current[fired],
            history_avg_accident_count=np.round(mean[fired], 3),
            history_max_accident_count=peak[fired],
            rule=self.rule,
            matched_by=[
                {name: bool(flags[i]) for name, flags in rules.items()} for i in np.flatnonzero(fired)
            ],
        )[[*self.order, *ACCIDENT_SCHEMA.names]]
