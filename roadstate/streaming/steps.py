"""One micro-batch of one key, as vectorised functions on pandas frames.

Each function takes the state left by earlier batches and the new rows in
arrival order, and returns the output rows and the new state. They hold no Spark
objects, so the tests drive them directly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd


def latest_update(
    latest: dict | None, rows: pd.DataFrame, is_update: np.ndarray, fields: Sequence[str]
) -> tuple[pd.DataFrame, dict | None]:
    """Latest update at every row (``fields``), and the one left at the end."""
    at = np.maximum.accumulate(np.where(is_update, np.arange(len(rows)), -1))
    values = {}
    for f in fields:
        column = rows[f].astype(object).to_numpy()
        before = None if latest is None else latest[f]
        picked = np.empty(len(rows), dtype=object)
        picked[:] = np.where(at >= 0, column[np.maximum(at, 0)], before)
        values[f] = picked
    result = pd.DataFrame(values, index=rows.index)
    known = latest is not None or is_update.any()
    return result, ({f: result[f].iloc[-1] for f in fields} if known else None)


def lags_and_window(
    tail: pd.DataFrame,
    rows: pd.DataFrame,
    lags: Mapping[str, str],
    rolling: Mapping[str, str],
    n: int,
    size: int,
    time_text: str,
    full_only: bool,
    emitted: Mapping[str, str],
) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Lag columns, then the latest-by-time record of each count window.

    ``tail`` holds the last ``n + size - 1`` rows of earlier batches.
    """
    old = len(tail)
    both = pd.concat([tail, rows], ignore_index=True) if old else rows.reset_index(drop=True)
    lagged = both.assign(
        **{
            f"{prefix}_{k}": both[source].astype("float64").shift(k)
            for source, prefix in lags.items()
            for k in range(1, n + 1)
        }
    )
    time = both[time_text].fillna("").astype(str).to_numpy()
    base = np.arange(len(both))
    best = time.copy()
    for k in range(1, size):
        earlier = np.arange(len(both)) - k
        usable = earlier >= 0
        candidate = np.where(usable, time[np.maximum(earlier, 0)], "")
        wins = usable & (candidate > best)
        base = np.where(wins, earlier, base)
        best = np.where(wins, candidate, best)
    out = lagged.iloc[base].reset_index(drop=True)
    for source, name in rolling.items():
        out[name] = both[source].astype("float64").rolling(size, min_periods=1).mean().to_numpy()
    for source, name in emitted.items():
        out[name] = both[source]
    fresh = np.arange(len(both)) >= old
    if full_only:
        # The tail is shorter than size - 1 only at the start of the series.
        fresh &= np.arange(len(both)) >= size - 1
    return out[fresh], both.tail(n + size - 1)


def low_speed_run(
    count: int, since, speed: np.ndarray, times: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, object]:
    """Low flag, run length and run start per row; open run at the end."""
    low = np.nan_to_num(speed) < threshold
    index = np.arange(len(low))
    reset = np.maximum.accumulate(np.where(low, -1, index))
    length = np.where(low, index - reset, 0)
    start = times[np.minimum(reset + 1, len(times) - 1)].copy()
    if count:
        continued = low & (reset == -1)
        length = np.where(continued, length + count, length)
        start = np.where(continued, np.datetime64(since, "us"), start)
    if not low[-1]:
        return low, length, start, 0, None
    return low, length, start, int(length[-1]), start[-1]


def accident_history(
    history: Sequence[int], current: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Mean and maximum of the ``size`` values before each row; the new history."""
    values = pd.Series(np.concatenate([np.asarray(history, dtype="int64"), current]))
    window = values.shift(1).rolling(size, min_periods=1)
    keep = slice(len(history), None)
    mean = window.mean().fillna(0.0).to_numpy()[keep]
    peak = window.max().fillna(0).astype("int64").to_numpy()[keep]
    return mean, peak, [int(v) for v in values.tail(size)]
