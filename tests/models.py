"""Plain sequential state machines, row by row: what the operators must equal."""

import math
from collections import defaultdict
from datetime import datetime


def by_route(rows, order="seq"):
    series = defaultdict(list)
    for r in sorted(rows, key=lambda r: r[order]):
        series[r["road_name"], r["district"], r["city"]].append(r)
    return series.values()


def lags_and_window(rows, order="seq"):
    """(arrival of the trigger, emitted seq, lags of speed, mean speed)."""
    out = []
    for series in by_route(rows, order):
        history, window = [], []
        for r in series:
            lagged = dict(r, lags=tuple(history[-k]["avg_speed"] if len(history) >= k else None for k in (1, 2, 3)))
            history.append(r)
            window = (window + [lagged])[-3:]
            if len(window) < 3:
                continue
            base = sorted(window, key=lambda w: w["timestamp"] or "")[-1]
            speeds = [w["avg_speed"] for w in window if w["avg_speed"] is not None]
            mean = sum(speeds) / len(speeds) if speeds else None
            out.append((r[order], base["seq"], *base["lags"], None if mean is None else round(mean, 6)))
    return sorted(out)


def congestion(rows, speed=10.0, events=3, minutes=30, order="seq"):
    out = []
    for series in by_route(rows, order):
        count, first = 0, None
        for r in series:
            value, ts = float(r["avg_speed"] or 0), datetime.fromisoformat(r["timestamp"])
            if value >= speed:
                count, first = 0, None
                continue
            count, first = count + 1, first or ts
            elapsed = int((ts - first).total_seconds() / 60)
            if count >= events or elapsed >= minutes:
                out.append((r["seq"], count, max(elapsed, 0), count >= events, elapsed >= minutes,
                            "high" if value < 7 else "medium"))
    return sorted(out)


def accidents(rows, size=6, multiplier=3.0, order="seq"):
    out = []
    for series in by_route(rows, order):
        history = []
        for r in series:
            now = int(float(r["accident_count"] or 0))
            mean = sum(history) / len(history) if history else 0.0
            peak = max(history) if history else 0
            flags = (now > 0 and peak == 0, now > 0 and now >= max(1, mean * multiplier), now >= 2)
            if any(flags):
                out.append((r["seq"], now, round(mean, 3), peak, *flags))
            history = (history + [now])[-size:]
    return sorted(out)


def weather_fill(events, updates, order="seq"):
    merged = [(u[order], 0, u) for u in updates] + [(e[order], 1, e) for e in events]
    latest, out = {}, []
    for _, side, r in sorted(merged, key=lambda m: m[:2]):
        key = r["district"], r["city"]
        if side == 0:
            latest[key] = r
            continue
        value = r.get("temperature_celsius")
        if "temperature_celsius" not in (r.get("present") or []) and key in latest:
            value = latest[key]["temperature_celsius"]
        out.append((r["seq"], value))
    return sorted(out, key=lambda x: x[0])


def asof(events, features):
    """(seq, matched cutoff) by scanning every feature row."""
    keys = ("road_name", "district", "city", "hour", "day_of_week")
    out = []
    for e in events:
        cuts = [
            f["source_cutoff"] for f in features
            if all(f[k] == e[k] for k in keys) and f["source_cutoff"] <= e["event_ts"]
        ]
        out.append((e["seq"], max(cuts, default=None), len(cuts)))
    return sorted(out, key=lambda x: x[0])


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, abs_tol=1e-6))
