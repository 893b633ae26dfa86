import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadstate.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    return local_session(4, "4g", "roadstate-tests", {"spark.checkpoint.dir": shared})


def record(seq, road="R1", minute=0, speed=50.0, volume=100, accidents=0, delay=None, **more):
    """One sensor record of the given minute of 2024-01-01."""
    ts = datetime(2024, 1, 1) + timedelta(minutes=minute)
    row = {
        "seq": seq,
        "timestamp": ts.isoformat(timespec="seconds"),
        "event_ts": ts,
        "road_name": road,
        "district": "Demo",
        "city": "Ha Noi",
        "vehicle_count": volume,
        "avg_speed": None if speed is None else float(speed),
        "avg_delay_minutes": delay if delay is not None or speed is None else round(max(0.0, (25 - speed) * 0.8), 2),
        "accident_count": accidents,
        "hour": ts.hour,
        "day_of_week": ts.weekday(),
    }
    return {**row, **more}


RECORD = (
    "seq long, timestamp string, event_ts timestamp_ntz, road_name string, district string, city string, "
    "vehicle_count long, avg_speed double, avg_delay_minutes double, accident_count long, hour int, "
    "day_of_week int"
)


def frame(spark, rows, schema=RECORD):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    data = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in data.collect()), key=repr)
