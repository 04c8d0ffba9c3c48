from __future__ import annotations

import json
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

# Golden forecast values (city, max, min, precip per day 2026-03-13 .. 2026-03-19)
# and current conditions (temp, humidity, wind at 2026-03-13T14:45).
DAYS = [f"2026-03-{d}" for d in range(13, 20)]
DAILY = {
    "Berlin": ([16.6, 12.7, 8.7, 8.3, 12.0, 13.7, 15.7], [5.1, 6.6, 3.5, 1.5, 0.8, 1.7, 3.3], [0.0, 2.9, 0.03, 2.5, 0.0, 0.0, 0.0]),
    "Budapest": ([18.3, 17.0, 16.6, 16.5, 13.5, 10.1, 15.0], [9.2, 7.4, 6.7, 3.8, 5.5, 5.7, 5.5], [0.0, 0.0, 0.0, 0.0, 0.0, 2.1, 0.0]),
    "Prague": ([15.9, 14.0, 8.5, 9.9, 10.0, 13.0, 13.7], [2.5, 7.0, 5.4, 3.4, 2.3, 0.9, 2.6], [0.0, 0.0, 5.4, 0.4, 0.3, 0.0, 0.0]),
    "Vienna": ([18.1, 18.3, 13.6, 12.1, 10.3, 13.0, 11.9], [5.4, 7.3, 7.0, 7.2, 5.1, 4.1, 5.4], [0.0, 0.0, 0.0, 0.5, 1.0, 0.0, 0.0]),
    "Warsaw": ([15.8, 15.8, 15.4, 10.1, 9.4, 10.6, 12.5], [5.3, 4.3, 3.1, 3.0, -0.2, 0.2, 1.0], [0.0, 0.0, 12.42, 18.6, 0.0, 0.0, 0.0]),
}
CURRENT = {
    "Berlin": (16.6, 38, 20.9),
    "Budapest": (18.1, 40, 13.0),
    "Prague": (15.9, 38, 14.1),
    "Vienna": (17.8, 35, 18.3),
    "Warsaw": (15.7, 67, 12.2),
}
FIXTURE_RUN = "source=open_meteo/year=2099/month=01/day=01/run_id=20990101T000000Z"


def forecast_document(city, ingested="2099-01-01T00:00:00Z", daily=None, current=None, days=None):
    mx, mn, pr = daily if daily is not None else DAILY[city]
    t, h, w = current if current is not None else CURRENT[city]
    return {
        "source": "open-meteo",
        "city": city,
        "ingested_at_utc": ingested,
        "payload": {
            "city": city,
            "request_params": {"forecast_days": 7, "timezone": "UTC"},
            "api_response": {
                "current": {"time": "2026-03-13T14:45", "interval": 900, "temperature_2m": t, "relative_humidity_2m": h, "wind_speed_10m": w},
                "daily": {"time": list(days or DAYS), "temperature_2m_max": list(mx), "temperature_2m_min": list(mn), "precipitation_sum": list(pr)},
            },
        },
    }


def write_doc(base, rel_dir, city_slug, doc):
    d = os.path.join(base, rel_dir)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, f"city={city_slug}.json")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(doc if isinstance(doc, str) else json.dumps(doc, indent=2))
    return p


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4, app="strata-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s


@pytest.fixture()
def landing(tmp_path):
    base = str(tmp_path / "raw")
    for city in DAILY:
        write_doc(base, FIXTURE_RUN, city.lower(), forecast_document(city))
    return base


def dec(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))
