from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from liftline.schemas import TABLES  # noqa: E402
from liftline.session import local_session  # noqa: E402

SIGNUP = datetime(2024, 1, 1, 12, 0, 0)
DAY = timedelta(days=1)
TICK = timedelta(microseconds=1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "liftline-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Rows of one warehouse table from partial dictionaries."""
    defaults = {
        "dim_users": {
            "signup_ts": SIGNUP,
            "country": "US",
            "device": "ios",
            "acquisition_channel": "organic",
            "age_bucket": "18-24",
            "baseline_score": 0.5,
            "assigned_variant": "control",
            "actually_exposed_variant": "control",
            "pre_treatment_sessions_30d": 0,
            "created_at": SIGNUP,
        },
        "fact_subscriptions": {"plan_type": "monthly"},
        "fact_cancellations": {"reason": "price"},
        "fact_support_tickets": {"category": "billing"},
        "fact_matches": {"therapist_id": 1},
    }

    def build(name: str, *rows: dict):
        schema = TABLES[name].schema
        base = defaults.get(name, {})
        data = [tuple({**base, **r}.get(f.name) for f in schema.fields) for r in rows]
        nullable = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
        return spark.createDataFrame(data, nullable)

    return build


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a dictionary by one or more key columns."""

    def by(df, *keys):
        out = {}
        for r in df.collect():
            key = tuple(r[k] for k in keys)
            assert key not in out, f"repeated {key}"
            out[key if len(keys) > 1 else key[0]] = r
        return out

    return by
