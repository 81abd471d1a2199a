"""Warehouse tables: columns, keys, references and value rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_LONG = T.LongType()
_INT = T.IntegerType()
_DOUBLE = T.DoubleType()
_TEXT = T.StringType()
_TS = T.TimestampNTZType()


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: str
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _spec(name, key, columns, references=None, checks=None, optional=()):
    fields = [T.StructField(c.rstrip("?"), t, nullable=c.endswith("?")) for c, t in columns]
    return TableSpec(name, T.StructType(fields), key, references or {}, checks or {}, optional)


_USER_REF = {"user_id": ("dim_users", "user_id")}

TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in [
        _spec(
            "dim_users",
            "user_id",
            [
                ("user_id", _LONG),
                ("signup_ts", _TS),
                ("country", _TEXT),
                ("device", _TEXT),
                ("acquisition_channel", _TEXT),
                ("age_bucket", _TEXT),
                ("baseline_score", _DOUBLE),
                ("assigned_variant", _TEXT),
                ("actually_exposed_variant", _TEXT),
                ("pre_treatment_sessions_30d", _INT),
                ("created_at", _TS),
            ],
            checks={
                "acquisition_channel_domain": "acquisition_channel IN ('organic', 'paid', 'referral')",
                "assigned_variant_domain": "assigned_variant IN ('control', 'treatment')",
                "actually_exposed_variant_domain": "actually_exposed_variant IN ('control', 'treatment')",
            },
            optional=("created_at",),
        ),
        _spec(
            "fact_sessions",
            "session_id",
            [
                ("session_id", _LONG),
                ("user_id", _LONG),
                ("session_start_ts", _TS),
                ("session_end_ts?", _TS),
                ("device", _TEXT),
            ],
            _USER_REF,
        ),
        _spec(
            "fact_events",
            "event_id",
            [
                ("event_id", _TEXT),
                ("user_id", _LONG),
                ("event_ts", _TS),
                ("event_name", _TEXT),
                ("session_id?", _LONG),
                ("properties_json?", _TEXT),
            ],
            _USER_REF,
        ),
        _spec(
            "fact_subscriptions",
            "user_id",
            [
                ("user_id", _LONG),
                ("subscribed_ts", _TS),
                ("plan_type", _TEXT),
                ("price_monthly", T.DecimalType(10, 2)),
            ],
            _USER_REF,
            {"price_monthly_positive": "price_monthly > 0"},
        ),
        _spec(
            "fact_cancellations",
            "user_id",
            [("user_id", _LONG), ("cancelled_ts", _TS), ("reason", _TEXT)],
            {"user_id": ("fact_subscriptions", "user_id")},
        ),
        _spec(
            "fact_support_tickets",
            "ticket_id",
            [("ticket_id", _LONG), ("user_id", _LONG), ("created_ts", _TS), ("category", _TEXT)],
            _USER_REF,
        ),
        _spec(
            "fact_matches",
            "user_id",
            [("user_id", _LONG), ("matched_ts", _TS), ("therapist_id", _LONG)],
            _USER_REF,
        ),
    ]
}

# Tables a readout cannot do without.
READOUT_INPUTS = ["dim_users", "fact_events", "fact_matches", "fact_cancellations", "fact_support_tickets"]
