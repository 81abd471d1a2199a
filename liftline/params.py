"""Parameters of an experiment readout. Defaults are the standard onboarding-test settings."""

from __future__ import annotations

from dataclasses import dataclass, field

CONTROL = "control"
TREATMENT = "treatment"
ARMS = (CONTROL, TREATMENT)

# Outcome columns of the user-level table, in reporting order.
PRIMARY_METRIC = "activated_within_7d"
METRICS = (
    "activated_within_7d",
    "retained_d7",
    "retained_d30",
    "cancelled_30d",
    "time_to_first_match_hours",
    "support_tickets_30d",
)
GUARDRAIL_METRICS = ("cancelled_30d", "time_to_first_match_hours", "support_tickets_30d")
CUPED_METRICS = ("activated_within_7d", "retained_d7", "retained_d30")

# Segment dimensions used for reporting, and those registered for testing.
REPORT_DIMENSIONS = ("acquisition_channel", "device", "age_bucket", "country")
TEST_DIMENSIONS = ("acquisition_channel", "device", "age_bucket")


@dataclass(frozen=True)
class EventNames:
    started: str = "onboarding_started"
    completed: str = "onboarding_completed"
    booked: str = "session_booked"
    opened: str = "app_open"

    @property
    def all(self) -> list[str]:
        return [self.started, self.completed, self.booked, self.opened]


@dataclass(frozen=True)
class Windows:
    """Outcome windows in days after signup. Column names stay the same when these change."""

    activation: int = 7
    retention_short: int = 7
    retention_long: int = 30
    tickets: int = 30
    cancellation: int = 30


@dataclass(frozen=True)
class QualityBounds:
    min_users: int = 1000
    min_events_per_user: int = 4
    treatment_share: tuple[float, float] = (0.40, 0.60)
    activation_rate: tuple[float, float] = (0.05, 0.80)


@dataclass(frozen=True)
class Tolerances:
    """How far a guardrail may move before it blocks a rollout."""

    cancellation: float = 0.003
    latency_hours: float = 1.0
    tickets: float = 0.01


@dataclass(frozen=True)
class Bootstrap:
    """Percentile bootstrap settings.

    ``buckets`` is the number of hashed user groups per arm that are resampled as units, which
    makes the replicate work independent of the number of users. ``None`` resamples every user.
    """

    replicates: int = 2000
    seed: int = 42
    buckets: int | None = 1000
    lower: float = 0.025
    upper: float = 0.975


@dataclass(frozen=True)
class Power:
    alpha: float = 0.05
    power: float = 0.80
    target_lift: float = 0.01


@dataclass(frozen=True)
class Experiment:
    """Everything a full readout needs, in one place."""

    names: EventNames = field(default_factory=EventNames)
    windows: Windows = field(default_factory=Windows)
    bounds: QualityBounds = field(default_factory=QualityBounds)
    tolerances: Tolerances = field(default_factory=Tolerances)
    bootstrap: Bootstrap = field(default_factory=Bootstrap)
    segment_bootstrap: Bootstrap = field(default_factory=lambda: Bootstrap(replicates=1500, buckets=500))
    power: Power = field(default_factory=Power)
    covariate: str = "baseline_score"
    min_segment_arm: int = 200
    significance: float = 0.05
