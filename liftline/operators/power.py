"""Sample size and minimum detectable effect for rates."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

from liftline.functions.numeric import clamp_probability
from liftline.params import PRIMARY_METRIC, Power

# Search range and number of halvings for the detectable effect.
MDE_LOW, MDE_HIGH, MDE_STEPS = 1e-4, 0.5, 40


def required_n(baseline: Column, lift: Column, power: Power = Power()) -> Column:
    """Users per arm needed to detect an absolute lift over a baseline rate."""
    z_alpha = NormalDist().inv_cdf(1 - power.alpha / 2)
    z_beta = NormalDist().inv_cdf(power.power)
    p1, p2 = clamp_probability(baseline), clamp_probability(baseline + lift)
    middle = (p1 + p2) / 2
    null_term = F.lit(z_alpha) * F.sqrt(2 * middle * (1 - middle))
    effect_term = F.lit(z_beta) * F.sqrt(p1 * (1 - p1) + p2 * (1 - p2))
    return F.ceil(F.pow(null_term + effect_term, F.lit(2)) / (lift * lift))


def detectable_lift(baseline: Column, n_control: Column, n_treatment: Column, power: Power = Power()) -> Column:
    """Smallest lift the smaller arm can detect, by halving the search range; NULL without a baseline or an arm."""
    available = F.greatest(F.lit(2), F.least(n_control, n_treatment))

    def halve(state: Column, _step: Column) -> Column:
        middle = (state["low"] + state["high"]) / 2
        enough = required_n(baseline, middle, power) <= available
        return F.struct(
            F.when(enough, state["low"]).otherwise(middle).alias("low"),
            F.when(enough, middle).otherwise(state["high"]).alias("high"),
        )

    start = F.struct(F.lit(MDE_LOW).alias("low"), F.lit(MDE_HIGH).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(MDE_STEPS)), start, halve, lambda state: state["high"])
    return F.when(baseline.isNotNull() & n_control.isNotNull() & n_treatment.isNotNull(), found)


def power_columns(tests: DataFrame, power: Power = Power()) -> DataFrame:
    """Adds the power columns to any table of tests with a rate per arm."""
    baseline = F.col("control_mean")
    return tests.withColumns(
        {
            "alpha": F.lit(power.alpha),
            "power": F.lit(power.power),
            "baseline_rate_control": baseline,
            "observed_mde_abs": detectable_lift(baseline, F.col("n_control"), F.col("n_treatment"), power),
            "required_n_per_group_for_1pp_lift": required_n(baseline, F.lit(power.target_lift), power),
        }
    )


def power_table(results: DataFrame, metric: str = PRIMARY_METRIC, power: Power = Power()) -> DataFrame:
    return power_columns(results.where(F.col("metric") == metric), power).select(
        "metric",
        "alpha",
        "power",
        "baseline_rate_control",
        "n_control",
        "n_treatment",
        "observed_mde_abs",
        "required_n_per_group_for_1pp_lift",
    )
