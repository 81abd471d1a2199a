"""End-to-end readouts: from warehouse tables to written result tables.

Each readout derives the user-level table once, writes it to shared storage and reads everything
else from there with only the columns it needs. That also ends the lineage: a lost executor costs a
re-read, not another pass over the event log. Nothing at user grain reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from liftline.operators import ab_tests, cuped, decisions, multiple_testing, power, quality, summaries as sm
from liftline.operators import user_metrics as um
from liftline.params import Experiment
from liftline.session import scratch_folder
from liftline.sources.files import write_table
from liftline.sources.views import analysis_input

Tables = dict[str, DataFrame]


def _facts(tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tables["fact_support_tickets"], tables["fact_cancellations"], tables["fact_matches"]


def stored(df: DataFrame, path: str) -> DataFrame:
    """The frame written as Parquet and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _publish(results: Tables, out: str, fmt: str) -> dict[str, str]:
    paths = {}
    for name, df in results.items():
        paths[name] = f"{out.rstrip('/')}/{name}"
        write_table(df, paths[name], fmt, single_file=True)
    return paths


def analysis_readout(
    spark: SparkSession, tables: Tables, out: str, exp: Experiment = Experiment(), fmt: str = "csv",
    check_quality: bool = True,
) -> dict[str, str]:
    """Quality gates, A/B results, power, CUPED, segments and the decision; returns the paths written.

    Result tables feed the later ones, so each is stored once and read back.
    """
    if check_quality:
        quality.require_quality(tables["dim_users"], tables["fact_events"], exp)
    with scratch_folder(spark, "analysis") as work:
        metrics = um.experiment_user_metrics(tables["dim_users"], tables["fact_events"], *_facts(tables), exp)
        df = stored(analysis_input(metrics), f"{work}/user_metrics")

        results = stored(
            multiple_testing.with_metric_fdr(
                ab_tests.ab_result_table(df, boot=exp.bootstrap), level=exp.significance
            ),
            f"{work}/results",
        )
        power_mde = stored(power.power_table(results, power=exp.power), f"{work}/power")
        reduced = stored(cuped.cuped_table(df, exp.covariate, boot=exp.bootstrap), f"{work}/cuped")
        segments = stored(ab_tests.segment_tests(df, exp=exp), f"{work}/segments")
        return _publish(
            {
                "ab_results_v1": results,
                "power_mde": power_mde,
                "cuped_results": reduced,
                "segment_analysis": segments.orderBy("segment_dimension", "segment_value"),
                "kpi_snapshot": decisions.kpi_snapshot(results, power_mde, reduced),
                "guardrail_regressions": decisions.guardrail_regressions(results),
                "decision": decisions.decision_by_pvalue(results),
                "strongest_segment": decisions.strongest_segment(segments),
            },
            out,
            fmt,
        )


def dashboard_readout(
    spark: SparkSession, tables: Tables, out: str, exp: Experiment = Experiment(), fmt: str = "csv"
) -> dict[str, str]:
    """The dashboard's tables; the user-level one keeps its natural number of files."""
    with scratch_folder(spark, "dashboard") as work:
        user_level = stored(
            um.dashboard_user_level(tables["dim_users"], tables["fact_events"], *_facts(tables), exp),
            f"{work}/user_level",
        )
        summary = stored(sm.dashboard_variant_summary(user_level), f"{work}/summary")
        user_path = f"{out.rstrip('/')}/dashboard_user_level"
        write_table(user_level, user_path, fmt)
        paths = _publish(
            {
                "dashboard_variant_summary": summary.orderBy("assigned_variant"),
                "dashboard_funnel": sm.ordered_funnel(user_level),
                "dashboard_daily_activation": sm.daily_activation(user_level).orderBy("signup_date", "assigned_variant"),
                "dashboard_segment_activation": sm.segment_activation(user_level),
                "dashboard_data_quality": quality.quality_summary(user_level, tables["fact_events"]),
                "dashboard_metric_dictionary": decisions.metric_dictionary(spark),
                "dashboard_final_recommendation": decisions.decision_by_tolerance(summary, exp.tolerances),
            },
            out,
            fmt,
        )
        return {"dashboard_user_level": user_path, **paths}


def bi_export(
    spark: SparkSession, tables: Tables, out: str, exp: Experiment = Experiment(), fmt: str = "csv"
) -> dict[str, str]:
    """The BI tool's tables: user level, variant, lift, funnel, daily and segment metrics."""
    with scratch_folder(spark, "bi") as work:
        user_level = stored(
            um.bi_user_level(tables["dim_users"], tables["fact_events"], *_facts(tables), exp),
            f"{work}/user_level",
        )
        summary = sm.variant_summary(user_level)
        user_path = f"{out.rstrip('/')}/user_level"
        write_table(user_level, user_path, fmt)
        paths = _publish(
            {
                "variant_summary": summary.orderBy("assigned_variant"),
                "lift_summary": sm.lift_table(summary),
                "funnel_summary": sm.funnel_long(user_level).orderBy("assigned_variant", "step_order"),
                "daily_metrics": sm.daily_metrics(user_level).orderBy("signup_date", "assigned_variant"),
                "segment_metrics": sm.segment_metrics(user_level),
            },
            out,
            fmt,
        )
        return {"user_level": user_path, **paths}
