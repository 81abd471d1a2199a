"""The derived warehouse tables with faults put in by fixed rules, so that every check has something to find."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def spoiled_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Missing devices and arms, an unknown channel, removed and repeated users, free and removed subscriptions,
    repeated cancellations and events, matches without a therapist. Which rows are hit depends on the user id alone."""
    uid = F.col("user_id")

    def every(n: int):
        return uid % n == 0

    def repeated(df: DataFrame, n: int) -> DataFrame:
        return df.unionByName(df.where(every(n)))

    out = dict(tables.items())
    out["dim_users"] = repeated(
        out["dim_users"].where(~every(23)).withColumns(
            {
                "device": F.when(~every(13), F.col("device")),
                "assigned_variant": F.when(~every(17), F.col("assigned_variant")),
                "acquisition_channel": F.when(every(19), F.lit("tv")).otherwise(F.col("acquisition_channel")),
            }
        ),
        29,
    )
    free = F.lit(0).cast(out["fact_subscriptions"].schema["price_monthly"].dataType)
    out["fact_subscriptions"] = out["fact_subscriptions"].where(~every(7)).withColumn(
        "price_monthly", F.when(every(31), free).otherwise(F.col("price_monthly"))
    )
    out["fact_cancellations"] = repeated(out["fact_cancellations"], 5)
    out["fact_events"] = repeated(out["fact_events"], 41)
    out["fact_matches"] = out["fact_matches"].withColumn("therapist_id", F.when(~every(11), F.col("therapist_id")))
    return out
