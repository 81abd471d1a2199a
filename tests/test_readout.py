from __future__ import annotations

import pytest

from liftline.operators.quality import QualityError
from liftline.plans.readout import analysis_readout, bi_export, dashboard_readout
from liftline.sources.testbeds import COMMERCE, PRODUCT, commerce_tables, product_tables

SF = "/root/testdata/sf0.001"


def test_analysis(spark, tmp_path):
    tables = commerce_tables(spark, SF)
    with pytest.raises(QualityError):
        analysis_readout(spark, tables, str(tmp_path), COMMERCE)
    paths = analysis_readout(spark, tables, str(tmp_path), COMMERCE, check_quality=False)
    counts = {n: spark.read.csv(p, header=True).count() for n, p in paths.items()}
    assert counts["ab_results_v1"] == 6 and counts["power_mde"] == 1 and counts["cuped_results"] == 3
    assert counts["decision"] == 1 and counts["kpi_snapshot"] == 1 and counts["segment_analysis"] == 0


def test_dashboard(spark, tmp_path):
    paths = dashboard_readout(spark, product_tables(spark, SF), str(tmp_path), PRODUCT)
    counts = {n: spark.read.csv(p, header=True).count() for n, p in paths.items()}
    assert counts["dashboard_user_level"] == 15 and counts["dashboard_funnel"] == 10
    assert counts["dashboard_data_quality"] == 5 and counts["dashboard_final_recommendation"] == 1


def test_bi(spark, tmp_path):
    paths = bi_export(spark, product_tables(spark, SF), str(tmp_path), PRODUCT, "parquet")
    counts = {n: spark.read.parquet(p).count() for n, p in paths.items()}
    assert counts["user_level"] == 15 and counts["lift_summary"] == 6 and counts["funnel_summary"] == 10
