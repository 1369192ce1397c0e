"""The reference's whole job as one plan: every report section, the saved
region x category matrix and the regression predictions.

``report_sections`` returns lazy DataFrames; ``run_report`` reduces the fact
ONCE to the report rollup and the density grid (``ledgerline.plans.rollup``,
one GROUPING SETS pass), stores that small table and derives every aggregate
section from it, so the order lines are read once for all of them instead of
once per section. Only the regression reads the fact itself; the fact is
stored first when the regression's several passes need it. Nothing is
collected to the driver except the regression's 7x7 normal equations inside
MLlib.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.config import DEFAULT, AnalyticsConfig
from ledgerline.operators import (
    breakdowns as B, charts as C, claims as CL, kpis as K, queries as Q, tables as T,
)
from ledgerline.operators import ml as M
from ledgerline.plans.fact import materialize
from ledgerline.plans.rollup import (
    build_report_aggregates, split_report_aggregates, store_rollup,
)
from ledgerline.session import delete_path, scratch_path
from ledgerline.sources.sinks import write_report, write_result


# The one section whose rows follow the data (cells of the profit bins).
GRID_SECTION = "chart_discount_profit_density"


def report_sections(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT,
                    rollup: DataFrame | None = None,
                    grid: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every report section. Aggregate sections read ``rollup`` when one is
    given (built with the same ``cfg``), else the fact; the density chart
    reads ``grid`` when given, else counts the fact's lines."""
    lines, fact = fact, (rollup if rollup is not None else fact)
    density = (C.density_from_grid(grid) if grid is not None
               else C.discount_profit_density(lines, cfg))
    return {
        "sales_profit_by_region": Q.sales_profit_by_region(fact),
        "top_subcategory_profit": Q.top_subcategory_profit(fact, cfg),
        "bottom_subcategory_profit": Q.bottom_subcategory_profit(fact, cfg),
        "sales_by_ship_mode": Q.sales_by_ship_mode(fact),
        "profit_by_category": Q.profit_by_category(fact),
        "kpi_summary": K.kpi_summary(fact, cfg),
        "kpi_extremes": K.kpi_extremes(fact),
        "breakdowns": B.breakdown_all_dimensions(fact),
        "breakdown_ship_mode": B.breakdown_ship_mode(fact),
        "table_region": T.formatted_region_table(fact),
        "table_category": T.formatted_category_table(fact),
        "table_subcategory": T.formatted_subcategory_table(fact),
        "table_ship_mode": T.formatted_ship_mode_table(fact),
        "chart_region_sales": C.chart_region_sales(fact),
        "chart_category_profit": C.chart_category_profit(fact),
        "chart_top10_subcategory": C.top10_subcategory_sales(fact, cfg),
        GRID_SECTION: density,
        "chart_ship_mode_share": C.chart_ship_mode_share(fact),
        "claim_high_discount_loss_rate": CL.high_discount_loss_rate(fact, cfg),
        "claim_subcategory_discount_band": CL.subcategory_discount_band_profit(fact, cfg),
    }


def run_report(spark: SparkSession, fact: DataFrame, out_dir: str,
               cfg: AnalyticsConfig = DEFAULT, with_ml: bool = True,
               split_mode: str = "random", store_fact: bool | None = None) -> dict[str, str]:
    """Run everything and write it under ``out_dir``; returns the paths.

    ``store_fact`` (default: only when the regression runs) writes the fact
    once to the shared checkpoint folder first; without the regression the
    fact's lines are read exactly once (the rollup + grid pass) and the fact
    is never written. What was stored is deleted at the end.
    """
    if store_fact is None:
        store_fact = with_ml
    scratch = []
    if store_fact:
        fact = materialize(spark, fact)
        scratch.append(fact.scratch)
    path = scratch_path(spark, "report-rollup")
    scratch.append(path)
    try:
        stored = store_rollup(spark, build_report_aggregates(fact, cfg), path)
        rollup, grid = split_report_aggregates(stored)
        sections = report_sections(fact, cfg, rollup, grid)
        written = write_report(sections, f"{out_dir}/report", single_file=set(sections) - {GRID_SECTION})
        written["sql_results"] = write_result(Q.region_category_profit(rollup),
                                              f"{out_dir}/sql_results", single_file=True)
        stored.unpersist()
        if with_ml:
            _, preds, metrics = M.run_regression(fact, mode=split_mode)
            scratch += [preds.scratch] if preds.scratch else []
            written["ml_predictions"] = write_result(preds, f"{out_dir}/ml_predictions")
            written["ml_metrics"] = write_result(metrics, f"{out_dir}/ml_metrics",
                                                 single_file=True)
    finally:
        for folder in scratch:
            delete_path(spark, folder)
    return written
