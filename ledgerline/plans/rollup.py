"""The report rollup: the fact reduced ONCE to its dimension grain.

Every aggregate section of the report (SQL reports, breakdowns, KPIs,
extremes, chart series, tables, claim checks) is a function of decomposable
measures (``ledgerline.functions.measures``) grouped by some of the four
report dimensions. So one aggregation of the fact by all four dimensions,
carrying every measure as a partial, feeds all of them:

    fact --(partial agg in the scan/join stage)--> Exchange of at most
    (#combinations x #tasks) rows --> final agg --> rollup (3,750 rows at
    most on the test tables)

and each section is then a re-aggregation of that small table. A full report
over the raw tables therefore costs one pass over the order lines instead of
one pass per section; the rollup is written to the shared checkpoint folder
so the sections re-read a few kilobytes, and a lost executor never replays
the joins. A hot dimension value (one ship mode holding a third of the lines)
costs nothing extra: each task ships one partial row per combination.

``build_report_aggregates`` adds the density grid (chart V4 at scale) to the
same pass as a second grouping set. Row-level outputs (the scatter points,
the regression) still need the line fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT, AnalyticsConfig
from ledgerline.functions.measures import ROLLUP_PREFIX, line_measures
from ledgerline.functions.predicates import scatter_sign
from ledgerline.session import scratch_path

ROLLUP_GRAIN = ("region", "category", "sub_category", "ship_mode")


def build_rollup(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT,
                 grain: tuple[str, ...] = ROLLUP_GRAIN) -> DataFrame:
    """The fact grouped by ``grain`` with every measure as ``m_<name>`` (lazy).

    The discount threshold of ``cfg`` is fixed into the band measures; it is
    also kept as the column ``high_discount`` so a reader can see it.
    """
    measures = [expr.alias(ROLLUP_PREFIX + name) for name, expr in line_measures(cfg).items()]
    return (fact.groupBy(*grain).agg(*measures)
            .withColumn("high_discount", F.lit(float(cfg.high_discount))))


def store_rollup(spark: SparkSession, rollup: DataFrame, path: str | None = None) -> DataFrame:
    """Write the rollup as parquet below the shared checkpoint folder and
    return a DataFrame over it.

    It goes out in as many files as the final aggregate has partitions, which
    AQE sizes by its rows: one for a small rollup, more for a fine grain. The
    returned DataFrame is cached: every report section re-reads it.
    """
    path = path or scratch_path(spark, "report-rollup")
    rollup.write.mode("overwrite").parquet(path)
    # Cached for the sections that re-read it: a few thousand rows, and a
    # lost block is re-read from the stored file, never recomputed from lines.
    return spark.read.parquet(path).cache()


def rollup_table(rollup: DataFrame) -> DataFrame:
    """The rollup for reading and checking: the grain, every count as is and
    every money measure rounded to cents (HALF_UP on the exact DECIMAL) as
    DOUBLE. Works on a stored or a lazy rollup."""
    money = ("sales", "profit", "disc_sum", "hi_profit", "lo_profit", "zero_profit")
    cols = []
    for name in line_measures():
        c = ROLLUP_PREFIX + name
        cols.append(F.round(c, 2).cast("double").alias(c) if name in money else F.col(c))
    grain = [c for c in rollup.columns if not c.startswith(ROLLUP_PREFIX) and c != "high_discount"]
    return rollup.select(*grain, *cols, "high_discount")


# The density grid's cells (chart V4 at scale): discount, profit bin, colour.
GRID_KEYS = ("grid_discount", "profit_bin", "point_class")


def build_report_aggregates(fact: DataFrame, cfg: AnalyticsConfig = DEFAULT,
                            grain: tuple[str, ...] = ROLLUP_GRAIN) -> DataFrame:
    """The rollup AND the density grid from ONE pass over the order lines.

    ``GROUPING SETS ((grain), (grid cells))``: every line is expanded once
    per set inside the scan stage and immediately folded by the map-side
    partial aggregate, so the exchange still carries aggregated rows only
    and the lines are read once for every aggregate section of the report.
    ``report_set`` tells the two kinds of rows apart (see
    ``split_report_aggregates``).
    """
    bin_ = F.floor(F.col("profit").cast("double") / F.lit(float(cfg.profit_bin_width)))
    keyed = fact.select(*grain, "sales", "profit", "discount",
                        F.col("discount").cast("double").alias("grid_discount"),
                        bin_.cast("bigint").alias("profit_bin"),
                        scatter_sign("profit").alias("point_class"))
    measures = [expr.alias(ROLLUP_PREFIX + name) for name, expr in line_measures(cfg).items()]
    keys = (*grain, *GRID_KEYS)
    sets = [[F.col(c) for c in grain], [F.col(c) for c in GRID_KEYS]]
    # grouping_id sets bit (n-1-i) for every key i NOT grouped in the row's set.
    rollup_gid = (1 << len(GRID_KEYS)) - 1
    agg = keyed.groupingSets(sets, *keys).agg(*measures, F.grouping_id().alias("_gid"))
    return (agg.withColumn("report_set", F.when(F.col("_gid") == rollup_gid, F.lit("rollup"))
                           .otherwise(F.lit("grid")))
            .drop("_gid")
            .withColumn("high_discount", F.lit(float(cfg.high_discount))))


def split_report_aggregates(agg: DataFrame, grain: tuple[str, ...] = ROLLUP_GRAIN
                            ) -> tuple[DataFrame, DataFrame]:
    """(rollup, density grid) from ``build_report_aggregates`` output (stored
    or lazy). The grid has the columns of ``charts.discount_profit_density``."""
    measures = [c for c in agg.columns if c.startswith(ROLLUP_PREFIX)]
    rollup = agg.filter(F.col("report_set") == "rollup").select(*grain, *measures,
                                                                "high_discount")
    grid = agg.filter(F.col("report_set") == "grid").select(
        F.col("grid_discount").alias("discount"), "profit_bin", "point_class",
        F.col(ROLLUP_PREFIX + "orders").alias("points"))
    return rollup, grid
