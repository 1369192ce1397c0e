"""

Every query binds the whole star schema to the sales fact (see
``ledgerline.sources.star``) and runs one operator of the library on it; the
oracle is the same computation written as plain SQL for DuckDB over the same
parquet tables (the fact as a CTE; the regression by its normal equations).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import DEFAULT, RIDGE_REG_PARAM
from ledgerline.operators import (
    breakdowns as B, calendar as CAL, charts as C, claims as CL, cleaning as CLN, customers as CU, filters as FL,
    global_order as GO, kpis as K, ml as M, props as PR, quantiles as QU, queries as Q, ranking as R, sets as S,
    tables as T, temporal as TM,
)
from ledgerline.plans.cube import sales_cube
from ledgerline.plans.fact import materialize
from ledgerline.plans.rollup import build_rollup, rollup_table
from ledgerline.sources.catalog import preview, register
from ledgerline.sources.csv import csv_round_trip, reload_fact, through_csv
from ledgerline.sources.star import FACT_SQL, bind_fact
from ledgerline.sources.tables import read_dated, with_order_date
from ledgerline.streaming.sessions import session_report

try:        # the training-data subpackage and its pipeline are optional
    import corpus_pipeline
    from ledgerline.llm import queries as training
except ImportError:
    corpus_pipeline = training = None

SMOKE_DIR = "/root/testdata/sf0.001"
SEARCH_TEXT = "ica"
HI = repr(DEFAULT.high_discount)          # 0.08 on the star-schema tables
BIN = repr(DEFAULT.profit_bin_width)      # profit bin width of the density grid


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: sales and profit by region over the sf0.001 tables."""
    return Q.sales_profit_by_region(bind_fact(spark, SMOKE_DIR))


def _on_fact(op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(bind_fact(spark, sf_dir))
    run.__name__ = getattr(op, "__name__", "query")
    return run


def _with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uncleaned fact with nulls made of one ship mode and one quantity."""
    fact = bind_fact(spark, sf_dir, raw=True)
    return fact.withColumns({
        "ship_mode": F.nullif(F.col("ship_mode"), F.lit("5-LOW")),
        "quantity": F.nullif(F.col("quantity"), F.lit(1.0))})


def _clean_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CLN.clean_count(_with_nulls(spark, sf_dir))


def _clean_ship_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.sales_by_ship_mode(CLN.clean(_with_nulls(spark, sf_dir)))


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_round_trip(spark, Q.region_category_profit(bind_fact(spark, sf_dir)))


def _csv_fact_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.sales_by_ship_mode(reload_fact(spark, _with_nulls(spark, sf_dir)))


def _csv_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_csv(spark, _predictions(spark, sf_dir))


def _sql_view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Q.run_sql(spark, name, register(bind_fact(spark, sf_dir), "ledgerline_sales"))
    return run


def _preview(fact: DataFrame) -> DataFrame:
    ordered = fact.select("order_key", "region", "category", "sub_category", "ship_mode",
                          F.col("sales").cast("double").alias("sales"))
    return preview(ordered, 5, [F.desc("sales"), "order_key", "sub_category"])


def _on_dated_fact(op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(with_order_date(spark, sf_dir, bind_fact(spark, sf_dir)))
    return run


def _on_events(op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(read_dated(spark, sf_dir, "events"))
    return run


# Events are of 2024 and orders of 1995 to 2001: moments are events so many days earlier.
MOMENT_DAYS = 9496
EXPRESS_DAYS = 7


def _open_lines(op: Callable[[DataFrame, DataFrame], DataFrame],
                max_days: int | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = read_dated(spark, sf_dir, "events")
        moments = events.select("event_id", F.expr(f"ts - interval {MOMENT_DAYS} days").alias("at"))
        # a line that is open at no time between the first and the last moment makes no pair
        started, ended = TM.touched(moments, "order_date", "l_shipdate", max_days)
        lines = read_dated(spark, sf_dir, "lineitem").where(ended)
        return op(moments, with_order_date(spark, sf_dir, lines, "l_orderkey", where=started))
    return run


def _customers(fact: DataFrame) -> DataFrame:
    return CU.customers_by_dimensions(materialize(fact.sparkSession, CU.distinct_rollup(fact)))


BULK = 45


def _parts_not_in_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_dated(spark, sf_dir, "lineitem")
    bulk = lines.where((F.col("l_discount") >= DEFAULT.high_discount) & (F.col("l_quantity") >= BULK))
    parts = read_dated(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_key"), F.col("p_brand").alias("brand"))
    return S.not_in(parts, "part_key", bulk, "l_partkey")


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier and a later load of the lines: orders of each order month's parity are in one only."""
    lines = with_order_date(spark, sf_dir, read_dated(spark, sf_dir, "lineitem"), "l_orderkey")
    rows = lines.select(F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
                        F.year("order_date").alias("year"), F.month("order_date").alias("m"))
    return S.reconcile(rows.where("m % 3 <> 0").drop("m"), rows.where("m % 3 <> 1").drop("m"))


# The regression's figures are rounded where the two engines' sums agree by far:
# they differ in the order of additions only.
def _regression_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = M.fit_stable(bind_fact(spark, sf_dir))
    return M.coefficients(model, spark).withColumn("coefficient", F.round("coefficient", 4))


def _regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, metrics = M.run_regression(bind_fact(spark, sf_dir), mode="stable")
    return metrics.select(F.round("rmse", 4).alias("rmse"), F.round("r2", 8).alias("r2"), "test_rows")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, preds, _ = M.run_regression(bind_fact(spark, sf_dir), mode="stable")
    return preds.withColumn("prediction", F.round("prediction", 2))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _retail_queries() | (
        training.queries() | {"pipeline": corpus_pipeline.run} if training else {})


def _retail_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # The reference's SQL reports
        "sales_profit_by_region": _on_fact(Q.sales_profit_by_region),
        "top5_subcategory_profit": _on_fact(Q.top_subcategory_profit),
        "bottom5_subcategory_profit": _on_fact(Q.bottom_subcategory_profit),
        "sales_by_ship_mode": _on_fact(Q.sales_by_ship_mode),
        "profit_by_category": _on_fact(Q.profit_by_category),
        "region_category_profit": _on_fact(Q.region_category_profit),
        # Cleaning, counts, projections, filters
        "clean_count": _clean_count,
        "clean_ship_modes": _clean_ship_modes,
        "csv_round_trip": _csv_round_trip,
        "row_count": _on_fact(FL.row_count),
        "project_order_lines": _on_fact(FL.project_order_lines),
        "profitable_orders": _on_fact(FL.profitable_orders),
        "loss_orders": _on_fact(FL.loss_orders),
        "high_discount_orders": _on_fact(FL.high_discount_orders),
        "zero_discount_orders": _on_fact(FL.zero_discount_orders),
        # A11-A14, A25, grouping sets
        "breakdown_region": _on_fact(B.breakdown_region),
        "breakdown_category": _on_fact(B.breakdown_category),
        "breakdown_subcategory": _on_fact(B.breakdown_subcategory),
        "breakdown_ship_mode": _on_fact(B.breakdown_ship_mode),
        "ship_mode_order_share": _on_fact(B.ship_mode_order_share),
        "breakdown_all_dimensions": _on_fact(B.breakdown_all_dimensions),
        # KPIs
        "kpi_totals": _on_fact(K.kpi_totals),
        "kpi_order_quality": _on_fact(K.kpi_order_quality),
        "kpi_discount_impact": _on_fact(K.kpi_discount_impact),
        "kpi_summary": _on_fact(K.kpi_summary),
        "kpi_extremes": _on_fact(K.kpi_extremes),
        # extremes
        "top_region": _on_fact(R.top_region),
        "bottom_region": _on_fact(R.bottom_region),
        "top_category": _on_fact(R.top_category),
        "best_subcategory": _on_fact(R.best_subcategory),
        "worst_subcategory": _on_fact(R.worst_subcategory),
        "top_ship_mode_share": _on_fact(R.top_ship_mode_share),
        # V1-V5: chart series
        "chart_region_sales": _on_fact(C.chart_region_sales),
        "chart_category_profit": _on_fact(C.chart_category_profit),
        "top10_subcategory_sales": _on_fact(C.top10_subcategory_sales),
        "discount_profit_points": _on_fact(C.discount_profit_points),
        "discount_profit_density": _on_fact(C.discount_profit_density),
        "chart_ship_mode_share": _on_fact(C.chart_ship_mode_share),
        # Report tables and search
        "formatted_region_table": _on_fact(T.formatted_region_table),
        "formatted_category_table": _on_fact(T.formatted_category_table),
        "formatted_subcategory_table": _on_fact(T.formatted_subcategory_table),
        "formatted_ship_mode_table": _on_fact(T.formatted_ship_mode_table),
        "search_breakdown": _on_fact(lambda f: T.search_breakdown(f, SEARCH_TEXT)),
        "breakdown_sign_class": _on_fact(T.breakdown_sign_class),
        # the report rollup every aggregate section can be derived from
        "report_rollup": _on_fact(lambda f: rollup_table(build_rollup(f))),
        # claims
        "high_discount_loss_rate": _on_fact(CL.high_discount_loss_rate),
        "subcategory_discount_band_profit": _on_fact(CL.subcategory_discount_band_profit),
        "category_discount_rank": _on_fact(CL.category_discount_rank),
        # regression
        "index_segment": _on_fact(lambda f: M.label_index(f, "segment")),
        "index_category": _on_fact(lambda f: M.label_index(f, "category")),
        "index_region": _on_fact(lambda f: M.label_index(f, "region")),
        "index_ship_mode": _on_fact(lambda f: M.label_index(f, "ship_mode")),
        "feature_matrix": _on_fact(M.feature_matrix),
        "train_test_counts": _on_fact(M.train_test_counts),
        "random_split_total": _on_fact(M.random_split_total),
        "regression_coefficients": _regression_coefficients,
        "regression_metrics": _regression_metrics,
        "predictions": _predictions,
        # S1-S8 over the whole fact: part files, the prediction sink, SQL text over a view, preview
        "csv_fact_report": _csv_fact_report,
        "csv_predictions": _csv_predictions,
        "sql_view_region_category_profit": _sql_view("region_category_profit"),
        "sql_view_profit_by_category": _sql_view("profit_by_category"),
        "preview_lines": _on_fact(_preview),
        "loss_making_subcategories": _on_fact(lambda f: Q.bottom_subcategory_profit(f, only_losses=True)),
        # sales in time
        "quarterly_sales": _on_dated_fact(CAL.quarterly_sales),
        "best_year": _on_dated_fact(CAL.best_year),
        "peak_quarters": _on_dated_fact(CAL.peak_quarters),
        # joins on time, sessions, JSON properties
        "last_click_before_purchase": _on_events(TM.last_click_before_purchase),
        "express_lines_at_events": _open_lines(
            lambda m, x: TM.open_lines_at(m, x, EXPRESS_DAYS), EXPRESS_DAYS),
        "open_lines_at_events": _open_lines(GO.open_lines_count),
        "event_sessions": _on_events(session_report),
        "event_properties": _on_events(PR.property_statistics),
        # global order, exact quantiles, exact distinct counts, NOT IN, multisets
        "sales_running_totals": _on_fact(GO.sales_running_totals),
        "profit_quantiles": _on_fact(QU.profit_quantiles),
        "customers_by_dimensions": _on_dated_fact(_customers),
        "sales_cube": _on_fact(sales_cube),
        "parts_not_in_bulk": _parts_not_in_bulk,
        "load_reconciliation": lambda spark, sf_dir: S.reconciliation(_loads(spark, sf_dir)),
        "load_except_all": lambda spark, sf_dir: S.except_all(_loads(spark, sf_dir)),
        "load_intersect_all": lambda spark, sf_dir: S.intersect_all(_loads(spark, sf_dir)),
    }


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)
# ---------------------------------------------------------------------------

def _fact(body: str) -> str:
    return f"WITH fact AS ({FACT_SQL})\n{body}"


MONEY_S = "CAST(ROUND(SUM(sales), 2) AS DOUBLE)"
MONEY_P = "CAST(ROUND(SUM(profit), 2) AS DOUBLE)"
MARGIN = "ROUND(CAST(SUM(profit) AS DOUBLE) / NULLIF(CAST(SUM(sales) AS DOUBLE), 0) * 100, {n})"
LINES = ("CAST(sales AS DOUBLE) AS sales, CAST(quantity AS DOUBLE) AS quantity, "
         "CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit")


def _pct(num: str, den: str, n: int) -> str:
    return f"ROUND(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100, {n})"


def _mean(expr: str, cond: str) -> str:
    return (f"CAST(SUM({expr}) FILTER (WHERE {cond}) AS DOUBLE) / "
            f"NULLIF(CAST(COUNT({expr}) FILTER (WHERE {cond}) AS DOUBLE), 0)")


def _breakdown(dim: str, sort: str) -> str:
    return _fact(f"""
SELECT {dim}, {MONEY_S} AS total_sales, {MONEY_P} AS total_profit, COUNT(*) AS total_orders,
       {MARGIN.format(n=1)} AS margin_pct
FROM fact GROUP BY {dim} ORDER BY {sort} DESC, {dim}""")


def _money_table(dim: str, sort: str) -> str:
    return f"""
SELECT {dim},
       format('${{:,.0f}}', CAST(SUM(sales) AS DOUBLE)) AS sales_label,
       format('${{:,.0f}}', CAST(SUM(profit) AS DOUBLE)) AS profit_label,
       CASE WHEN SUM(profit) > 0 THEN 'pos' ELSE 'neg' END AS profit_class,
       CAST({MARGIN.format(n=1)} AS VARCHAR) || '%' AS margin_label
FROM fact GROUP BY {dim} ORDER BY SUM({sort}) DESC, {dim}"""


def _rank(dim: str, measure: str, direction: str, name: str) -> str:
    return _fact(f"""
SELECT {dim}, CAST(ROUND(SUM({measure}), 2) AS DOUBLE) AS {name}
FROM fact GROUP BY {dim} ORDER BY SUM({measure}) {direction}, {dim} LIMIT 1""")


def _label_index(col: str) -> str:
    return _fact(f"""
SELECT {col}, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {col}) - 1 AS DOUBLE) AS {col}_idx
FROM fact GROUP BY {col}""")


def _ridge(body: str) -> str:
    """The regression in plain SQL: indexed features, the standardised normal
    equations of the train side, Gauss-Jordan elimination step by step, and
    the coefficients back on the features' own scale (one row, ``fit``)."""
    dims = ("segment", "category", "region", "ship_mode")
    n = len(M.FEATURES)
    x, y = [f"x{i}" for i in range(n)], "y"
    train = "(SELECT * FROM model WHERE NOT is_test) t"
    ranks = "".join(f"""
, rank_{d} AS (SELECT {d}, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {d}) - 1 AS i
               FROM fact WHERE NOT order_key % 5 = 4 GROUP BY {d})""" for d in dims)
    columns = ["sales", "quantity", "discount", *(f"rank_{d}.i" for d in dims)]
    steps = [f"""
, e0 AS (SELECT {", ".join(
        [f"AVG(({x[i]} - m_{x[i]}) * ({x[j]} - m_{x[j]})) / (MAX(s_{x[i]}) * MAX(s_{x[j]}))"
         + (f" + {RIDGE_REG_PARAM} / MAX(s_y)" if i == j else "") + f" AS a{i}_{j}"
         for i in range(n) for j in range(n)]
        + [f"AVG(({x[i]} - m_{x[i]}) * (y - m_y)) / (MAX(s_{x[i]}) * MAX(s_y)) AS b{i}" for i in range(n)])}
         FROM {train}, moments)"""]
    for k in range(n):
        cells = [f"a{i}_{j}" + (f" - a{i}_{k} / a{k}_{k} * a{k}_{j} AS a{i}_{j}" if i != k else "")
                 for i in range(n) for j in range(n)]
        cells += [f"b{i}" + (f" - a{i}_{k} / a{k}_{k} * b{k} AS b{i}" if i != k else "") for i in range(n)]
        steps.append(f"\n, e{k + 1} AS (SELECT {', '.join(cells)} FROM e{k})")
    weights = ", ".join(f"b{i} / a{i}_{i} * s_y / s_{x[i]} AS w{i}" for i in range(n))
    intercept = " - ".join(["m_y", *(f"w{i} * m_{x[i]}" for i in range(n))])
    return _fact(f"""{ranks}
, model AS (SELECT order_key % 5 = 4 AS is_test, {", ".join(
        f"CAST({c} AS DOUBLE) AS {name}" for c, name in zip(columns, x))}, CAST(profit AS DOUBLE) AS y
            FROM fact {" ".join(f"JOIN rank_{d} USING ({d})" for d in dims)})
, moments AS (SELECT {", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in [*x, y])} FROM {train})
{"".join(steps)}
, scaled AS (SELECT {weights}, moments.* FROM e{n}, moments)
, fit AS (SELECT *, {intercept} AS w{n} FROM scaled)
, scored AS (SELECT model.*, {" + ".join(f"w{i} * {x[i]}" for i in range(n))} + w{n} AS prediction
             FROM model, fit WHERE is_test)
{body}""")


def oracle_sql() -> dict[str, str]:
    found = _retail_oracles() | _time_oracles()
    for copy, of in {"csv_predictions": "predictions", "sql_view_region_category_profit": "region_category_profit",
                     "sql_view_profit_by_category": "profit_by_category"}.items():
        found[copy] = found[of]
    if training:
        found |= training.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


_DATED = f"""
dated AS (SELECT fact.*, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_key
          FROM ({FACT_SQL}) fact JOIN orders ON order_key = o_orderkey)"""
_SPANS = f"""
spans AS (SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, l_shipdate
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate),
moments AS (SELECT event_id, ts - INTERVAL {MOMENT_DAYS} DAY AS moment FROM events)"""
_LOADS = """
rows_of AS (SELECT l_quantity AS quantity, l_discount AS discount, year(o_orderdate)::INTEGER AS year,
                   month(o_orderdate) AS m FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
old_load AS (SELECT quantity, discount, year FROM rows_of WHERE m % 3 <> 0),
new_load AS (SELECT quantity, discount, year FROM rows_of WHERE m % 3 <> 1)"""


def _time_oracles() -> dict[str, str]:
    return {
        "csv_fact_report": _fact(f"""
SELECT ship_mode, COUNT(*) AS total_orders, {MONEY_S} AS total_sales
FROM fact WHERE ship_mode <> '5-LOW' AND quantity <> 1 GROUP BY ship_mode"""),
        "preview_lines": _fact("""
SELECT order_key, region, category, sub_category, ship_mode, CAST(f.sales AS DOUBLE) AS sales
FROM fact f ORDER BY f.sales DESC, order_key, sub_category LIMIT 5"""),
        "loss_making_subcategories": _fact(f"""
SELECT sub_category, {MONEY_P} AS total_profit
FROM fact GROUP BY sub_category HAVING SUM(profit) < 0 ORDER BY total_profit ASC, sub_category LIMIT 5"""),
        "quarterly_sales": f"""
WITH {_DATED}, quarters AS (
  SELECT region, date_trunc('quarter', order_date)::DATE AS q, SUM(sales) AS s, SUM(profit) AS p, COUNT(*) AS n
  FROM dated GROUP BY ALL),
dense AS (
  SELECT region, q, coalesce(s, 0) AS s, coalesce(p, 0) AS p, coalesce(n, 0) AS n
  FROM (SELECT region, unnest(generate_series((SELECT min(q) FROM quarters), (SELECT max(q) FROM quarters),
                                              INTERVAL 3 MONTH))::DATE AS q
        FROM (SELECT DISTINCT region FROM quarters) r) c
  LEFT JOIN quarters USING (region, q)),
framed AS (SELECT *, LAG(s, 4) OVER w AS ago, SUM(s) OVER (w ROWS 3 PRECEDING) AS trailed
           FROM dense WINDOW w AS (PARTITION BY region ORDER BY q))
SELECT region, year(q)::INTEGER AS year, quarter(q)::INTEGER AS quarter, CAST(ROUND(s, 2) AS DOUBLE) AS total_sales,
       CAST(ROUND(p, 2) AS DOUBLE) AS total_profit, n AS total_orders,
       CAST(ROUND(trailed, 2) AS DOUBLE) AS trailing_year_sales, CASE WHEN y = 0 THEN CAST(0 AS DOUBLE) ELSE y END AS yoy_pct
FROM (SELECT *, {_pct("(s - ago)", "ago", 1)} AS y FROM framed) t""",
        "best_year": f"""
WITH {_DATED}
SELECT year(order_date)::INTEGER AS best_year, CAST(ROUND(SUM(sales), 2) AS DOUBLE) AS best_year_sales
FROM dated GROUP BY 1 ORDER BY SUM(sales) DESC, 1 LIMIT 1""",
        "peak_quarters": f"""
WITH {_DATED}, quarters AS (
  SELECT year(order_date)::INTEGER AS year, quarter(order_date)::INTEGER AS q, SUM(sales) AS s FROM dated GROUP BY ALL),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY year ORDER BY s DESC, q) AS r FROM quarters)
SELECT year, MAX(q) FILTER (WHERE r = 1) AS peak_quarter, CAST(ROUND(SUM(s), 2) AS DOUBLE) AS total_sales,
       {_pct("coalesce(SUM(s) FILTER (WHERE q = 4), 0)", "SUM(s)", 1)} AS q4_share_pct,
       MAX(q) FILTER (WHERE r = 1) = 4 AS q4_is_peak
FROM ranked GROUP BY year""",
        "last_click_before_purchase": """
SELECT p.event_id, p.user_id, p.value, CASE WHEN near THEN c.event_id END AS click_id,
       CASE WHEN near THEN c.value END AS click_value,
       CASE WHEN near THEN epoch_us(p.ts) - epoch_us(c.ts) END AS gap_us
FROM (SELECT p.*, c, c.ts >= p.ts - INTERVAL 3 DAY AS near
      FROM (SELECT * FROM events WHERE event_type = 'purchase') p
      ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON p.user_id = c.user_id AND p.ts >= c.ts) p""",
        "express_lines_at_events": f"""
WITH {_SPANS}
SELECT event_id, l_orderkey AS order_key, l_linenumber AS line_number, l_partkey AS part_key,
       epoch_us(moment) - epoch_us(o_orderdate) AS open_us
FROM (SELECT * FROM spans WHERE date_diff('day', o_orderdate, l_shipdate) <= {EXPRESS_DAYS}) s
JOIN moments ON moment >= o_orderdate AND moment < l_shipdate""",
        "open_lines_at_events": f"""
WITH {_SPANS},
steps AS (SELECT o_orderdate AS t, 1 AS step, 0 AS kind, NULL AS event_id FROM spans
          UNION ALL SELECT l_shipdate, -1, 0, NULL FROM spans
          UNION ALL SELECT moment, 0, 1, event_id FROM moments)
SELECT event_id, CAST(n AS BIGINT) AS open_lines
FROM (SELECT event_id, kind, SUM(step) OVER (ORDER BY t, kind RANGE UNBOUNDED PRECEDING) AS n FROM steps) t
WHERE kind = 1""",
        "event_sessions": """
WITH marked AS (
  SELECT *, CASE WHEN ts - LAG(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, SUM(first) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM marked)
SELECT user_id, epoch_us(MIN(ts)) AS start_us, epoch_us(MAX(ts)) - epoch_us(MIN(ts)) + 1800000000 AS span_us,
       COUNT(*) AS n_events, COUNT(*) FILTER (WHERE event_type = 'purchase') AS n_purchases,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM numbered GROUP BY user_id, k""",
        "event_properties": """
WITH pairs AS (SELECT event_type, props, unnest(json_keys(props)) AS property FROM events)
SELECT event_type, property, COUNT(*) AS n, MIN(v) AS low, MAX(v) AS high, SUM(v) AS total
FROM (SELECT event_type, property, CAST(json_extract(props, '$."' || property || '"') AS DOUBLE) AS v FROM pairs) t
GROUP BY event_type, property""",
        "sales_running_totals": _fact("""
SELECT order_key, CAST(f.sales AS DOUBLE) AS sales,
       ROW_NUMBER() OVER w AS row_number, DENSE_RANK() OVER (ORDER BY f.sales DESC) AS dense_rank,
       CAST(SUM(f.sales) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_sales
FROM fact f WINDOW w AS (ORDER BY f.sales DESC, order_key, quantity, discount, profit)"""),
        "profit_quantiles": _fact("""
SELECT ship_mode, COUNT(*) AS total_orders, CAST(quantile_disc(profit, 0.5) AS DOUBLE) AS median_profit,
       CAST(quantile_disc(profit, 0.95) AS DOUBLE) AS p95_profit
FROM fact GROUP BY ship_mode"""),
        "customers_by_dimensions": f"""
WITH {_DATED}
SELECT coalesce(nullif(concat_ws('+', CASE WHEN GROUPING(region) = 0 THEN 'region' END,
                                 CASE WHEN GROUPING(category) = 0 THEN 'category' END,
                                 CASE WHEN GROUPING(ship_mode) = 0 THEN 'ship_mode' END), ''), 'all') AS grouped,
       region, category, ship_mode, COUNT(DISTINCT customer_key) AS customers
FROM dated GROUP BY CUBE (region, category, ship_mode)""",
        "sales_cube": _fact(f"""
SELECT CAST(31 - GROUPING_ID(segment, ship_mode, sub_category, category, region) AS INTEGER) AS cuboid,
       region, category, sub_category, ship_mode, segment,
       {MONEY_S} AS total_sales, {MONEY_P} AS total_profit, COUNT(*) AS total_orders
FROM fact GROUP BY CUBE (region, category, sub_category, ship_mode, segment)"""),
        "parts_not_in_bulk": f"""
SELECT p_partkey AS part_key, p_brand AS brand FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount >= {HI} AND l_quantity >= {BULK})""",
        "load_reconciliation": f"""
WITH {_LOADS}, counts AS (
  SELECT quantity, discount, year, SUM(o)::BIGINT AS n_old, SUM(n)::BIGINT AS n_new
  FROM (SELECT *, 1 AS o, 0 AS n FROM old_load UNION ALL SELECT *, 0, 1 FROM new_load) t GROUP BY ALL)
SELECT *, CASE WHEN n_new = 0 THEN 'lost' WHEN n_old = 0 THEN 'added' WHEN n_new < n_old THEN 'fewer' ELSE 'more' END
  AS change FROM counts WHERE n_old <> n_new""",
        "load_except_all": f"WITH {_LOADS} SELECT * FROM old_load EXCEPT ALL SELECT * FROM new_load",
        "load_intersect_all": f"WITH {_LOADS} SELECT * FROM old_load INTERSECT ALL SELECT * FROM new_load",
    }


def _retail_oracles() -> dict[str, str]:
    hi = f"discount >= {HI}"
    return {
        "sales_profit_by_region": _fact(f"""
SELECT region, {MONEY_S} AS total_sales, {MONEY_P} AS total_profit
FROM fact GROUP BY region ORDER BY total_sales DESC, region"""),
        "top5_subcategory_profit": _fact(f"""
SELECT sub_category, {MONEY_P} AS total_profit
FROM fact GROUP BY sub_category ORDER BY total_profit DESC, sub_category LIMIT 5"""),
        "bottom5_subcategory_profit": _fact(f"""
SELECT sub_category, {MONEY_P} AS total_profit
FROM fact GROUP BY sub_category ORDER BY total_profit ASC, sub_category LIMIT 5"""),
        "sales_by_ship_mode": _fact(f"""
SELECT ship_mode, COUNT(*) AS total_orders, {MONEY_S} AS total_sales
FROM fact GROUP BY ship_mode ORDER BY total_sales DESC, ship_mode"""),
        "profit_by_category": _fact(f"""
SELECT category, {MONEY_S} AS total_sales, {MONEY_P} AS total_profit,
       ROUND(CAST(SUM(CAST(discount AS DECIMAL(4,2))) AS DOUBLE) / COUNT(discount), 3)
         AS avg_discount
FROM fact GROUP BY category ORDER BY total_profit DESC, category"""),
        "region_category_profit": _fact(f"""
SELECT region, category, {MONEY_S} AS total_sales, {MONEY_P} AS total_profit
FROM fact GROUP BY region, category ORDER BY total_profit DESC, region, category"""),

        "clean_count": _fact("""
SELECT COUNT(*) AS rows_in,
       COUNT(*) FILTER (WHERE ship_mode <> '5-LOW' AND quantity <> 1 AND region IS NOT NULL
         AND segment IS NOT NULL AND category IS NOT NULL AND sub_category IS NOT NULL
         AND discount IS NOT NULL AND sales IS NOT NULL AND profit IS NOT NULL) AS rows_out
FROM fact"""),
        "clean_ship_modes": _fact(f"""
SELECT ship_mode, COUNT(*) AS total_orders, {MONEY_S} AS total_sales
FROM (SELECT nullif(ship_mode, '5-LOW') AS ship_mode, nullif(quantity, 1) AS quantity, sales FROM fact) t
WHERE ship_mode IS NOT NULL AND quantity IS NOT NULL
GROUP BY ship_mode ORDER BY total_sales DESC, ship_mode"""),
        "csv_round_trip": _fact(f"""
SELECT region, category, {MONEY_S} AS total_sales, {MONEY_P} AS total_profit
FROM fact GROUP BY region, category"""),
        "row_count": _fact("SELECT COUNT(*) AS total_orders FROM fact"),
        "project_order_lines": _fact(f"SELECT {LINES} FROM fact"),
        "profitable_orders": _fact(f"SELECT {LINES} FROM fact WHERE profit > 0"),
        "loss_orders": _fact(f"SELECT {LINES} FROM fact WHERE profit < 0"),
        "high_discount_orders": _fact(f"SELECT {LINES} FROM fact WHERE {hi}"),
        "zero_discount_orders": _fact(f"SELECT {LINES} FROM fact WHERE discount = 0"),

        "breakdown_region": _breakdown("region", "total_sales"),
        "breakdown_category": _breakdown("category", "total_profit"),
        "breakdown_subcategory": _breakdown("sub_category", "total_profit"),
        "breakdown_ship_mode": _fact(f"""
SELECT ship_mode, {MONEY_S} AS total_sales, {MONEY_P} AS total_profit, COUNT(*) AS total_orders,
       {_pct("SUM(sales)", "ROUND(SUM(SUM(sales)) OVER (), 2)", 1)} AS share_pct
FROM fact GROUP BY ship_mode ORDER BY total_sales DESC, ship_mode"""),
        "ship_mode_order_share": _fact(f"""
SELECT ship_mode, COUNT(*) AS total_orders,
       {_pct("COUNT(*)", "SUM(COUNT(*)) OVER ()", 1)} AS order_share_pct
FROM fact GROUP BY ship_mode ORDER BY total_orders DESC, ship_mode"""),
        "breakdown_all_dimensions": _fact(f"""
SELECT CASE WHEN GROUPING(region) = 0 THEN 'region'
            WHEN GROUPING(category) = 0 THEN 'category'
            WHEN GROUPING(sub_category) = 0 THEN 'sub_category'
            WHEN GROUPING(ship_mode) = 0 THEN 'ship_mode' ELSE 'all' END AS dimension,
       COALESCE(region, category, sub_category, ship_mode) AS dim_value,
       {MONEY_S} AS total_sales, {MONEY_P} AS total_profit, COUNT(*) AS total_orders,
       {MARGIN.format(n=1)} AS margin_pct
FROM fact
GROUP BY GROUPING SETS ((region), (category), (sub_category), (ship_mode), ())"""),

        "kpi_totals": _fact(f"""
SELECT {MONEY_S} AS total_sales, {MONEY_P} AS total_profit, COUNT(*) AS total_orders,
       {MARGIN.format(n=2)} AS profit_margin_pct,
       ROUND(CAST(SUM(sales) AS DOUBLE) / NULLIF(CAST(COUNT(sales) AS DOUBLE), 0), 2)
         AS avg_order_value,
       ROUND(CAST(SUM(CAST(discount AS DECIMAL(4,2))) AS DOUBLE)
             / NULLIF(CAST(COUNT(discount) AS DOUBLE), 0) * 100, 1) AS avg_discount_pct
FROM fact"""),
        "kpi_order_quality": _fact(f"""
SELECT total_orders, profitable_orders, loss_orders,
       total_orders - profitable_orders - loss_orders AS breakeven_orders,
       {_pct("profitable_orders", "total_orders", 1)} AS profit_pct,
       {_pct("loss_orders", "total_orders", 1)} AS loss_pct
FROM (SELECT COUNT(*) AS total_orders,
             COUNT(*) FILTER (WHERE profit > 0) AS profitable_orders,
             COUNT(*) FILTER (WHERE profit < 0) AS loss_orders FROM fact) t"""),
        "kpi_discount_impact": _fact(f"""
SELECT high_disc_count, {_pct("high_disc_count", "n", 1)} AS high_disc_pct,
       ROUND(hi_mean, 2) AS high_disc_avg_profit,
       ABS(ROUND(hi_mean, 2)) AS high_disc_abs_avg_profit,
       ROUND(zero_mean, 2) AS zero_disc_avg_profit,
       ROUND(ROUND(zero_mean, 2) - ROUND(hi_mean, 2), 2) AS discount_profit_gap
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE {hi}) AS high_disc_count,
             {_mean("profit", hi)} AS hi_mean,
             {_mean("profit", "discount = 0")} AS zero_mean FROM fact) t"""),
        "kpi_summary": _fact(f"""
SELECT CAST(ROUND(s, 2) AS DOUBLE) AS total_sales, CAST(ROUND(p, 2) AS DOUBLE) AS total_profit,
       total_orders, ROUND(CAST(p AS DOUBLE) / NULLIF(CAST(s AS DOUBLE), 0) * 100, 2)
         AS profit_margin_pct,
       ROUND(CAST(s AS DOUBLE) / NULLIF(CAST(ns AS DOUBLE), 0), 2) AS avg_order_value,
       ROUND(CAST(d AS DOUBLE) / NULLIF(CAST(nd AS DOUBLE), 0) * 100, 1) AS avg_discount_pct,
       profitable_orders, loss_orders,
       {_pct("profitable_orders", "total_orders", 1)} AS profit_pct,
       {_pct("loss_orders", "total_orders", 1)} AS loss_pct,
       high_disc_count, {_pct("high_disc_count", "total_orders", 1)} AS high_disc_pct,
       ROUND(hi_mean, 2) AS high_disc_avg_profit, ROUND(zero_mean, 2) AS zero_disc_avg_profit,
       ROUND(ROUND(zero_mean, 2) - ROUND(hi_mean, 2), 2) AS discount_profit_gap
FROM (SELECT SUM(sales) AS s, SUM(profit) AS p, COUNT(*) AS total_orders,
             SUM(CAST(discount AS DECIMAL(4,2))) AS d, COUNT(discount) AS nd,
             COUNT(sales) AS ns,
             COUNT(*) FILTER (WHERE profit > 0) AS profitable_orders,
             COUNT(*) FILTER (WHERE profit < 0) AS loss_orders,
             COUNT(*) FILTER (WHERE {hi}) AS high_disc_count,
             {_mean("profit", hi)} AS hi_mean,
             {_mean("profit", "discount = 0")} AS zero_mean FROM fact) t"""),
        "kpi_extremes": _fact("""
, r AS (SELECT region AS k, SUM(sales) AS s, SUM(profit) AS p FROM fact GROUP BY region)
, c AS (SELECT category AS k, SUM(sales) AS s, SUM(profit) AS p FROM fact GROUP BY category)
, sc AS (SELECT sub_category AS k, SUM(sales) AS s, SUM(profit) AS p FROM fact GROUP BY sub_category)
, sm AS (SELECT ship_mode AS k, SUM(sales) AS s, SUM(profit) AS p FROM fact GROUP BY ship_mode)
, tot AS (SELECT SUM(sales) AS s FROM fact)
SELECT (SELECT k FROM r ORDER BY s DESC, k LIMIT 1) AS top_region,
       (SELECT CAST(ROUND(s, 2) AS DOUBLE) FROM r ORDER BY s DESC, k LIMIT 1) AS top_region_sales,
       (SELECT CAST(ROUND(p, 2) AS DOUBLE) FROM r ORDER BY s DESC, k LIMIT 1) AS top_region_own_profit,
       (SELECT CAST(ROUND(MAX(p), 2) AS DOUBLE) FROM r) AS max_region_profit,
       (SELECT k FROM r ORDER BY s ASC, k LIMIT 1) AS bottom_region,
       (SELECT k FROM c ORDER BY p DESC, k LIMIT 1) AS top_category,
       (SELECT CAST(ROUND(p, 2) AS DOUBLE) FROM c ORDER BY p DESC, k LIMIT 1) AS top_category_profit,
       (SELECT k FROM sc ORDER BY p DESC, k LIMIT 1) AS best_subcategory,
       (SELECT CAST(ROUND(p, 2) AS DOUBLE) FROM sc ORDER BY p DESC, k LIMIT 1)
         AS best_subcategory_profit,
       (SELECT k FROM sc ORDER BY p ASC, k LIMIT 1) AS worst_subcategory,
       (SELECT CAST(ROUND(p, 2) AS DOUBLE) FROM sc ORDER BY p ASC, k LIMIT 1)
         AS worst_subcategory_profit,
       (SELECT ABS(CAST(ROUND(p, 2) AS DOUBLE)) FROM sc ORDER BY p ASC, k LIMIT 1)
         AS worst_subcategory_abs_loss,
       (SELECT k FROM sm ORDER BY s DESC, k LIMIT 1) AS top_ship_mode,
       (SELECT ROUND(CAST(sm.s AS DOUBLE) / NULLIF(CAST(ROUND(tot.s, 2) AS DOUBLE), 0) * 100, 1)
          FROM sm, tot ORDER BY sm.s DESC, sm.k LIMIT 1) AS top_ship_mode_share_pct"""),

        "top_region": _rank("region", "sales", "DESC", "total_sales"),
        "bottom_region": _rank("region", "sales", "ASC", "total_sales"),
        "top_category": _rank("category", "profit", "DESC", "total_profit"),
        "best_subcategory": _rank("sub_category", "profit", "DESC", "total_profit"),
        "worst_subcategory": _fact("""
SELECT sub_category, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit,
       ABS(CAST(ROUND(SUM(profit), 2) AS DOUBLE)) AS abs_profit
FROM fact GROUP BY sub_category ORDER BY SUM(profit) ASC, sub_category LIMIT 1"""),
        "top_ship_mode_share": _fact(f"""
SELECT ship_mode, total_sales, share_pct FROM (
  SELECT ship_mode, {MONEY_S} AS total_sales, SUM(sales) AS s,
         {_pct("SUM(sales)", "ROUND(SUM(SUM(sales)) OVER (), 2)", 1)} AS share_pct
  FROM fact GROUP BY ship_mode) t
ORDER BY s DESC, ship_mode LIMIT 1"""),

        "chart_region_sales": _fact(f"""
SELECT region, {MONEY_S} AS total_sales,
       format('${{:,.0f}}', CAST(SUM(sales) AS DOUBLE)) AS value_label
FROM fact GROUP BY region ORDER BY SUM(sales) DESC, region"""),
        "chart_category_profit": _fact(f"""
SELECT category, {MONEY_P} AS total_profit,
       format('${{:,.0f}}', CAST(SUM(profit) AS DOUBLE)) AS value_label
FROM fact GROUP BY category ORDER BY SUM(profit) DESC, category"""),
        "top10_subcategory_sales": _fact(f"""
SELECT sales_rank, sub_category, total_sales, sales_rank <= 3 AS highlight FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY SUM(sales) DESC, sub_category) AS sales_rank,
         sub_category, {MONEY_S} AS total_sales
  FROM fact GROUP BY sub_category) t
WHERE sales_rank <= 10 ORDER BY sales_rank"""),
        "discount_profit_points": _fact(f"""
SELECT CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit,
       CASE WHEN profit < 0 THEN 'loss' ELSE 'profit' END AS point_class,
       CASE WHEN {hi} THEN 'high' ELSE 'low' END AS discount_side
FROM fact"""),
        "discount_profit_density": _fact(f"""
SELECT CAST(discount AS DOUBLE) AS discount,
       CAST(FLOOR(CAST(profit AS DOUBLE) / {BIN}) AS BIGINT) AS profit_bin,
       CASE WHEN profit < 0 THEN 'loss' ELSE 'profit' END AS point_class,
       COUNT(*) AS points
FROM fact GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""),
        "chart_ship_mode_share": _fact(f"""
SELECT ship_mode, {MONEY_S} AS total_sales,
       {_pct("SUM(sales)", "SUM(SUM(sales)) OVER ()", 1)} AS share_pct
FROM fact GROUP BY ship_mode ORDER BY ship_mode"""),

        "formatted_region_table": _fact(_money_table("region", "sales")),
        "formatted_category_table": _fact(_money_table("category", "profit")),
        "formatted_subcategory_table": _fact(_money_table("sub_category", "profit")),
        "formatted_ship_mode_table": _fact(f"""
SELECT ship_mode, format('{{:,}}', COUNT(*)) AS orders_label,
       format('${{:,.0f}}', CAST(SUM(sales) AS DOUBLE)) AS sales_label,
       format('${{:,.0f}}', CAST(SUM(profit) AS DOUBLE)) AS profit_label,
       CASE WHEN SUM(profit) > 0 THEN 'pos' ELSE 'neg' END AS profit_class,
       CAST({_pct("SUM(sales)", "ROUND(SUM(SUM(sales)) OVER (), 2)", 1)} AS VARCHAR) || '%'
         AS share_label
FROM fact GROUP BY ship_mode ORDER BY SUM(sales) DESC, ship_mode"""),
        "search_breakdown": _fact(f"""
SELECT * FROM ({_money_table("region", "sales")}) t
WHERE contains(lower(concat_ws('', region, sales_label, profit_label, margin_label)),
               '{SEARCH_TEXT}')"""),

        "breakdown_sign_class": _fact(f"""
SELECT CASE WHEN GROUPING(region) = 0 THEN 'region'
            WHEN GROUPING(category) = 0 THEN 'category'
            WHEN GROUPING(sub_category) = 0 THEN 'sub_category' ELSE 'ship_mode' END AS dimension,
       COALESCE(region, category, sub_category, ship_mode) AS dim_value,
       {MONEY_P} AS total_profit,
       CASE WHEN SUM(profit) > 0 THEN 'pos' ELSE 'neg' END AS profit_class
FROM fact
GROUP BY GROUPING SETS ((region), (category), (sub_category), (ship_mode))
ORDER BY dimension, dim_value"""),
        "report_rollup": _fact(f"""
SELECT region, category, sub_category, ship_mode,
       {MONEY_S} AS m_sales, {MONEY_P} AS m_profit, COUNT(*) AS m_orders,
       COUNT(sales) AS m_sales_n,
       CAST(ROUND(SUM(CAST(discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS m_disc_sum,
       COUNT(discount) AS m_disc_n,
       COUNT(*) FILTER (WHERE profit > 0) AS m_profitable,
       COUNT(*) FILTER (WHERE profit < 0) AS m_loss,
       COUNT(*) FILTER (WHERE {hi}) AS m_hi_orders,
       COUNT(*) FILTER (WHERE {hi} AND profit < 0) AS m_hi_loss,
       CAST(ROUND(SUM(profit) FILTER (WHERE {hi}), 2) AS DOUBLE) AS m_hi_profit,
       COUNT(profit) FILTER (WHERE {hi}) AS m_hi_profit_n,
       COUNT(*) FILTER (WHERE NOT COALESCE({hi}, false)) AS m_lo_orders,
       CAST(ROUND(SUM(profit) FILTER (WHERE NOT COALESCE({hi}, false)), 2) AS DOUBLE)
         AS m_lo_profit,
       CAST(ROUND(SUM(profit) FILTER (WHERE discount = 0), 2) AS DOUBLE) AS m_zero_profit,
       COUNT(profit) FILTER (WHERE discount = 0) AS m_zero_profit_n,
       CAST({HI} AS DOUBLE) AS high_discount
FROM fact GROUP BY region, category, sub_category, ship_mode"""),
        "high_discount_loss_rate": _fact(f"""
SELECT high_disc_orders, high_disc_loss_orders,
       {_pct("high_disc_loss_orders", "high_disc_orders", 1)} AS loss_rate_pct
FROM (SELECT COUNT(*) FILTER (WHERE {hi}) AS high_disc_orders,
             COUNT(*) FILTER (WHERE {hi} AND profit < 0) AS high_disc_loss_orders
      FROM fact) t"""),
        "subcategory_discount_band_profit": _fact(f"""
SELECT sub_category, CASE WHEN {hi} THEN 'high' ELSE 'low' END AS discount_band,
       {MONEY_P} AS total_profit, COUNT(*) AS total_orders
FROM fact GROUP BY 1, 2 ORDER BY 1, 2"""),

        "category_discount_rank": _fact("""
SELECT category, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit,
       ROUND(CAST(SUM(CAST(discount AS DECIMAL(4,2))) AS DOUBLE)
             / NULLIF(CAST(COUNT(discount) AS DOUBLE), 0), 3) AS avg_discount,
       ROW_NUMBER() OVER (ORDER BY SUM(profit) DESC, category) AS profit_rank,
       ROW_NUMBER() OVER (ORDER BY CAST(SUM(CAST(discount AS DECIMAL(4,2))) AS DOUBLE)
                          / NULLIF(CAST(COUNT(discount) AS DOUBLE), 0) ASC, category) AS discount_rank
FROM fact GROUP BY category"""),

        "index_segment": _label_index("segment"),
        "index_category": _label_index("category"),
        "index_region": _label_index("region"),
        "index_ship_mode": _label_index("ship_mode"),
        "feature_matrix": _fact("""
, seg AS (SELECT segment, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, segment) - 1 AS i
          FROM fact GROUP BY segment)
, cat AS (SELECT category, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, category) - 1 AS i
          FROM fact GROUP BY category)
, reg AS (SELECT region, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, region) - 1 AS i
          FROM fact GROUP BY region)
, shp AS (SELECT ship_mode, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, ship_mode) - 1 AS i
          FROM fact GROUP BY ship_mode)
SELECT CAST(f.sales AS DOUBLE) AS sales, CAST(f.quantity AS DOUBLE) AS quantity,
       CAST(f.discount AS DOUBLE) AS discount, CAST(seg.i AS DOUBLE) AS segment_idx,
       CAST(cat.i AS DOUBLE) AS category_idx, CAST(reg.i AS DOUBLE) AS region_idx,
       CAST(shp.i AS DOUBLE) AS ship_mode_idx
FROM fact f JOIN seg USING (segment) JOIN cat USING (category)
     JOIN reg USING (region) JOIN shp USING (ship_mode)"""),
        "random_split_total": _fact("SELECT COUNT(*) AS rows, true AS share_holds FROM fact"),
        "regression_coefficients": _ridge(" UNION ALL ".join(
            f"SELECT '{name}' AS feature, ROUND(w{i}, 4) AS coefficient FROM fit"
            for i, name in enumerate([*M.FEATURES, "intercept"]))),
        "regression_metrics": _ridge("""
SELECT ROUND(SQRT(AVG((y - prediction) * (y - prediction))), 4) AS rmse,
       ROUND(1 - SUM((y - prediction) * (y - prediction)) / (VAR_POP(y) * COUNT(*)), 8) AS r2,
       COUNT(*) AS test_rows FROM scored"""),
        "predictions": _ridge("""
SELECT x0 AS sales, x1 AS quantity, x2 AS discount, y AS profit, ROUND(prediction, 2) AS prediction
FROM scored"""),
        "train_test_counts": _fact("""
SELECT CASE WHEN order_key % 5 = 4 THEN 'test' ELSE 'train' END AS split, COUNT(*) AS rows
FROM fact GROUP BY 1"""),
    }
