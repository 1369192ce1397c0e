"""Edge rows of FIXTURES.md section 4, read through the flat-CSV path."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.config import RETAIL, AnalyticsConfig
from ledgerline.operators import breakdowns as B, charts as C, cleaning as CL, kpis as K
from ledgerline.operators import ranking as R, tables as T
from ledgerline.sources.csv import load_retail_fact, read_sales_csv, read_text_csv, to_model

HEADER = ("Row ID,Ship Mode,Segment,Country, Region,Category,Sub-Category,Sales ,"
          "Quantity,Discount,Profit,City,State")
ROWS = [
    "1,Second Class,Consumer,US,West,Furniture,Bookcases,10.50,2,0.2,1.00,A,B",      # plain
    "2,Standard Class,Consumer,US,,Furniture,Chairs,20.00,1,0.0,5.00,A,B",           # null key
    "3,Standard Class,Corporate,US,East,Technology,Phones,,3,0.0,2.00,A,B",          # null measure
    "4,Standard Class,Corporate,US,East,Technology,Phones,30.00,3,0.0,NaN,A,B",      # NaN
    "5,null,NA,US,East,N/A,Phones,40.00,1,0.0,3.00,A,B",                             # null tokens
    "6,First Class,Home Office,US,East,Office Supplies,Paper,1.005,1,0.0,0,A,B",     # zero profit, half
    "7,First Class,Consumer,US,North,Office Supplies,Binders,0,1,0.4,-5.00,A,B",     # zero sales, edge
    "8,Same Day,Consumer,US,West,Technology,Copiers,100.00,2,0.0,7.00,A,B",          # tie
    "9,Same Day,Consumer,US,West,Technology,Accessories,50.00,2,0.0,7.00,A,B",       # tie
]


@pytest.fixture(scope="module")
def csv_path(tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    p = os.path.join(d, "orders.csv")
    with open(p, "w") as f:
        f.write(HEADER + "\n" + "\n".join(ROWS) + "\n")
    return p


@pytest.fixture(scope="module")
def fact(spark, csv_path):
    return load_retail_fact(spark, csv_path)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_header_stripped_and_renamed(spark, csv_path):
    raw = read_sales_csv(spark, csv_path)
    assert "Region" in raw.columns and "Sales" in raw.columns
    model = to_model(raw)
    for c in ("region", "segment", "category", "sub_category", "ship_mode",
              "quantity", "discount", "sales", "profit"):
        assert c in model.columns
    assert dict(model.dtypes)["sales"] == "decimal(18,4)"


def test_null_tokens_become_null(spark, csv_path):
    model = to_model(read_sales_csv(spark, csv_path))
    r = model.filter(F.col("Row ID") == "5").collect()[0]
    assert r.ship_mode is None and r.segment is None and r.category is None


def test_clean_drops_null_nan_and_tokens(spark, csv_path, fact):
    raw = to_model(read_sales_csv(spark, csv_path))
    assert raw.count() == 9
    assert sorted(int(r["Row ID"]) for r in fact.collect()) == [1, 6, 7, 8, 9]
    counts = one(CL.clean_count(raw))
    assert (counts.rows_in, counts.rows_out) == (9, 5)


def test_inferred_schema_path(spark, csv_path):
    raw = read_sales_csv(spark, csv_path, infer=True)
    assert "Region" in raw.columns
    assert CL.clean(to_model(raw)).count() == 5


def test_kpis_on_edges(fact):
    k = one(K.kpi_summary(fact, RETAIL))
    assert k.total_orders == 5
    assert k.total_sales == 161.51          # 161.505 rounded HALF_UP on the decimal
    assert k.total_profit == 10.0
    assert (k.profitable_orders, k.loss_orders) == (3, 1)   # zero profit is neither
    assert k.high_disc_count == 1                            # discount == threshold counts
    assert k.high_disc_avg_profit == -5.0
    assert k.zero_disc_avg_profit == 4.67
    assert k.discount_profit_gap == 9.67
    q = one(K.kpi_order_quality(fact))
    assert q.breakeven_orders == 1
    assert q.profit_pct + q.loss_pct < 100


def test_empty_band_is_null(fact):
    k = one(K.kpi_discount_impact(fact, AnalyticsConfig(high_discount=0.5)))
    assert k.high_disc_count == 0
    assert k.high_disc_avg_profit is None and k.discount_profit_gap is None


def test_zero_sales_margin_is_null(fact):
    rows = {r.region: r for r in B.breakdown_region(fact).collect()}
    assert rows["North"].margin_pct is None
    assert rows["East"].total_sales == 1.01 and rows["East"].margin_pct == 0.0
    assert rows["West"].margin_pct == 9.3


def test_sign_classes(fact):
    table = {r.region: r.profit_class for r in T.formatted_region_table(fact).collect()}
    assert table["East"] == "neg"           # zero profit is 'neg' in the tables
    points = C.discount_profit_points(fact, RETAIL).filter(F.col("profit") == 0).collect()
    assert [p.point_class for p in points] == ["profit"]    # ... and 'profit' in the scatter
    assert {p.discount_side for p in C.discount_profit_points(fact, RETAIL)
            .filter(F.col("discount") == 0.4).collect()} == {"high"}


def test_ties_break_alphabetically(fact):
    assert one(R.best_subcategory(fact)).sub_category == "Accessories"
    ext = one(K.kpi_extremes(fact))
    assert ext.best_subcategory == "Accessories"
    assert ext.worst_subcategory == "Binders" and ext.worst_subcategory_abs_loss == 5.0
    assert ext.top_region == "West" and ext.bottom_region == "North"


def test_formatting_matches_python(fact):
    rows = {r.region: r for r in T.formatted_region_table(fact).collect()}
    assert rows["West"].sales_label == f"${160.5:,.0f}"
    assert rows["North"].profit_label == f"${-5.0:,.0f}"
    assert rows["West"].margin_label == "9.3%"


def test_search_is_case_insensitive(fact):
    assert [r.region for r in T.search_breakdown(fact, "wEsT").collect()] == ["West"]
    assert T.search_breakdown(fact, "").count() == 3


def test_bottom_five_only_losses(fact):
    from ledgerline.operators import queries as Q
    assert [r.sub_category for r in Q.bottom_subcategory_profit(fact, only_losses=True).collect()] \
        == ["Binders"]
    assert Q.bottom_subcategory_profit(fact).count() == 5


def _write(folder, name, lines):
    path = os.path.join(str(folder), name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    _write(tmp_path, "a.csv", ["Ship Mode,Segment,Sales,Profit", "First,Home,10,1"])
    _write(tmp_path, "b.csv", ["Segment,Ship Mode,Profit,Sales", "Home,First,1,10"])
    with pytest.raises(Exception, match="(?i)header"):
        read_sales_csv(spark, str(tmp_path)).collect()


def test_out_of_range_and_exact_money(spark, tmp_path):
    path = _write(tmp_path, "a.csv", ["Sales,Profit,Quantity,Discount",
                                      "1e16,12345678901234.5678,3,0.1", "0.0001,-7,2.0,NaN", "x,,y,z"])
    rows = to_model(read_text_csv(spark, path)).collect()
    assert [r.sales for r in rows] == [None, Decimal("0.0001"), None]
    assert [r.profit for r in rows] == [Decimal("12345678901234.5678"), Decimal("-7.0000"), None]
    assert [r.quantity for r in rows] == [3, 2, None] and [r.discount for r in rows] == [0.1, None, None]


def test_schema_types_are_honoured(spark, tmp_path):
    path = _write(tmp_path, "a.csv", ["Region, Sales ,Quantity", "West,1.5,2", "East,oops,3.0", "None,NULL,none"])
    typed = read_sales_csv(spark, path, StructType.fromDDL("Sales double, Quantity int, Region string, Extra date"))
    assert typed.dtypes == [("Sales", "double"), ("Quantity", "int"), ("Region", "string"), ("Extra", "date")]
    assert [tuple(r) for r in typed.collect()] == [(1.5, 2, "West", None), (None, 3, "East", None),
                                                   (None, None, None, None)]
    assert dict(read_sales_csv(spark, path).dtypes)["Quantity"] == "int"


def test_null_tokens_are_the_configured_ones_in_their_case(spark, tmp_path):
    path = _write(tmp_path, "a.csv", ["Region,Segment", "None,na", "<NA>,Nan", "gone,n/a"])
    got = [tuple(r) for r in load_retail_fact(spark, path, do_clean=False).collect()]
    assert got == [(None, "na"), (None, "Nan"), ("gone", None)]
    own = load_retail_fact(spark, path, do_clean=False, cfg=AnalyticsConfig(null_tokens=("gone",)))
    assert [tuple(r) for r in own.collect()] == [("None", "na"), ("<NA>", "Nan"), (None, "n/a")]
