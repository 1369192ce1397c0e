"""Bind the star-schema test tables to the sales fact.

The reference analyses one flat, already denormalised order-line table. The
driver's tables are a TPC-H-like star schema, so the fact is rebuilt by joins:

    region      <- customer -> nation -> region
    segment     <- customer.c_mktsegment
    ship_mode   <- orders.o_orderpriority (there is no ship-mode column)
    category    <- part.p_type
    sub_category<- part.p_brand
    sales       =  l_extendedprice                         DECIMAL(18,2)
    profit      =  sales*(1-discount) - 0.60*qty*retailprice  DECIMAL(18,4)

``profit`` is an invented margin (the test data has no cost column).

Join shape: see ``bind_fact``. Broadcasts are decided by measured row counts
and measured bytes of the shipped columns (``ledgerline.plans.strategy``),
never by hope: with every dimension small the
fact is one shuffle-free pipeline; beyond the bound the large sides are joined
by shuffle, line data crossing the network at most twice (order key, part
key), and AQE splits a hot key's partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.cleaning import clean
from ledgerline.plans.strategy import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, small_tables, spread
from ledgerline.session import start_partitions

STAR_TABLES = ("lineitem", "orders", "customer", "part", "nation", "region")
# The columns each dimension contributes to the fact (what a broadcast ships).
DIM_COLUMNS = {
    "orders": ("o_orderkey", "o_custkey", "o_orderpriority"),
    "customer": ("c_custkey", "c_nationkey", "c_mktsegment"),
    "part": ("p_partkey", "p_type", "p_brand", "p_retailprice"),
    "nation": ("n_nationkey", "n_regionkey"),
    "region": ("r_regionkey", "r_name"),
}

# Fixed value: the synthetic cost is 60 % of list price per unit.
COST_SHARE = "0.60"


# Types of the columns the fact reads: passed to the reader, so that no footer
# is opened to infer them. The file listing is fresh on every read.
COLUMN_TYPES = {
    "lineitem": "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, "
                "l_discount double",
    "orders": "o_orderkey long, o_custkey long, o_orderpriority string",
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "part": "p_partkey long, p_type string, p_brand string, p_retailprice double",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns of one table that the fact uses."""
    return spark.read.schema(COLUMN_TYPES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_side(dims: dict[str, DataFrame], small: dict[str, bool]) -> DataFrame:
    """order_key -> ship_mode, segment, region.

    ``small`` says which of orders/customer/nation/region passed the
    broadcast size check; the others are joined by shuffle.
    """
    orders, customer, nation, region = (dims[t] for t in ("orders", "customer", "nation", "region"))

    def maybe(df: DataFrame, name: str) -> DataFrame:
        return F.broadcast(df) if small.get(name) else df.hint("merge")

    # nation x region first: both tiny, so the customer rows meet one
    # small geo table instead of two joins.
    geo = maybe(nation, "nation").join(maybe(region, "region"),
                                       nation.n_regionkey == region.r_regionkey)
    geo = geo.select("n_nationkey", F.col("r_name"))
    if small.get("nation") and small.get("region"):
        geo = F.broadcast(geo)
    cust = maybe(customer, "customer").join(geo, customer.c_nationkey == geo.n_nationkey) \
        .select("c_custkey", "c_mktsegment", "r_name")
    cust = (F.broadcast(cust) if small.get("customer") and small.get("nation")
            and small.get("region") else cust.hint("merge"))
    return (maybe(orders, "orders").join(cust, orders.o_custkey == cust.c_custkey)
            .select(F.col("o_orderkey"),
                    F.col("o_orderpriority").alias("ship_mode"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("r_name").alias("region")))


def line_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order-line columns the fact needs."""
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One dimension table, projected to the columns the fact uses."""
    return read_table(spark, sf_dir, name).select(*DIM_COLUMNS[name])


def measures() -> tuple:
    """sales DECIMAL(18,2) and the synthetic profit DECIMAL(18,4)."""
    sales = F.col("l_extendedprice").cast("decimal(18,2)")
    net = sales * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    cost = (F.lit(COST_SHARE).cast("decimal(4,2)")
            * F.col("l_quantity").cast("decimal(6,0)")
            * F.col("p_retailprice").cast("decimal(10,2)"))
    return sales.alias("sales"), (net - cost).cast("decimal(18,4)").alias("profit")


FACT_COLUMNS = ("order_key", "region", "segment", "category", "sub_category",
                "ship_mode", "quantity", "discount", "sales", "profit")


def bind_fact(spark: SparkSession, sf_dir: str,
              max_broadcast_rows: int = BROADCAST_MAX_ROWS,
              max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
              raw: bool = False) -> DataFrame:
    """The sales fact over the whole star schema (lazy), without the rows that
    have a null in any of its columns (``raw=True`` keeps them, as the
    reference's pandas path does before it groups).

    Every call lists and measures the tables anew, so rows appended since the
    last call are in and a dimension that grew is no longer broadcast.

    Two shapes, chosen by measured table sizes (``strategy.small_tables``):

    * every dimension table (orders, customer, part, nation, region) within
      the broadcast bound: one pipeline - the line scan streams through five
      broadcast hash joins and the measures are computed in the same stage,
      with no shuffle at all;
    * otherwise (the large case): the order side (orders + customer + nation
      + region) meets the lines on the order key, then the part side on the
      part key. A side is broadcast when everything in it passed the check;
      the others are shuffled (at most two exchanges of line data, started
      with partitions sized by the line count), and AQE splits skewed keys.
      The per-line DECIMAL measures are computed after the joins.
    """
    small = broadcastable(spark, sf_dir, max_broadcast_rows, max_broadcast_bytes)
    # cleaned where the columns come from: before a measure is computed of them
    lines = line_side(spark, sf_dir)
    dims = {t: dimension(spark, sf_dir, t) for t in DIM_COLUMNS}
    if not raw:
        lines, dims = clean(lines), {t: clean(df) for t, df in dims.items()}
    if all(small.values()):
        return _star_pipeline(spread(spark, lines, ["l_orderkey", "l_partkey"]), dims)
    # Beyond the bound at least one side is joined by shuffle. The merge hint
    # keeps Spark's file-size estimate from broadcasting the line side
    # instead; a side is broadcast only if all its tables passed the check.
    start_partitions(spark, line_shuffle_bytes(spark, sf_dir))
    orders = order_side(dims, small)
    order_tables = ("orders", "customer", "nation", "region")
    orders = F.broadcast(orders) if all(small[t] for t in order_tables) else orders.hint("merge")
    parts = F.broadcast(dims["part"]) if small["part"] else dims["part"].hint("merge")
    fact = (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .join(parts, lines.l_partkey == parts.p_partkey))
    return _fact_columns(fact)


def broadcastable(spark: SparkSession, sf_dir: str,
                  max_rows: int = BROADCAST_MAX_ROWS,
                  max_bytes: int = BROADCAST_MAX_BYTES) -> dict[str, bool]:
    """Which dimensions are proven small enough to ship whole, together."""
    return small_tables({t: dimension(spark, sf_dir, t) for t in DIM_COLUMNS}, max_rows, max_bytes)


# Bytes per order line in the widest line-grain exchange of the shuffle shape
# (UnsafeRow: 8 null-bit bytes, 8 per field for seven fields, and the three
# short dimension strings).
LINE_EXCHANGE_ROW_BYTES = 8 + 8 * 7 + 3 * 16


def line_shuffle_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Estimated bytes the star join moves per line exchange (line count from
    the parquet footers times ``LINE_EXCHANGE_ROW_BYTES``): the number to size
    shuffle partitions by."""
    return read_table(spark, sf_dir, "lineitem").count() * LINE_EXCHANGE_ROW_BYTES


def _star_pipeline(lines: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    orders, customer, nation, region, parts = (
        dims[t] for t in ("orders", "customer", "nation", "region", "part"))
    fact = (lines
            .join(F.broadcast(orders), lines.l_orderkey == orders.o_orderkey)
            .join(F.broadcast(customer), orders.o_custkey == customer.c_custkey)
            .join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
            .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .join(F.broadcast(parts), lines.l_partkey == parts.p_partkey)
            .select("l_orderkey", F.col("r_name").alias("region"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("o_orderpriority").alias("ship_mode"),
                    "l_quantity", "l_extendedprice", "l_discount",
                    "p_type", "p_brand", "p_retailprice"))
    return _fact_columns(fact)


def _fact_columns(fact: DataFrame) -> DataFrame:
    sales, profit = measures()
    return fact.select(F.col("l_orderkey").alias("order_key"), "region", "segment",
                       F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"),
                       "ship_mode", F.col("l_quantity").alias("quantity"),
                       F.col("l_discount").alias("discount"), sales, profit)


# The same fact as SQL text, for the independent oracle engine.
FACT_SQL = """
SELECT l_orderkey AS order_key, r_name AS region, c_mktsegment AS segment,
       p_type AS category, p_brand AS sub_category, o_orderpriority AS ship_mode,
       l_quantity AS quantity, l_discount AS discount,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS sales,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            - CAST(0.60 AS DECIMAL(4,2)) * CAST(l_quantity AS DECIMAL(6,0))
              * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(18,4)) AS profit
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""
