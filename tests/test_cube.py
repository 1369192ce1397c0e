"""The cube lattice against GROUP BY CUBE, its parents and its reads."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.config import DIMENSIONS
from ledgerline.plans import cube as C, inspect as I


def test_cube_equals_group_by_cube(spark, fact_small):
    cube = C.build_cube(fact_small)
    want = fact_small.cube(*DIMENSIONS).agg(
        F.grouping_id().alias("gid"), F.sum("sales").alias("sales"), F.sum("profit").alias("profit"),
        F.count(F.lit(1)).alias("lines"))
    got = {(r["cuboid"], *(r[d] for d in DIMENSIONS)): (r["sales"], r["profit"], r["lines"]) for r in cube.collect()}
    # grouping_id has the first dimension as its highest bit, and 1 where it is not grouped
    mask = lambda gid: sum(1 << k for k in range(5) if not gid >> (4 - k) & 1)
    rows = want.collect()
    assert {(mask(r["gid"]), *(r[d] for d in DIMENSIONS)): (r["sales"], r["profit"], r["lines"]) for r in rows} == got
    assert len(got) == len(rows) and {k[0] for k in got} == set(range(32))
    # a cuboid is read alone, and the lines not at all
    one = C.cuboid(cube, ["region", "segment"])
    assert len(I.scans(one)) == 1 and "PartitionFilters: [isnotnull(cuboid" in I.plan_text(one)
    C.drop_cube(cube)


def test_parents_are_the_smallest_ones():
    dims = ["a", "b", "c"]
    rows = {0b111: 100, 0b011: 50, 0b101: 10, 0b110: 70}
    assert C.smallest_parent(["a"], dims, rows) == 0b101
    assert C.smallest_parent(["b"], dims, rows) == 0b011
    assert C.smallest_parent(["a", "b"], dims, rows) == 0b111


def test_null_values_and_no_lines(spark):
    df = spark.createDataFrame([("x", None, Decimal("1.50"), Decimal("1")), (None, None, Decimal("2.50"), Decimal("-1")),
                                ("x", "y", Decimal("4.00"), Decimal("0"))],
                               "a string, b string, sales decimal(18,2), profit decimal(18,4)")
    got = {tuple(r[:3]): (r["sales"], r["lines"]) for r in C.build_cube(df, ["a", "b"]).collect()}
    assert got == {(3, "x", None): (Decimal("1.50"), 1), (3, None, None): (Decimal("2.50"), 1),
                   (3, "x", "y"): (Decimal("4.00"), 1), (1, "x", None): (Decimal("5.50"), 2),
                   (1, None, None): (Decimal("2.50"), 1), (2, None, None): (Decimal("4.00"), 2),
                   (2, None, "y"): (Decimal("4.00"), 1), (0, None, None): (Decimal("8.00"), 3)}
    assert C.build_cube(df.where("false"), ["a", "b"]).count() == 0
