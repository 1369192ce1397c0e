"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a fixed pseudo-random order, form blocks of
``BLOCK_SIZE`` code points, or of what makes about ``MAX_BLOCKS`` of all sources
where that is more. Target weights become integer shares of a period
of slots: by default of about 2^40, so that over the whole schedule a share is
off its weight by far less than one block. Block j (from 0) of a source with
share k of a period of Q slots is released at slot ``floor(j * Q / k)`` and due
before slot ``ceil((j + 1) * Q / k)``; at every slot the released block with the
earliest deadline goes next (ties: the first source). After t slots every
source has received its share of t to within less than one block.

When a source has no blocks left, a new phase begins at that slot: the others
go on with the same shares in proportion, again from zero deviation, until
every block has its slot. No document is dropped or repeated.

Everything is DataFrame functions. The slots are worked out one by one, by
``aggregate`` over one row of arrays, in ranges of ``SLOTS_PER_RANGE``; the
blocks meet them by an equal join. That is one task of (blocks x sources) steps,
which is why their number is bounded: by ``MAX_BLOCKS`` and one per source.
Offsets within a source are prefix sums in two levels, over hash ranges and inside them,
so a source that holds a third of all rows is spread like any other.

Nulls: a null source is a source of its own, a null text has size zero and
goes with the block it falls into. Repeated rows keep all copies. An empty
table gives no rows. Sources without an explicit weight take the smallest
given one.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import stored

BLOCK_SIZE = 65_536
MAX_BLOCKS = 1_000_000
WEIGHT_BITS = 40
SLOTS_PER_RANGE = 1024
TEMPERATURE = 0.7        # default weights: source size to this power
ROWS_PER_RANGE = 1024
MAX_BROADCAST_BLOCKS = 500_000


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _long(value) -> Column:
    return F.lit(value).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def turns(shares: Column, blocks: Column, total: Column) -> Column:
    """``i, block, slot`` of all ``total`` blocks: the source numbers by earliest
    deadline first, in arrays of ``SLOTS_PER_RANGE`` slots."""
    state_kind = "left:array<bigint>,live:array<bigint>,slots:bigint,done:array<bigint>,begin:bigint"
    one = "array<struct<i:bigint,block:bigint,slot:bigint>>"

    def sum_of(k: Column) -> Column:
        return F.aggregate(k, _long(0), lambda a, x: a + x)

    def step(state: Column, t: Column) -> Column:
        ready = F.filter(
            F.transform(state["live"], lambda k, i: F.when(
                (k > 0) & (_div(state["done"][i] * state["slots"], F.greatest(k, _long(1))) <= t - state["begin"]),
                F.struct(_div((state["done"][i] + 1) * state["slots"] + k - 1, F.greatest(k, _long(1))).alias("due"),
                         i.cast("long").alias("who")))),
            lambda x: x.isNotNull())
        return let(F.array_min(ready)["who"], lambda who: let(
            F.transform(state["left"], lambda x, i: x - F.when(i == who, _long(1)).otherwise(_long(0))),
            lambda left: taken(state, t, who, left)))

    def taken(state: Column, t: Column, who: Column, left: Column) -> Column:
        at = who.cast("int")
        out = F.concat(state["out"], F.array(F.struct(
            who.alias("i"), (F.get(blocks, at) - F.get(state["left"], at)).alias("block"), t.alias("slot"))))

        def result(live: Column, slots: Column, done: Column, begin: Column) -> Column:
            return F.struct(left.alias("left"), live.alias("live"), slots.alias("slots"), done.alias("done"),
                            begin.alias("begin"), out.alias("out")).cast(f"struct<{state_kind},out:{one}>")
        more = F.transform(state["done"], lambda d, i: d + F.when(i == who, _long(1)).otherwise(_long(0)))
        fewer = F.zip_with(shares, left, lambda k, x: F.when(x > 0, k).otherwise(_long(0)))
        return F.when(F.get(left, at) > 0, result(state["live"], state["slots"], more, state["begin"])).otherwise(
            let(fewer, lambda live: result(live, sum_of(live), F.transform(live, lambda k: k * 0), t + 1)))

    def stretch(state: Column, r: Column) -> Column:
        begin = r * SLOTS_PER_RANGE
        inner = F.aggregate(
            F.sequence(begin, F.least(begin + SLOTS_PER_RANGE, total) - 1),
            F.struct(*(state[c] for c in ("left", "live", "slots", "done", "begin")), F.array().cast(one).alias("out"))
            .cast(f"struct<{state_kind},out:{one}>"), step)
        return let(inner, lambda x: F.struct(
            *(x[c].alias(c) for c in ("left", "live", "slots", "done", "begin")),
            F.concat(state["out"], F.array(x["out"])).alias("out")).cast(f"struct<{state_kind},out:array<{one}>>"))

    start = F.struct(blocks.alias("left"), shares.alias("live"), sum_of(shares).alias("slots"),
                     F.transform(shares, lambda k: k * 0).alias("done"), _long(0).alias("begin"),
                     F.array().cast(f"array<{one}>").alias("out")).cast(f"struct<{state_kind},out:array<{one}>>")
    return F.aggregate(F.sequence(_long(0), _div(total - 1, _long(SLOTS_PER_RANGE))), start, stretch,
                       lambda state: state["out"])


def slots(sources: DataFrame) -> DataFrame:
    """``(src, block, slot)`` of every block of ``sources(src, weight, blocks)``
    (each of at least one block), true to the weights over the whole schedule."""
    one = sources.agg(F.array_sort(F.collect_list(F.struct(
        "src", F.col("weight").cast("double").alias("weight"), "blocks"))).alias("all")).where(F.size("all") > 0)
    one = one.select(
        "all", F.aggregate("all", _long(0), lambda a, x: a + x["blocks"]).alias("total"),
        F.aggregate("all", F.lit(0.0), lambda a, x: a + F.coalesce(x["weight"], F.lit(0.0))).alias("sum"))
    # block number times period stays below 2^62
    scale = F.pow(F.lit(2.0), F.least(F.lit(WEIGHT_BITS), 61 - F.ceil(F.log2(F.col("total") + 1.0))))
    one = one.select("all", "total", F.transform("all", lambda x: F.greatest(
        F.round(scale * x["weight"] / F.col("sum")), F.lit(1)).cast("long")).alias("shares"))
    ranges = one.select("all", F.explode(let(F.col("shares"), lambda k: turns(
        k, F.col("all.blocks"), F.col("total")))).alias("range"))
    each = ranges.select("all", F.explode("range").alias("x"))
    return each.select(F.col("all")[F.col("x.i").cast("int")]["src"].alias("src"), "x.block", "x.slot")


def place(docs: DataFrame, weights: DataFrame | None = None, block_size: int = BLOCK_SIZE,
          temperature: float = TEMPERATURE, max_blocks: int = MAX_BLOCKS,
          carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (the columns of ``carry``, default all) with a struct column
    ``(source, block, slot, start, key)``, and that column's name. Sorting by
    ``slot, start, key`` interleaves the sources. ``weights(source, weight)``
    sets the targets; by default a source weighs its size to the power
    ``temperature``."""
    carry = carry or docs.columns
    name = "mix"
    while name in carry:
        name += "_"
    # the documents' columns travel in one struct: their names cannot clash with those made here
    rows = docs.select(
        F.struct(*carry).alias("_doc"), F.col("doc_id").alias("_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_src"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("_size"),
        # 60 bits that spread any rows, also those without an id
        F.conv(F.substring(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text"))), 1, 15),
               16, 10).cast("long").alias("_key"))
    n = docs.count()
    bits = min(40, max(0, ceil(log2(max(n, 1) / ROWS_PER_RANGE)))) if n > ROWS_PER_RANGE else 0
    rows = rows.withColumn("_range", F.shiftright("_key", 60 - bits))
    totals = rows.groupBy("_src", "_range").agg(F.sum("_size").alias("_sum"), F.max("_size").alias("_last"))
    ahead = Window.partitionBy("_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored(totals.withColumn("_base", F.coalesce(F.sum("_sum").over(ahead), _long(0))), "mix-ranges")
    size = totals.agg(F.sum("_sum")).first()[0] or 0
    block_size = max(block_size, -(-int(size) // max_blocks))
    inside = (Window.partitionBy("_src", "_range").orderBy("_key", "_id", "_size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (rows.withColumn("_before", F.coalesce(F.sum("_size").over(inside), _long(0)))
            .join(totals.select("_src", "_range", "_base"), ["_src", "_range"])
            .withColumn("_start", F.col("_base") + F.col("_before"))
            .withColumn("_block", F.call_function("div", F.col("_start"), _long(block_size))))
    sources = totals.groupBy("_src").agg(F.sum("_sum").alias("size")).select(
        F.col("_src").alias("src"), "size",
        # no document starts beyond the end, at the end only empty ones do
        (F.call_function("div", F.col("size"), _long(block_size)) + 1).alias("blocks"))
    if weights is None:
        sources = sources.withColumn("weight", F.pow(F.col("size") + 1.0, F.lit(temperature)))
    else:
        given = weights.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("src"),
                               F.col("weight").cast("double").alias("weight")).where("weight > 0")
        given = given.groupBy("src").agg(F.max("weight").alias("weight"))
        least = F.coalesce(F.min("weight").over(Window.partitionBy()), F.lit(1.0))
        sources = sources.join(given, "src", "full_outer").withColumn(
            "weight", F.coalesce("weight", least)).where("blocks is not null")
    sources = sources.select("src", "weight", "blocks")
    plan = stored(slots(sources), "mix-plan")
    if plan.count() <= MAX_BROADCAST_BLOCKS:
        plan = F.broadcast(plan)
    rows = rows.join(plan, (F.col("_src") == F.col("src")) & (F.col("_block") == F.col("block")))
    placed = rows.select("_doc.*", F.struct(
        F.substring("_src", 2, 1 << 30).alias("source"), F.col("_block").alias("block"),
        F.col("slot"), F.col("_start").alias("start"), F.col("_key").alias("key")).alias(name))
    return placed, name


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all rows and columns, in the order of the schedule: range
    partitions in ascending order, sorted inside."""
    placed, name = place(docs, **options)
    c = F.col(name)
    return placed.orderBy(c["slot"], c["start"], c["key"], "doc_id").select(*docs.columns)
