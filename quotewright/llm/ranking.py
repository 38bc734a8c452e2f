"""Places of rows in an order over a whole table, and the highest rows of each group, without gathering rows in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import save

#: Rows of a range.
RANGE = 200_000


def numbered(df: DataFrame, order: list[Column | str], rows: int) -> DataFrame:
    """``df`` (a stored table of about ``rows`` rows) with ``number``, from 1 in ``order``, which should leave no ties.

    Rows go to ranges of the order and are numbered in each; a range starts where the earlier ones' counts end. There is one
    count for each range, so the broadcast holds a row for ``RANGE`` rows.
    """
    sorted_ = df.repartitionByRange(max(1, math.ceil(rows / RANGE)), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = save(sorted_.withColumn("number", place), "ranges")
    part, inside = F.shiftright("number", 33), F.col("number").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("part_", part).withColumn("number", inside + 1)
    ends = placed.groupBy("part_").agg(F.count("*").alias("n_"))
    before = F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ends.select("part_", before.alias("before_"))
    return placed.join(F.broadcast(starts), "part_").withColumn("number", F.col("number") + F.col("before_")).drop("part_", "before_")


#: Rows up to which a table is broadcast; a larger one is joined by a salted shuffle.
SMALL = 100_000
#: Salts of a key where a table is not small.
SALTS = 32


def lookup(df: DataFrame, known: DataFrame, keys: list[str], rows: int, salt: str) -> DataFrame:
    """``df`` with the columns of ``known``, which has one row for a key and ``rows`` rows in all.

    Up to ``SMALL`` rows are broadcast. More are repeated for each of ``SALTS`` salts, which the values of ``salt``
    spread the rows of a hot key over.
    """
    if rows <= SMALL:
        return df.join(F.broadcast(known), keys)
    spread = known.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("salt_", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")).join(spread.hint("merge"), [*keys, "salt_"]).drop("salt_")


#: Rows of a group's open cell that are ordered at once.
CELL = 4096


def top_of_groups(df: DataFrame, keys: list[str], value: str, item: str, k: int, groups: int) -> DataFrame:
    """The ``k`` rows of each group with the highest ``value`` (a long, not negative), ties to the smaller ``item`` (a distinct string).

    Radix selection: a histogram over the value's leading bits, taken in all tasks and added up, shows the cell that holds the
    k-th value; rows above it are in, rows below are out, and the cell's own rows are told apart by its next bits, in the end by
    the items' UTF-8 bytes. As soon as no group's cell has more than ``CELL`` rows these are ordered in a window, at
    most ``k + CELL`` rows a group. All rows are read once, later rounds read the open cells alone.
    """
    # Digits, one a round: the number of significant bits with the six bits behind the leading one, then twelve bits, then four bytes of the item.
    low = f"CAST(greatest(length(bin({value})) - 7, 0) AS INT)"
    rest = F.expr(f"{value} & (shiftleft(1L, {low}) - 1)")
    digits = [F.expr(f"length(bin({value})) * 64L + (shiftright({value}, {low}) & 63)"), *(F.shiftright(rest, n).bitwiseAND(4095) for n in (48, 36, 24, 12, 0))]
    open_, sure, level = df.withColumn("hex_", F.hex(F.col(item).cast("binary"))).withColumn("need_", F.lit(k).cast("long")), None, 0
    while True:
        if level < len(digits):
            cell, order = digits[level].cast("long"), F.desc("cell_")
        else:
            cell, order = F.substring("hex_", (level - len(digits)) * 8 + 1, 8), F.asc("cell_")
        open_ = open_.withColumn("cell_", cell)
        sizes = open_.groupBy(*keys, "cell_").agg(F.count("*").alias("size_"), F.max("need_").alias("need_"))
        upto = F.sum("size_").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cut = sizes.withColumn("upto_", upto).where(F.col("upto_") - F.col("size_") < F.col("need_"))
        last = cut.groupBy(*keys).agg(F.max(F.struct("upto_", "cell_", "size_", "need_")).alias("c"))
        last = save(last.select(*keys, F.col("c.cell_").alias("at_"), F.col("c.size_").alias("size_"), (F.col("c.need_") - F.col("c.upto_") + F.col("c.size_")).alias("left_")), "cells")
        met = lookup(open_, last, keys, groups, item)
        above = met["cell_"] > met["at_"] if level < len(digits) else met["cell_"] < met["at_"]
        whole = (F.col("size_") <= F.col("left_")) & (met["cell_"] == met["at_"])
        taken = met.where(above | whole).select(*df.columns)
        sure = taken if sure is None else sure.unionByName(taken)
        inside = met.where((met["cell_"] == met["at_"]) & ~(F.col("size_") <= F.col("left_")))
        largest = last.where("size_ > left_").agg(F.max("size_")).first()[0] or 0
        inside = inside.select(*df.columns, "hex_", F.col("left_").alias("need_"))
        if largest <= CELL:
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), item))
            return sure.unionByName(inside.withColumn("place_", place).where("place_ <= need_").select(*df.columns))
        open_, level = save(inside, "cell"), level + 1
