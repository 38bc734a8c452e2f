"""Mixing sources to target weights by Pfair scheduling. DataFrame functions only.

Target weights are whole shares of a period of T slots. Block k of a source with share a is released at slot
floor(k T / a) and due by slot ceil((k + 1) T / a); in each slot the released block with the earliest deadline goes.
One resource that is fully used meets all deadlines, so at any slot, however late, each source is less than one block away from
its weight. The schedule of one period, a row of T entries, is computed by a SQL fold; every block finds its slot by
its number among its source's blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import save

SCATTER = 2654435761
#: Types whose values can be hashed in any column.
PLAIN = ("string", "long", "integer", "short", "byte", "double", "float", "boolean", "date", "timestamp")


def scattered(id_: Column) -> Column:
    """A fixed scattering of ids over 32 bits."""
    return F.pmod(F.pmod(F.coalesce(id_.cast("long"), F.lit(0)), F.lit(1 << 31)) * F.lit(SCATTER), F.lit(1 << 32))


def shares(weights: DataFrame, period: int = 1000) -> DataFrame:
    """``weights`` (source, weight > 0) -> (source, share, period): the target weights as whole shares, and their sum.

    Whole numbers that add up to ``period`` at most stay as they are. Others are rounded to the nearest share of ``period``, 1 at
    least, so a longer period keeps them more exactly; it is at least four times the number of sources.
    """
    n, total, fine = weights.agg(F.count("*"), F.sum("weight"), F.every(F.col("weight") == F.floor("weight"))).first()
    slots = max(period, 4 * n)
    share = F.greatest(F.lit(1), F.floor(F.col("weight") * slots / (total or 1) + 0.5))
    out = weights.select("source", (F.col("weight") if fine and total <= period else share).cast("long").alias("share"))
    return out.withColumn("period", F.lit(out.agg(F.sum("share")).first()[0]).cast("long"))


def schedule(shared: DataFrame) -> DataFrame:
    """(source, share, period) -> (source, share, period, k, slot): where each block of one period goes."""
    row = shared.groupBy("period").agg(F.sort_array(F.collect_list(F.struct("source", "share"))).alias("s"))
    due = """transform(s, (x, i) -> IF(a.done[i] < x.share AND (a.done[i] * period) div x.share <= t,
               named_struct('due', ((a.done[i] + 1) * period + x.share - 1) div x.share, 'i', i), NULL))"""
    step = f"""(a, t) -> transform(array(array_min({due}).i), p -> named_struct(
                 'done', transform(a.done, (d, i) -> IF(i = p, d + 1L, d)),
                 'slots', array_append(a.slots, named_struct('i', p, 'k', a.done[p]))))[0]"""
    start = "named_struct('done', transform(s, x -> 0L), 'slots', CAST(array() AS array<struct<i:int,k:bigint>>))"
    slots = F.expr(f"aggregate(sequence(0L, period - 1), {start}, {step}, a -> a.slots)")
    out = row.withColumn("slots", slots).select("period", "s", F.posexplode("slots").alias("slot", "b"))
    own = F.expr("s[b.i]")
    return out.select(own["source"].alias("source"), own["share"].alias("share"), "period", F.col("b.k").alias("k"), F.col("slot").cast("long").alias("slot"))


def mix_sources(
    docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = 4, period: int = 1000, buckets: int | None = None
) -> DataFrame:
    """``docs`` with block, release, deadline (in slots) and slot; reading by slot gives the mix.

    Without ``weights`` (source, weight), which :func:`shares` makes whole, a source weighs the square root of its rows. Blocks are
    ``block`` rows of a source in scattered order of their ids. All rows are scheduled: once a source has run out, its slots stay
    empty and the others keep their proportions. A null source counts as the source named ''; sources missing from ``weights`` or
    with a weight that is not positive are left out; rows with a null id are scattered by their other columns, rows that
    repeat an id are scheduled one by one. Input columns with the names of added ones are replaced.

    A source's rows are numbered in ``buckets`` ranges of the scattered order, by default so many that one holds
    about 100,000 rows at most; the result is the same with any number.
    """
    # names that no table has
    source, m, bucket, nth, before, share, length, k, start, place = (f"__mix_{i}" for i in range(10))
    if buckets is None:
        buckets = 1 << min(24, max(8, math.ceil(math.log2(max(docs.count(), 1) / 100_000))))
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() in PLAIN]
    rows = docs.withColumn(source, F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    rows = rows.withColumn(m, F.when(F.col(id_col).isNull(), F.pmod(F.xxhash64(*others), F.lit(1 << 32))).otherwise(scattered(F.col(id_col))))
    rows = rows.withColumn(bucket, (F.col(m) / F.lit((1 << 32) // buckets)).cast("int"))
    sizes = save(rows.groupBy(source, bucket).agg(F.count("*").alias("n")), "sizes")
    if weights is None:
        weights = sizes.groupBy(F.col(source).alias("source")).agg(F.sqrt(F.sum("n")).alias("weight"))
    slots = schedule(shares(weights.where("weight > 0"), period))
    slots = save(slots.toDF(source, share, length, k, place), "slots")
    past = Window.partitionBy(source).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sizes.select(source, bucket, F.coalesce(F.sum("n").over(past), F.lit(0)).alias(before))
    sums = save(sums.join(slots.select(source, share, length).distinct(), source), "before")
    own = F.row_number().over(Window.partitionBy(source, bucket).orderBy(m, id_col))
    out = rows.withColumn(nth, own).join(sums, [source, bucket])
    out = out.withColumn("block", ((F.col(nth) - 1 + F.col(before)) / block).cast("long"))
    out = out.withColumn(k, F.col("block") % F.col(share))
    out = out.withColumn(start, ((F.col("block") - F.col(k)) / F.col(share) * F.col(length)).cast("long"))
    out = out.join(slots.select(source, k, place), [source, k])  # about `period` rows, or four for each source
    out = out.withColumn("release", F.col(start) + F.expr(f"({k} * {length}) div {share}"))
    out = out.withColumn("deadline", F.col(start) + F.expr(f"(({k} + 1) * {length} + {share} - 1) div {share}"))
    out = out.withColumn("slot", F.col(start) + F.col(place))
    return out.drop(source, m, bucket, nth, before, share, length, k, start, place)
