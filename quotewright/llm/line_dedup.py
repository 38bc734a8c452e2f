"""Removal of lines that spread over many sites: sketches first, exact counts near the threshold.

DataFrame functions only. Per line hash, HyperLogLog sketches of the sites are made in each task and merged by the
aggregation, so a common line moves once for each task, as a few kilobytes at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import SAVED, SPACE, release, save

KEY = ["k1", "k2"]


def _key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("k1"), F.hash(line).alias("k2")]


def spread_lines(lines: DataFrame, least_sites: int, precision: int = 12) -> DataFrame:
    """``lines`` (k1, k2, site) -> (k1, k2) of the lines on ``least_sites`` distinct sites or more.

    Estimates within four standard errors of the threshold, or within one site, are counted exactly. Null sites don't count.
    """
    near = max(1, math.ceil(4 * 1.04 / math.sqrt(1 << precision) * least_sites))
    sketches = lines.where("site IS NOT NULL").groupBy(*KEY).agg(F.hll_sketch_agg("site", F.lit(precision)).alias("s"))
    found = sketches.select(*KEY, F.hll_sketch_estimate("s").alias("sites"))
    found = save(found.where(F.col("sites") >= least_sites - near), "spread")
    unsure = found.where(F.col("sites") <= least_sites + near).select(*KEY)
    exact = lines.where("site IS NOT NULL").join(unsure, KEY, "left_semi").select(*KEY, "site").distinct()
    exact = exact.groupBy(*KEY).agg(F.count("*").alias("sites")).where(F.col("sites") >= least_sites)
    return found.where(F.col("sites") > least_sites + near).select(*KEY).union(exact.select(*KEY))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, bands: int = 10, rows: int = 4) -> DataFrame:
    """(``id_col``, text_hash) of the rows of ``docs`` that have a near copy there, another row as similar over ``words``-word shingles.

    Rows that agree in one of ``bands`` groups of ``rows`` minimum hashes are compared with one of them, shingle by shingle; so a row
    of this similarity is found with a chance of 0.99, and a family costs a few rows per member. Repeated rows are one.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.lower(text_col).alias("t"))
    own = own.withColumn("w", F.filter(F.split("t", SPACE), lambda w: w != "")).drop("t")
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - words + 1)), lambda i: F.xxhash64(F.slice("w", i, words)))
    own = own.select("id", "text_hash", F.array_distinct(shingles).alias("s"))
    own = save(own.withColumn("row", F.xxhash64("id", "text_hash")).dropDuplicates(["row"]), "shingles")
    least = F.array(*(F.array_min(F.transform("s", lambda h, k=k: F.xxhash64(h, F.lit(k)))) for k in range(bands * rows)))
    signed = own.select("row", least.alias("m"))
    keys = F.array(*(F.xxhash64(F.lit(b), F.slice("m", b * rows + 1, rows)) for b in range(bands)))
    keyed = save(signed.select("row", F.explode(keys).alias("key")), "bands")
    hubs = keyed.groupBy("key").agg(F.min("row").alias("hub"), F.max("row").alias("last")).where("hub < last").select("key", "hub")
    pairs = keyed.join(hubs, "key").where("row <> hub").select("row", "hub").distinct()
    both = pairs.join(own.select("row", F.col("s").alias("a")), "row").join(own.select(F.col("row").alias("hub"), F.col("s").alias("b")), "hub")
    shared = F.size(F.array_intersect("a", "b"))
    met = save(both.where(shared >= similarity * (F.size("a") + F.size("b") - shared)).select("row", "hub"), "met")
    met = met.select("row").union(met.select("hub")).distinct()
    return own.join(met, "row").select(F.col("id").alias(id_col), "text_hash")


def drop_spread_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", least_sites: int = 8, salts: int = 16,
    copies: Callable[[DataFrame], DataFrame] | None = None, most_lost: float = 0.5,
) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, and n_lines, n_removed.

    Lines are what \\n separates; they are compared without white space at their ends, by hashes of 96 bits. Blank
    lines stay; every line on ``least_sites`` sites goes, though nothing be left.

    A pipeline that drops copies of documents later passes ``copies``, which is asked about the texts (``id_col``, ``text_col``)
    that would lose more than ``most_lost`` of their characters: those it returns (``id_col``, text_hash), as :func:`near_copies`
    does, and texts of nothing but spread lines stay whole. Null texts stay null and have no lines, null sites don't count, rows that repeat an id, or have none, are told
    apart by their texts. Other columns stay, but input columns named n_lines or n_removed are replaced.
    """
    first = len(SAVED)
    id_, digest, hit, kept, own_length, lost = (f"__line_{i}" for i in range(6))  # names that no table has
    line = F.regexp_replace(F.col("line"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    named = {id_: F.col(id_col), digest: F.xxhash64(text_col)}
    lines = docs.select(*(c.alias(n) for n, c in named.items()), F.length(text_col).alias(own_length), F.col(site_col).alias("site"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    lines = lines.withColumn(lost, F.length("line") + 1).withColumn("line", line).where("line <> ''").select(id_, digest, own_length, lost, "site", "pos", *_key(F.col("line")))
    spread = save(spread_lines(lines, least_sites), "lines")
    # a line may be in any share of all documents: its rows are dealt to `salts` keys
    salted = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")  # no broadcast: Spark sizes it as before explode
    hits = lines.withColumn("salt", F.pmod(F.xxhash64(id_, "pos"), F.lit(salts)).cast("int")).join(salted, [*KEY, "salt"], "left_semi")
    hits = hits.select(id_, digest, own_length, lost, "pos").distinct().groupBy(id_, digest)
    hits = hits.agg(F.collect_list("pos").alias(hit), F.max(own_length).alias(own_length), F.sum(lost).alias(lost))
    if copies is not None:
        hits = save(hits, "hits")  # read twice
        release(docs.sparkSession, first)
        first, much = len(SAVED), F.greatest(F.col(own_length) - F.col(lost), F.lit(0)) < (1 - most_lost) * F.col(own_length)
        most = hits.where(much).select(F.col(id_).alias("__line_most_id"), F.col(digest).alias("__line_most_text"))
        most = save(most, "most")  # only these texts are asked for
        asked = docs.withColumns(named)
        same = asked[id_].eqNullSafe(most["__line_most_id"]) & (asked[digest] == most["__line_most_text"])
        proven = save(copies(asked.join(most, same, "left_semi").select(id_col, text_col)).distinct(), "copies")
        release(docs.sparkSession, first)
        proven = proven.select(F.col(id_col).alias(id_), F.col("text_hash").alias(digest), F.lit(True).alias("__line_copy")).alias("c")
        same = F.col(f"h.{id_}").eqNullSafe(F.col(f"c.{id_}")) & (F.col(f"h.{digest}") == F.col(f"c.{digest}"))
        hits = hits.withColumn("__line_much", much).alias("h").join(proven, same, "left").select("h.*", "__line_copy").drop(own_length, lost)
    own, hits = docs.withColumns(named), hits.select(F.col(id_).alias("__line_hit_id"), F.col(digest).alias("__line_hit_text"), hit, *(() if copies is None else ("__line_much", "__line_copy")))
    same = own[id_].eqNullSafe(hits["__line_hit_id"]) & (own[digest] == hits["__line_hit_text"])
    out = own.join(hits, same, "left").drop("__line_hit_id", "__line_hit_text")
    split = F.split(text_col, "\n")
    rest = F.array_join(F.filter(split, lambda x, i: ~F.array_contains(hit, i)), "\n")
    out = out.withColumn(kept, F.when(F.col(hit).isNotNull(), rest))
    fits = F.col(hit).isNotNull()
    if copies is not None:
        fits = fits & (~F.col("__line_much") | (F.col("__line_copy").isNull() & F.col(kept).rlike(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("n_lines", F.coalesce(F.size(split), F.lit(0)).cast("long"))
    out = out.withColumn("n_removed", F.when(fits, F.size(hit)).otherwise(0).cast("long"))
    return out.withColumn(text_col, F.when(fits, F.col(kept)).otherwise(F.col(text_col))).drop(id_, digest, hit, kept, "__line_much", "__line_copy")
