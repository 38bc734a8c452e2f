"""How the sources of a language differ in their terms: divergences of all pairs of sources, and each source's outstanding terms."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import save
from quotewright.llm.ranking import lookup, top_of_groups

#: Shares are counted in parts of this number.
UNIT = 1_000_000_000
#: A map task hands its counts on when it holds so many (source, term) pairs.
HELD = 2_000_000
#: Sources of a tile and rows of a block of terms, about: what one task compares.
TILE, BLOCK = 48, 200_000
#: Bytes of terms (ASCII letters in lower case, and all of other characters) stay, other bytes separate terms.
_TERMS = bytes(b if 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


class _Numbers(dict):
    """key -> its number, in the order in which keys are first asked for."""

    def __missing__(self, key: bytes) -> int:
        found = self[key] = len(self)
        return found


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, term, docs, sources array<struct<source, n>>): counted in each map task, one row for a term and language.

    ``docs`` is the number of the task's documents with the term. So no key has more rows than there are tasks' portions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        ids = _Numbers()
        groups: dict[tuple[str, str], int] = {}

        def counted() -> pa.RecordBatch:
            """The held (language, term, source) counts as rows."""
            langs = sorted({lang for lang, _ in groups})
            names, terms = list(groups), pa.array(list(ids), pa.binary()).cast(pa.string())
            lang_of = np.array([langs.index(lang) for lang, _ in names], np.int64)
            group, term, n, n_docs = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((group, term, lang_of[group]))
            group, term, n, n_docs = group[order], term[order], n[order], n_docs[order]
            new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (lang_of[group[1:]] != lang_of[group[:-1]]) | (group[1:] != group[:-1])))
            group, term, n, n_docs = group[new], term[new], np.add.reduceat(n, new), np.add.reduceat(n_docs, new)
            row = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (lang_of[group[1:]] != lang_of[group[:-1]])))
            sources = pa.array([s for _, s in names], pa.string()).take(pa.array(group))
            pairs = pa.StructArray.from_arrays([sources, pa.array(n)], ["source", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(row, len(group)).astype(np.int32)), pairs)
            lang = pa.array(langs, pa.string()).take(pa.array(lang_of[group[row]]))
            return pa.RecordBatch.from_arrays([lang, terms.take(pa.array(term[row])), pa.array(np.add.reduceat(n_docs, row)), lists], ["lang", "term", "docs", "sources"])

        for b in batches:
            texts, langs, sources = ([x or "" for x in b.column(i).to_pylist()] for i in range(3))
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 4 << 20):
                    size += len(texts[end])
                    end += 1
                words = [t.encode().translate(_TERMS).split() for t in texts[at:end]]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                term = np.fromiter(map(ids.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
                pair, n = np.unique(np.repeat(np.arange(len(words)), sizes) << 40 | term, return_counts=True)
                group = np.array([groups.setdefault(k, len(groups)) for k in zip(langs[at:end], sources[at:end])], np.int64)[pair >> 40]
                key = group << 40 | (pair & ((1 << 40) - 1))
                order = np.argsort(key, kind="stable")
                key, n = key[order], n[order]
                if len(key):
                    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                    held.append((key[new] >> 40, key[new] & ((1 << 40) - 1), np.add.reduceat(n, new), np.diff(np.append(new, len(key)))))
                at = end
                if sum(len(h[0]) for h in held) >= HELD:
                    yield counted()
                    held, ids, groups = [], _Numbers(), {}
        if held:
            yield counted()

    rows = docs.select(docs[text_col].cast("string"), docs[lang_col].cast("string"), docs[source_col].cast("string"))
    return rows.mapInArrow(run, "lang string, term string, docs long, sources array<struct<source: string, n: long>>")


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + v)), exact: a product that a long can't hold is a decimal."""
    exact = F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + v).cast("decimal(20,0)"))
    return F.when(n < (1 << 63) // UNIT - 1, F.call_function("div", (n + 1) * UNIT, total + v)).otherwise(exact) + 1


def _divergence(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q) of shares; a square is at most UNIT**2, which a long holds."""
    return F.call_function("div", (p - q) * (p - q), q).cast("long")


def _corrections(key: tuple, group: pa.Table) -> pa.Table:
    """What a block of terms adds to the divergences of two tiles' sources beyond terms that neither source has.

    With f(p, q) for a term in both sources, f(p, q0) or f(p0, q) for one in one of them, each less f(p0, q0); p0 and
    q0 are the shares of a term that is not there. Terms in one source count by their shares' histogram.
    """
    lang, _, left, right = (k.as_py() for k in key)
    own = group.column("tile").to_numpy()
    codes = group.column("term").combine_chunks().dictionary_encode().indices
    term = np.where(group.column("term").is_null().to_numpy(), -1, codes.fill_null(-1).to_numpy().astype(np.int64))
    names = group.column("source").combine_chunks().dictionary_encode()
    source, p, p0 = names.indices.to_numpy().astype(np.int64), group.column("p").to_numpy(), group.column("base").to_numpy()

    def f(x, y):
        return (x - y) ** 2 // y

    def of(tile: int) -> dict[int, tuple]:
        """source -> (its base, its terms in order, their shares, the distinct shares, how often each)."""
        out = {}
        for s in np.unique(source[own == tile]).tolist():
            mine = (own == tile) & (source == s)
            base, has = p0[mine][0], mine & (term >= 0)
            order = np.argsort(term[has])
            out[s] = (base, term[has][order], p[has][order], *np.unique(p[has], return_counts=True))
        return out

    rows: tuple[list, list, list] = ([], [], [])
    one, two = of(left), of(right)
    for a, (a0, a_terms, a_p, a_kinds, a_times) in one.items():
        for b, (b0, b_terms, b_p, b_kinds, b_times) in two.items():
            if a == b:
                continue
            _, i, j = np.intersect1d(a_terms, b_terms, assume_unique=True, return_indices=True)
            for x, y, x0, y0, xs, ys in ((a, b, a0, b0, a_p[i], b_p[j]),) if left == right else ((a, b, a0, b0, a_p[i], b_p[j]), (b, a, b0, a0, b_p[j], a_p[i])):
                x_kinds, x_times, y_kinds, y_times = (a_kinds, a_times, b_kinds, b_times) if x == a else (b_kinds, b_times, a_kinds, a_times)
                none = f(x0, y0)
                total = ((f(x_kinds, y0) - none) * x_times).sum() + ((f(x0, y_kinds) - none) * y_times).sum()
                total += (f(xs, ys) - f(xs, y0) - f(x0, ys) + none).sum()
                if total:
                    rows[0].append(x)
                    rows[1].append(y)
                    rows[2].append(int(total))
    what = names.dictionary
    return pa.table([pa.array([lang] * len(rows[0]), pa.string()), *(what.take(pa.array(r, pa.int64())) for r in rows[:2]), pa.array(rows[2], pa.int64())], ["lang", "source", "item", "part_sum"])


def pair_divergences(counts: DataFrame, groups: DataFrame, rows: int, sources: int) -> DataFrame:
    """(lang, source, item, value): for all ordered pairs of a language's sources, summed over all kept terms.

    ``counts`` has (lang, source, term, p, base) of the terms that a source has, ``rows`` in all; ``groups`` (lang, source, v, base).
    Terms are cut into blocks and sources into tiles; a task sees one block of two tiles and adds up before it emits.
    """
    tiles, blocks = max(1, math.ceil(sources / TILE)), max(1, math.ceil(rows / BLOCK))
    tile = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    entries = counts.select("lang", "source", "term", "p", "base", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"))
    marks = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"), "base", all_blocks.alias("block"))
    both = entries.unionByName(marks).withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    placed = both.withColumn("left", F.least("tile", "other")).withColumn("right", F.greatest("tile", "other"))
    sums = placed.groupBy("lang", "block", "left", "right").applyInArrow(_corrections, "lang string, source string, item string, part_sum long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("part_sum").alias("more"))
    mine = groups.select("lang", "source", "v", "base")
    pairs = mine.join(groups.select("lang", F.col("source").alias("item"), F.col("base").alias("other_base")), "lang").where("source <> item")
    value = F.col("v") * _divergence(F.col("base"), F.col("other_base")) + F.coalesce("more", F.lit(0))
    return pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", value.alias("value"))


def source_divergence(
    docs: DataFrame, least_docs: int = 3, top: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each (language, source) group differs from the language's other sources and from it all.

    Terms are runs of ASCII letters, lower-cased, and of characters beyond ASCII; a language keeps those in ``least_docs`` or
    more of its documents. Shares are smoothed by one and counted in billionths, all arithmetic is exact. Part ``pair`` has every other source of
    the language, its value is the sum over kept terms of floor((p - q)**2 / q), p the group's share, q the other's. Part ``term`` has
    the terms with a larger share in the group than in the language, by the same measure, the ``top`` highest of each group. Ranks go by
    value, then by the item's UTF-8 bytes.

    Null texts, languages and sources are read as the empty string. Repeated rows are documents of their own. A group or
    language without kept terms has pairs of value 0 and no terms; empty tables give no rows; other columns are left out. A very long
    text is counted like any other. Nothing is collected; what is broadcast is counted first (``ranking.lookup``).
    """
    own = Window.partitionBy("lang", "term")
    found = term_counts(docs, text_col, lang_col, source_col).withColumn("docs", F.sum("docs").over(own))
    rows = found.where(F.col("docs") >= least_docs).select("lang", "term", F.inline("sources"))
    counts = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    counts = save(counts.withColumn("all_n", F.sum("n").over(own)), "counts")

    none = F.lit(0).cast("long")
    present = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"), F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("source")).distinct()
    of_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = counts.groupBy("lang", "term").agg(F.max("all_n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    groups = present.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, none).alias(c) for c in ("total", "v", "lang_total")))
    groups = save(groups.withColumn("base", F.when(F.col("v") > 0, _share(none, F.col("total"), F.col("v"))).otherwise(1)), "groups", rows=1)
    n_rows, n_groups, n_sources = counts.count(), groups.count(), groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0

    shares = lookup(counts, groups, ["lang", "source"], n_groups, salt="term")
    p, q = _share(F.col("n"), F.col("total"), F.col("v")), _share(F.col("all_n"), F.col("lang_total"), F.col("v"))
    shares = save(shares.select("lang", "source", "term", "base", p.alias("p"), q.alias("q")), "shares")
    pairs = pair_divergences(shares.select("lang", "source", "term", "p", "base"), groups, n_rows, n_sources)
    outstanding = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), _divergence(F.col("p"), F.col("q")).alias("value"))
    best = top_of_groups(outstanding, ["lang", "source"], "value", "item", top, n_groups)
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    both = pairs.withColumn("part", F.lit("pair")).unionByName(best.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"))
