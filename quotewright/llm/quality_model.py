"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

Tokens are the bytes of a text and one end. The model is trained on all trusted rows of one half; its n-grams with their
counts, discounts, context totals and interpolation weights are Spark tables, made by aggregations and joins, and stay tables.
Texts are dealt into parts; a part sends each distinct n-gram once, to the shard of its hash, with its count in the part's training
rows. The shards' sums are the model's counts. The distinct n-grams of all shards are joined, order by order, with the model's
tables, and each shard answers the parts with the probabilities. A text's perplexity is held against a quantile of the
perplexities of all other trusted rows in its language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import NO_ID, SAVED, chunks, mix, pack, packed_texts, part_bytes, release, save, shards, text_bytes, unpack, unpacked_rows, unused

#: Symbols are bytes, the end of a text, and what stands before it.
END, BEGIN = 256, 257
#: Bits of a symbol in an n-gram's number.
WIDTH = 9
VOCABULARY = 257
CHUNK = 1 << 20


def _grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each token, as a number of ``order`` symbols; tokens of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + order) - 1
    buf = np.full(int(ends[-1]) + 1 if len(ends) else 0, BEGIN, np.uint64)
    inside = np.ones(len(buf), bool)
    inside[ends] = False
    for k in range(order - 1):
        inside[ends - sizes - 1 - k] = False
    real = inside.copy()
    real[ends] = True
    buf[inside], buf[ends] = np.frombuffer(b"".join(texts), np.uint8), END
    key = buf.copy()
    for k in range(1, order):
        key[k:] |= buf[:-k] << np.uint64(WIDTH * k)
    return key[real], sizes + 1


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << WIDTH * order) - 1).cast("long"))


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, WIDTH)


class Model(NamedTuple):
    """``grams`` (k, gram, own): the discounted share of each n-gram of order k in its context; ``contexts`` (k, context,
    weight): how much each context leaves to the order below."""

    grams: DataFrame
    contexts: DataFrame
    order: int


def train(trusted: DataFrame, text_col: str = "text", order: int = 5) -> Model:
    """A model of all rows of ``trusted``; its tables are bounded by their distinct n-grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t.as_py() or "").encode() for t in b.column(0)]
            for _, some in chunks(range(len(texts)), texts, CHUNK):
                key, n = np.unique(_grams(some, order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["gram", "c"])

    counts = trusted.select(F.col(text_col).cast("string")).mapInArrow(count, "gram long, c long")
    return model_of(save(counts.groupBy("gram").agg(F.sum("c").alias("c")), "grams"), order)


def model_of(counts: DataFrame, order: int) -> Model:
    """The model of the n-grams of order ``order`` with these ``counts`` (gram, c > 0)."""
    # lower orders count the distinct symbols to the left
    longer = F.array(*(F.struct(F.lit(k).alias("k"), _suffix(F.col("gram"), k + 1).alias("gram")) for k in range(1, order)))
    kinds = counts.select(F.explode(longer).alias("g")).select("g.*").distinct()
    lower = kinds.select("k", F.expr(f"gram & ((1L << (k * {WIDTH})) - 1)").alias("gram")).groupBy("k", "gram").agg(F.count("*").alias("c"))
    grams = save(counts.select(F.lit(order).alias("k"), "gram", "c").union(lower), "grams")
    few = {(r.k, r.c): r.n for r in grams.where("c < 5").groupBy("k", "c").agg(F.count("*").alias("n")).collect()}  # four an order
    discount = F.lit(0.0)
    for k in range(1, order + 1):
        n = [max(1, few.get((k, i), 0)) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)]
        own = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        discount = F.when(F.col("k") == k, own).otherwise(discount)
    grams = grams.select("k", "gram", "c", _context(F.col("gram")).alias("context"), discount.alias("d"))
    contexts = grams.groupBy("k", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("freed"))
    contexts = save(contexts.withColumn("weight", F.col("freed") / F.col("total")), "contexts")
    grams = grams.join(contexts, ["k", "context"]).select("k", "gram", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"))
    return Model(save(grams, "grams"), contexts.select("k", "context", "weight"), order)


def probabilities(model: Model, wanted: DataFrame) -> DataFrame:
    """``wanted`` (gram, distinct) -> (gram, p): the interpolated probability of the last symbol after the others."""
    levels = {model.order: wanted.select("gram")}
    for k in range(model.order - 1, 0, -1):
        levels[k] = levels[k + 1].select(_suffix(F.col("gram"), k).alias("gram")).distinct()
    lower = None
    for k in range(1, model.order + 1):
        own = model.grams.where(F.col("k") == k).select("gram", "own")
        left = model.contexts.where(F.col("k") == k).select("context", "weight")
        found = levels[k].join(own, "gram", "left").withColumn("context", _context(F.col("gram"))).join(left, "context", "left")
        if lower is None:
            found = found.withColumn("q", F.lit(1 / VOCABULARY))
        else:
            found = found.withColumn("suffix", _suffix(F.col("gram"), k - 1)).join(lower, "suffix")
        p = F.coalesce("own", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("q")
        found = found.select("gram", p.alias("p"))
        lower = found.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
    return found


def _by_shard(key: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct n-grams by shard, then by number, and each one's shard in that order."""
    shard = ((mix(key) >> np.uint64(32)) * np.uint64(n_shards)) >> np.uint64(32)
    by = np.argsort(shard, kind="stable")
    return by, shard[by].astype(np.int64)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, sorted, and the sums of their counts."""
    key, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True)
    return key, np.bincount(at, np.concatenate([np.zeros(0, np.int64), *counts]), len(key)).astype(np.int64)


def _send(order: int, n_shards: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """A part's distinct n-grams and their counts in its training texts, those whose (id, text_hash) ``trained`` has."""

    def run(key: tuple, t: pa.Table, trained: pa.Table) -> pa.Table:
        names = ["shard", "part", "grams"]
        kinds = (pa.int32(), pa.int32(), pa.binary())
        if not t.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        chosen = set(zip(trained.column("id").to_pylist(), trained.column("text_hash").to_pylist()))
        found, own, counts = [], [], []
        for ids, hashes, texts in unpacked_rows(t.column("texts")):
            found += [np.unique(_grams(some, order)[0]) for _, some in chunks(range(len(texts)), texts, CHUNK)]
            training = [text for text, *row in zip(texts, ids.tolist(), hashes.tolist()) if tuple(row) in chosen]
            for _, some in chunks(range(len(training)), training, CHUNK):
                for to, x in zip((own, counts), np.unique(_grams(some, order)[0], return_counts=True)):
                    to.append(x)
        grams = np.unique(np.concatenate(found))
        c = np.zeros(len(grams), np.int64)
        trained_grams, sums = _summed(own, counts)
        c[np.searchsorted(grams, trained_grams)] = sums
        by, shard = _by_shard(grams, n_shards)
        grams, c = grams[by], c[by]
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(grams)]
        part = t.column("part")[0].as_py()
        rows = [(int(shard[a]), part, pack(np.diff(grams[a:b], prepend=np.uint64(0)), c[a:b])) for a, b in zip(cuts, cuts[1:])]
        return pa.table([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    return run


def _union(t: pa.Table) -> pa.Table:
    grams, counts = zip(*(unpack(x.as_py()) for x in t.column("grams")))
    key, c = _summed([np.cumsum(x) for x in grams], list(counts))
    return pa.table([pa.array(np.full(len(key), t.column("shard")[0].as_py(), np.int32)), pa.array(key.view(np.int64)), pa.array(c)], ["shard", "gram", "c"])


def _answer(key: tuple, sent: pa.Table, known: pa.Table) -> pa.Table:
    """To each part the log10 probabilities of the n-grams it sent, in their order; 32 bits are a relative error of 1e-7."""
    grams = known.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, log10 = grams[order], np.log10(known.column("p").to_numpy()[order]).astype(np.float32)
    found = [pack(log10[np.searchsorted(grams, np.cumsum(unpack(x.as_py())[0]))]) for x in sent.column("grams")]
    return pa.table([sent.column("part"), sent.column("shard"), pa.array(found, pa.binary())], ["part", "shard", "log10"])


def _sums(order: int, n_shards: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    names, kinds = ["id", "text_hash", "n_tokens", "log10_prob"], (pa.int64(), pa.int64(), pa.int64(), pa.float64())

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple] = [()]
        if texts.num_rows:
            rows, found = [], []  # found: the distinct n-grams of a chunk, and which of them each token ends
            for ids, hashes, own in unpacked_rows(texts.column("texts")):
                for at, some in chunks(range(len(own)), own, CHUNK):
                    grams, n = _grams(some, order)
                    grams, which = np.unique(grams, return_inverse=True)
                    found.append((grams, which.astype(np.int32)))
                    rows.append((ids[at.start : at.stop], hashes[at.start : at.stop], n))
            grams = np.unique(np.concatenate([g for g, _ in found]))
            grams = grams[_by_shard(grams, n_shards)[0]]
            log10 = np.concatenate([unpack(x.as_py())[0] for x in answers.sort_by("shard").column("log10")]).astype(np.float64)
            by = np.argsort(grams)
            grams, log10 = grams[by], log10[by]
            for k, ((own, which), (ids, hashes, n)) in enumerate(zip(found, rows)):
                sums = np.add.reduceat(log10[np.searchsorted(grams, own)][which], np.cumsum(n) - n)
                rows[k] = (ids, hashes, n, sums)
        columns = [np.concatenate(c) for c in zip(*rows)] or [np.zeros(0)] * 4
        ids = pa.array(columns[0].astype(np.int64), mask=columns[0] == NO_ID)
        return pa.table([ids, *(pa.array(c, k) for c, k in zip(columns[1:], kinds[1:]))], names)

    return run


class Exchange(NamedTuple):
    """``texts`` (part, texts): packed texts; ``sent`` (shard, part, grams): the n-grams of the parts; ``wanted`` (shard, gram, c):
    all distinct ones with their counts in the training rows; ``n``: parts, and shards."""

    texts: DataFrame
    sent: DataFrame
    wanted: DataFrame
    n: int


def exchange(docs: DataFrame, id_col: str, text_col: str, order: int, picked: DataFrame | None = None) -> Exchange:
    """Deals the texts of ``docs`` into parts and their n-grams into shards. The rows whose id ``picked`` (pick) has are training
    rows; only their ids and hashes are joined, so no text moves for it."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = text_bytes(own, "text")
    n = shards(total, part_bytes(total))
    part = F.pmod(F.xxhash64("id", F.xxhash64("text")), F.lit(n))
    texts = packed_texts(own, "id", "text", part, F.xxhash64("text"))
    rows = own.select(part.cast("int").alias("part"), "id", F.xxhash64("text").alias("text_hash"))
    trained = rows.limit(0) if picked is None else rows.join(picked, rows.id == picked.pick, "left_semi")
    sent = texts.groupBy("part").cogroup(trained.groupBy("part")).applyInArrow(_send(order, n), "shard int, part int, grams binary")
    sent = save(sent, "sent")
    return Exchange(texts, sent, save(sent.groupBy("shard").applyInArrow(_union, "shard int, gram long, c long"), "wanted"), n)


def scores(model: Model, docs: DataFrame, id_col: str, text_col: str, dealt: Exchange | None = None) -> DataFrame:
    """(id, text_hash, n_tokens, log10_prob): one row per input row, the log10 probability of its whole text."""
    dealt = dealt or exchange(docs, id_col, text_col, model.order)
    known = dealt.wanted.select("shard", "gram").join(probabilities(model, dealt.wanted), "gram")
    answers = dealt.sent.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_answer, "part int, shard int, log10 binary")
    return dealt.texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        _sums(model.order, dealt.n), "id long, text_hash long, n_tokens long, log10_prob double"
    )


def exact_quantile(values: DataFrame, by: list[str], quantile: float) -> DataFrame:
    """``values`` (``by``..., x > 0) -> (``by``..., limit): ``percentile`` of x, interpolated, over all rows.

    Rows are counted in bins a thousandth wide; only those in the bins that hold the two ranks next to the quantile are
    counted by value, so no group's rows gather in one task.
    """
    rows = values.withColumn("bin", F.floor(F.log("x") * 1000))
    bins = save(rows.groupBy(*by, "bin").agg(F.count("*").alias("n")), "bins")
    key, upto = [F.col(c) for c in by], Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = bins.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    ranked = ranked.withColumn("before", F.col("upto") - F.col("n")).withColumn("rank", (F.col("total") - 1) * F.lit(quantile))
    held = save(ranked.where("before <= ceil(rank) AND upto > floor(rank)").select(*by, "bin", "before", "rank"), "bins")
    same = [rows[c].eqNullSafe(held[c]) for c in (*by, "bin")]
    found = rows.join(held, same, "left_semi").groupBy(*by, "bin", "x").agg(F.count("*").alias("n"))  # two bins a group
    found = found.alias("f").join(held.alias("h"), [F.col(f"f.{c}").eqNullSafe(F.col(f"h.{c}")) for c in (*by, "bin")])
    found = found.select(*(F.col(f"f.{c}").alias(c) for c in (*by, "bin")), "x", "n", "before", "rank")
    own = Window.partitionBy(*by, "bin").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("upto", F.col("before") + F.sum("n").over(own))
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("x")))
    ends = found.groupBy(*key).agg(at(F.floor("rank")).alias("lo"), at(F.ceil("rank")).alias("hi"), F.first("rank").alias("rank"))
    return ends.select(*key, (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("rank") - F.floor("rank"))).alias("limit"))


def classify(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    order: int = 5, sample: int | None = None, quantile: float = 0.99,
) -> DataFrame:
    """``docs`` with n_tokens, log10_prob, perplexity, threshold and kept.

    ``trusted`` (``id_col``) names the trusted rows. All of one half, or ``sample`` of it where that is given, train the model, and
    all others in ``docs`` give the thresholds: the ``quantile`` of their perplexities in each language, or in all languages for
    a language without any. Which ones is decided by a hash of the id.

    Null texts are empty; an empty text is an end alone and is judged like any other. A null language is one
    without trusted rows. Rows that repeat an id are judged each. Without trusted rows all are kept. Input
    columns with the names of added ones are replaced.
    """
    names = save(trusted.select(F.col(id_col).cast("long").alias("pick")).distinct(), "trusted")
    half = names.where(F.pmod(F.hash("pick"), F.lit(2)) == 0)
    picked = half if sample is None else save(half.orderBy(F.xxhash64("pick"), "pick").limit(sample), "picked")
    first = len(SAVED)
    dealt = exchange(docs, id_col, text_col, order, picked)
    model = model_of(save(dealt.wanted.where("c > 0").select("gram", "c"), "grams"), order)
    found = scores(model, docs, id_col, text_col, dealt).dropDuplicates(["id", "text_hash"])  # repeated rows have one score
    perplexity = F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens")).alias("perplexity")
    row, text_hash, language, limit, digest = unused(docs, "row", "text_hash", "language", "limit", "digest")
    found = save(found.select(F.col("id").alias(row), F.col("text_hash").alias(text_hash), "n_tokens", "log10_prob", perplexity), "scores")
    del dealt, model
    release(docs.sparkSession, first)
    own = docs.drop(*(c for c in docs.columns if c.lower() in ("n_tokens", "log10_prob", "perplexity", "threshold", "kept")))
    # hashed below the join, so that its exchange carries texts only where they are asked for
    own = own.withColumn(digest, F.xxhash64(F.col(text_col).cast("string")))
    same = F.col(id_col).cast("long").eqNullSafe(found[row]) & (own[digest] == found[text_hash])
    scored = own.join(found, same).drop(row, text_hash, digest)
    others = names.join(picked, "pick", "left_anti")
    held = scored.select(F.col(id_col).cast("long").alias("pick"), F.col(lang_col).alias("lang"), F.col("perplexity").alias("x")).join(others, "pick", "left_semi")
    held = save(held.select("lang", "x"), "perplexities")
    whole = exact_quantile(held.withColumn("any", F.lit(0)), ["any"], quantile).first()
    whole = None if whole is None else whole["limit"]
    limits = exact_quantile(held.where("lang IS NOT NULL"), ["lang"], quantile).select(F.col("lang").alias(language), F.col("limit").alias(limit))
    limits = save(limits, "limits")  # a row per language
    scored = scored.join(limits, F.col(lang_col) == F.col(language), "left")
    scored = scored.withColumn("threshold", F.coalesce(limit, F.lit(whole).cast("double"))).drop(language, limit)
    return scored.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
