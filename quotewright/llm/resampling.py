"""Importance resampling towards a target corpus, over hashed features as inverted postings partitioned by bucket."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import save
from quotewright.llm.ranking import numbered

#: A block of documents, whose postings travel together: at most so many rows and, but for a longer text alone, bytes.
BLOCK_ROWS, BLOCK_BYTES = 30_000, 8 << 20
#: Posting lists of a bucket that meet its totals in one group.
LISTS = 64
#: Bytes of words (ASCII digits and letters in lower case, and all of other characters) stay, other bytes separate words.
_WORDS = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


class _Buckets(dict):
    """feature -> its bucket; emptied when it holds a million."""

    def __init__(self, n: int) -> None:
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.n
        return found


def features(text: str, longest: int) -> tuple[int, list[bytes]]:
    """The number of words of ``text``, and all runs of 1 to ``longest`` of them, each joined by single spaces."""
    words = text.encode().translate(_WORDS).split()
    runs = list(words)
    for n in range(2, longest + 1):
        runs += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len(words), runs


def postings(docs: DataFrame, id_col: str, text_col: str, longest: int, buckets: int) -> DataFrame:
    """Inverted lists: (block, bucket, n, docs, counts), and with a null bucket a block's (ids, words, sizes).

    A block is a run of at most ``BLOCK_ROWS`` rows and about ``BLOCK_BYTES`` of text; ``docs`` are places in it, ``n`` is the sum
    of ``counts``. A bucket has one list for each block at most, which bounds every row and the rows of one block.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def block(name: int, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        own, bucket_of = [features(t, longest) for t in texts], _Buckets(buckets)
        sizes = np.array([len(f) for _, f in own], np.int64)
        found = np.fromiter((bucket_of[x] for _, f in own for x in f), np.int64, int(sizes.sum()))
        keys, counts = np.unique(found * BLOCK_ROWS + np.repeat(np.arange(len(own)), sizes), return_counts=True)
        lists, starts = np.unique(keys // BLOCK_ROWS, return_index=True)
        offsets = pa.array(np.append(starts, len(keys)).astype(np.int32))
        empty, n = [None] * len(lists), len(lists)
        places = pa.ListArray.from_arrays(offsets, pa.array((keys % BLOCK_ROWS).astype(np.int16)))
        repeats = pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))
        total = np.add.reduceat(counts, starts) if n else np.zeros(0, np.int64)
        head = [pa.array([x], t) for x, t in ((None, pa.int32()), (0, pa.int64()), (None, places.type), (None, repeats.type))]
        heads = [pa.array([ids.to_pylist()], pa.list_(ids.type)), *(pa.array([x], pa.list_(pa.int64())) for x in ([w for w, _ in own], sizes.tolist()))]
        columns = [pa.array(np.full(n + 1, name))]
        for above, below in zip(head, (pa.array(lists.astype(np.int32)), pa.array(total.astype(np.int64)), places, repeats)):
            columns.append(pa.concat_arrays([above, below]))
        columns += [pa.concat_arrays([h, pa.array(empty, h.type)]) for h in heads]
        return pa.RecordBatch.from_arrays(columns, ["block", "bucket", "n", "docs", "counts", "ids", "words", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = TaskContext.get().partitionId() << 32
        for b in batches:
            texts, start, size = [t or "" for t in b.column(1).to_pylist()], 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= BLOCK_BYTES or i + 1 - start >= BLOCK_ROWS or i + 1 == len(texts):
                    yield block(name, b.column(0).slice(start, i + 1 - start), texts[start : i + 1])
                    name, start, size = name + 1, i + 1, 0

    rows = docs.select(docs[id_col], docs[text_col].cast("string"))
    lists = f"block long, bucket int, n long, docs array<smallint>, counts array<int>, ids array<{kind}>, words array<long>, sizes array<long>"
    return rows.mapInArrow(run, lists)


def gain(t: Column, t_all: int, s: Column, s_all: int, buckets: int) -> Column:
    """A bucket's thousandfold log ratio of its smoothed shares in the target and in the raw corpus, floored."""
    up = (t + 1).cast("double") * F.lit(float(s_all + buckets))
    down = (s + 1).cast("double") * F.lit(float(t_all + buckets))
    return F.floor(1000 * F.log(up / down)).cast("long")


def _sum_by_doc(key: tuple, group: pa.Table) -> pa.Table:
    """The contributions of a block's lists, summed by document."""
    bucket = group.column("bucket").is_null().to_pylist()
    head = group.slice(bucket.index(True), 1).to_pydict()
    ids, words, sizes = group.column("ids").combine_chunks()[bucket.index(True)].values, head["words"][0], np.array(head["sizes"][0], np.int64)
    lists = group.filter(group.column("bucket").is_valid()).combine_chunks()
    total = np.zeros(len(sizes), np.int64)
    if lists.num_rows:
        docs, counts = (lists.column(c).combine_chunks() for c in ("docs", "counts"))
        length = np.diff(docs.offsets.to_numpy())
        worth = counts.flatten().to_numpy().astype(np.int64) * np.repeat(lists.column("gain").to_numpy(), length)
        np.add.at(total, docs.flatten().to_numpy().astype(np.int64), worth)
    weight = np.where(sizes > 0, total // np.maximum(sizes, 1), 0)
    name = np.full(len(sizes), key[0].as_py())
    return pa.table([name, np.arange(len(sizes)), ids, sizes, np.array(words, np.int64), weight], ["block", "place", "id", "n_features", "n_words", "weight"])


def importance_resample(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """(``id_col``, n_features, n_words, weight, score, rank): draws ``percent`` of ``docs`` by their likeness to ``target``.

    Words are runs of ASCII letters and digits, lower-cased, and other characters beyond ASCII. Features are all runs of 1 to
    ``longest`` words, hashed to ``buckets`` (crc32). A bucket's gain compares its shares in the two corpora; a document's weight is the
    floored mean gain of its features. The score adds Gumbel noise, made from ``seed`` and the id, so that the highest
    scores are a draw without replacement, in proportion to the weights' exponentials. Of the N documents with ``least_words`` words or
    more, the floor(``percent`` N / 100) with the highest scores get ranks 1, 2, 3, ...; ties go to the smaller id.

    Null and empty texts have no features: weight 0, never drawn if ``least_words`` is positive. A null id hashes as the empty string and
    sorts first among equal scores; repeated rows are documents of their own. An empty ``target`` has no features; empty ``docs`` give no rows.
    Other columns are left out. Posting lists are shuffled by bucket, hot buckets split by salt, and again by block of documents;
    no task holds more than one block. The driver gets four numbers.
    """
    index = save(postings(docs, id_col, text_col, longest, buckets), "postings")
    lists = index.where("bucket IS NOT NULL")
    raw = lists.groupBy("bucket").agg(F.sum("n").alias("s"))
    wanted = postings(target.select(target[target_text].alias("t"), F.lit(0).alias("i")), "i", "t", longest, buckets)
    wanted = wanted.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("t"))
    totals = save(raw.join(wanted, "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "totals", rows=buckets)
    s_all, t_all = (x or 0 for x in totals.agg(F.sum("s"), F.sum("t")).first())
    salts = max(1, math.ceil(index.where("bucket IS NULL").count() / LISTS))
    cells = totals.where("s > 0").select("bucket", "s", "t", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    met = lists.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")).join(cells.hint("shuffle_hash"), ["bucket", "salt"])
    worth = met.select("block", "bucket", gain(F.col("t"), t_all, F.col("s"), s_all, buckets).alias("gain"), "docs", "counts")
    heads = index.where("bucket IS NULL").select("block", "bucket", "ids", "words", "sizes")
    kind = docs.schema[id_col].dataType.simpleString()
    summed = worth.unionByName(heads, allowMissingColumns=True).groupBy("block").applyInArrow(
        _sum_by_doc, f"block long, place long, id {kind}, n_features long, n_words long, weight long"
    )
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((draw + 0.5) / 4294967296.0))).cast("long")
    scored = save(summed.withColumn("score", F.col("weight") + noise), "scored")
    may = F.col("n_words") >= least_words
    n, n_all = scored.agg(F.count(F.when(may, 1)), F.count("*")).first()
    placed = numbered(scored.withColumn("may", may), [F.desc("may"), F.desc("score"), "id", "block", "place"], n_all)
    rank = F.when(F.col("number") <= percent * n // 100, F.col("number"))
    return placed.select(F.col("id").alias(id_col), "n_features", "n_words", "weight", "score", rank.alias("rank"))
