"""Language-model scoring by deleted interpolation.

Trigram, bigram, unigram and uniform estimates are mixed with weights that depend on how often the context was seen. The
weights come from expectation-maximisation on the counts of a held-out fold of the training texts: its own counts are taken out of
the totals (deleted), so what is mixed there is what the other folds know. Scores use the counts of all training texts.

Texts are dealt into parts; a part sends each distinct word, bigram and trigram once, with its count, to the shard of its hash;
the shard adds up and answers each part with the totals. A common n-gram thus moves once for each part, however many rows
it is in.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import NO_ID, chunks, mix, pack, packed_texts, part_bytes, save, shards, text_bytes, unpack, unpacked_texts, word_stream

END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
CHUNK = 1 << 20
#: Of this many training parts one is the held-out fold, the first at least.
FOLDS = 8
#: Logarithmic steps to a factor of two in which a held-out token's estimates are kept for the estimation.
STEPS = 4
NONE = 255
#: Context-frequency buckets: of contexts of one word from 0 on, of two words from 32 on.
BUCKETS, PAIRS = 64, 32


def _tokens(blobs: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids; tokens (each text's word hashes, then END); each token's context; tokens of each text."""
    ids, streams, sizes = [], [], []
    for own, texts in unpacked_texts(blobs):
        for some, bytes_ in chunks(own, [t.lower() for t in texts], CHUNK):
            words, n = word_stream(bytes_)
            ends = np.cumsum(n + 1) - 1
            stream = np.full(len(words) + len(n), END, np.uint64)
            inner = np.ones(len(stream), bool)
            inner[ends] = False
            stream[inner] = words
            ids.append(some)
            streams.append(stream)
            sizes.append(n + 1)
    ids, tokens, sizes = np.concatenate(ids), np.concatenate(streams), np.concatenate(sizes)
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = BEGIN
    return ids, tokens, context, sizes


def _streams(tokens: np.ndarray, context: np.ndarray) -> list[np.ndarray]:
    """Hashes of each token, of it after its context, and of it after the two before; the beginning counts as one word."""
    pair = mix(context * np.uint64(0x9E3779B97F4A7C15) ^ tokens)
    history = np.empty_like(pair)
    history[1:] = pair[:-1]
    history[context == BEGIN] = BEGIN
    return [tokens, pair, mix(history * np.uint64(0xC2B2AE3D27D4EB4F) ^ tokens)]


def _cuts(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shards with entries, and where each one's begin: shards are ranges of sorted hashes."""
    own = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1)) if len(own) else np.array([], np.int64)
    return own[starts].astype(np.int64), np.concatenate((starts, [len(own)]))


def _table(rows: list[tuple], names: list[str], kinds: tuple) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _count(n_shards: int, train_parts: int) -> Callable[[pa.Table], pa.Table]:
    def run(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        _, tokens, context, _ = _tokens(t.column("texts"))
        trained = part < train_parts
        rows: list[tuple] = []
        for kind, stream in enumerate(_streams(tokens, context)):
            hashes, counts = np.unique(stream, return_counts=True)
            names, cuts = _cuts(hashes, n_shards)
            for k, shard in enumerate(names.tolist()):
                a, b = cuts[k], cuts[k + 1]
                delta = np.diff(hashes[a:b], prepend=np.uint64(0))
                rows.append((shard, part, kind, pack(delta, (counts[a:b] * trained).astype(np.uint32))))
        return _table(rows, ["shard", "part", "kind", "grams"], (pa.int32(), pa.int32(), pa.int32(), pa.binary()))

    return run


def _in_fold(part: int, train_parts: int) -> bool:
    return part < train_parts and part % FOLDS == 0


def _answer(train_parts: int) -> Callable[[pa.Table], pa.Table]:
    """Totals of each part's n-grams, for parts of the fold with the fold's own; tokens and distinct words, in all and beside the fold."""

    def run(t: pa.Table) -> pa.Table:
        rows = []
        shard = t.column("shard")[0].as_py()
        for kind in range(3):
            own = t.filter(pc.equal(t.column("kind"), kind))
            if not own.num_rows:
                continue
            parts = own.column("part").to_pylist()
            arrays = [unpack(x.as_py()) for x in own.column("grams")]
            hashes, at = np.unique(np.concatenate([np.cumsum(d) for d, _ in arrays]), return_inverse=True)
            counts = np.concatenate([c for _, c in arrays])
            totals = np.bincount(at, counts, len(hashes)).astype(np.uint64)
            inside = np.concatenate([np.full(len(c), _in_fold(p, train_parts)) for p, (_, c) in zip(parts, arrays)])
            fold = np.bincount(at[inside], counts[inside], len(hashes)).astype(np.uint64)
            cuts = np.cumsum([len(c) for _, c in arrays])[:-1]
            for part, mine in zip(parts, np.split(at, cuts)):
                sent = (totals[mine], fold[mine]) if _in_fold(part, train_parts) else (totals[mine],)
                rows.append((part, kind, shard, pack(*sent), 0, 0, 0, 0))
            if kind == 0:
                rest = totals - fold
                rows.append((-1, kind, shard, b"", int(totals.sum()), int((totals > 0).sum()), int(rest.sum()), int((rest > 0).sum())))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 4)
        return _table(rows, ["part", "kind", "shard", "totals", "n", "v", "rest_n", "rest_v"], kinds)

    return run


def _known(texts: pa.Table, answers: pa.Table, deleted: bool):
    """Per token of a part: counts of the word, the bigram, the trigram and of the contexts of both; without the fold's own
    where ``deleted``."""
    ids, tokens, context, sizes = _tokens(texts.column("texts"))
    found, first = [], context == BEGIN
    for kind, stream in enumerate(_streams(tokens, context)):
        own = answers.filter(pc.equal(answers.column("kind"), kind)).sort_by("shard")
        sent = [unpack(x.as_py()) for x in own.column("totals")]
        totals = np.concatenate([x[0] - x[1] if deleted else x[0] for x in sent])
        hashes, at = np.unique(stream, return_inverse=True)
        found.append(totals[at].astype(np.float64))
        if kind == 0:
            ends = float(totals[np.searchsorted(hashes, END)])
    seen = []
    for counts in found[:2]:  # a word or pair is a context as often as it occurs, the beginning as often as the end
        before = np.empty_like(counts)
        before[1:] = counts[:-1]
        before[first] = ends
        seen.append(before)
    return ids, sizes, *found, *seen


def bucket(seen: np.ndarray, seen_pair: np.ndarray) -> np.ndarray:
    """The frequency bucket of a context: by its two words where they were seen together, else by the last one."""
    one = np.minimum(np.floor(np.log2(seen + 1)), PAIRS - 1)
    two = PAIRS + np.minimum(np.floor(np.log2(np.maximum(seen_pair, 1))), PAIRS - 1)
    return np.where(seen_pair > 0, two, one).astype(np.int64)


def _estimates(n: int, word: np.ndarray, pair: np.ndarray, triple: np.ndarray, seen: np.ndarray, seen_pair: np.ndarray) -> list[np.ndarray]:
    """Maximum-likelihood estimates of a token after two words, after one, and by itself; 0 where the context is new."""
    ratio = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    return [ratio(triple, seen_pair), ratio(pair, seen), word / max(n, 1)]


def _cells(n: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """(bucket, cell, n): how many tokens of a part of the fold have which estimates, in steps, by the other folds' counts."""

    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        names, kinds = ["bucket", "cell", "n"], (pa.int64(),) * 3
        if not texts.num_rows:
            return _table([], names, kinds)
        _, _, word, pair, triple, seen, seen_pair = _known(texts, answers, deleted=True)
        steps = [
            np.where(p > 0, np.minimum(np.rint(-STEPS * np.log2(np.where(p > 0, p, 1))), NONE - 1), NONE).astype(np.int64)
            for p in _estimates(n, word, pair, triple, seen, seen_pair)
        ]
        own = bucket(seen, seen_pair)
        cell = reduce(lambda a, b: (a << 8) + b, [own, *steps])
        cells, counts = np.unique(cell, return_counts=True)
        return pa.table([pa.array(x) for x in (cells >> 24, cells & 0xFFFFFF, counts)], names)

    return run


def mixture(p: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """EM: the weights of the columns of ``p`` that make the rows, seen ``n`` times each, likeliest."""
    w = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        share = p * w
        share *= (n / share.sum(1))[:, None]
        new = np.maximum(share.sum(0) / n.sum(), 1e-9)
        new /= new.sum()
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def cell_estimates(cell: np.ndarray, v: int) -> np.ndarray:
    """The trigram, bigram, unigram and uniform estimates of each cell."""
    steps = [(cell >> k) & 0xFF for k in (16, 8, 0)]
    return np.stack([*(np.where(q == NONE, 0, np.exp2(-q / STEPS)) for q in steps), np.full(len(cell), 1 / (v + 1))], 1)


def _weights(v: int) -> Callable[[pa.Table], pa.Table]:
    """(bucket, w): the mixture of one bucket, from its cells, of which there are at most 256 to the third."""

    def run(t: pa.Table) -> pa.Table:
        cell, n = (t.column(c).to_numpy() for c in ("cell", "n"))
        w = mixture(cell_estimates(cell, v), n)
        return _table([(t.column("bucket")[0].as_py(), w.tolist())], ["bucket", "w"], (pa.int64(), pa.list_(pa.float64())))

    return run


def all_weights(found: dict[int, list[float]]) -> np.ndarray:
    """weights[bucket]; a bucket that the fold never reaches takes those of the next lower one of its kind that it reaches."""
    weights = np.zeros((BUCKETS, 4))
    for first, last in ((0, [0.0, 0.0, 0.9, 0.1]), (PAIRS, [0.0, 0.0, 0.9, 0.1])):
        for b in range(first, first + PAIRS):
            last = weights[b] = found.get(b, last)
    return weights


def _scores(n: int, v: int, weights: np.ndarray, id_col: str) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        names = [id_col, "n_tokens", "n_known", "base_score", "score"]
        if not texts.num_rows:
            return _table([], names, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))
        ids, sizes, word, pair, triple, seen, seen_pair = _known(texts, answers, deleted=False)
        w = weights[bucket(seen, seen_pair)]
        p = w[:, 3] / (v + 1)
        for k, own in enumerate(_estimates(n, word, pair, triple, seen, seen_pair)):
            p += w[:, k] * own
        at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        add = lambda x: np.add.reduceat(x, at)
        found = (sizes, add((word > 0).astype(np.int64)), add(np.log10((word + 1) / (n + v + 1))), add(np.log10(p)))
        return pa.table([pa.array(ids, mask=ids == NO_ID), *map(pa.array, found)], names)

    return run


def interpolated_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_tokens, n_known, train_tokens, base_score and score (log10 probability of the text).

    Tokens are a text's words, A-Z in lower case, and one end. Texts for which ``held_out`` is not true give the counts and, one
    fold of them, the mixture weights; the others are only scored. Null texts are empty; rows that repeat an id, or have
    none, count and are scored each. Without training texts all counts are 0. Other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    total = text_bytes(own, "text")
    n_parts = shards(total, part_bytes(total))
    held_parts = max(1, n_parts // 6)
    hashed = F.xxhash64(id_col, "text")
    dealt = F.pmod(hashed, F.lit(n_parts)).cast("int")
    part = F.when(F.col("held"), n_parts + F.pmod(hashed, F.lit(held_parts))).otherwise(dealt)
    texts = packed_texts(own, id_col, "text", part)
    counted = texts.groupBy("part").applyInArrow(_count(n_parts, n_parts), "shard int, part int, kind int, grams binary")
    answered = "part int, kind int, shard int, totals binary, n long, v long, rest_n long, rest_v long"
    answers = save(counted.groupBy("shard").applyInArrow(_answer(n_parts), answered), "totals")
    sums = answers.where("part = -1").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v", "rest_n", "rest_v"))).first()
    n, v, rest_n, rest_v = sums
    given = answers.select("part", "kind", "shard", "totals")
    in_fold = f"part >= 0 AND part < {n_parts} AND part % {FOLDS} = 0"
    fold = packed_texts(own.where(~F.col("held") & (dealt % FOLDS == 0)), id_col, "text", part)
    cells = fold.groupBy("part").cogroup(given.where(in_fold).groupBy("part")).applyInArrow(_cells(rest_n), "bucket long, cell long, n long")
    cells = cells.groupBy("bucket", "cell").agg(F.sum("n").alias("n"))
    found = cells.groupBy("bucket").applyInArrow(_weights(rest_v), "bucket long, w array<double>").collect()  # 64 rows at most
    weights = all_weights({r.bucket: r.w for r in found})
    scored = texts.groupBy("part").cogroup(given.where("part >= 0").groupBy("part")).applyInArrow(
        _scores(n, v, weights, id_col), f"`{id_col}` long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))
