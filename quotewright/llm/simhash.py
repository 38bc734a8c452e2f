"""SimHash near-duplicates: pigeonhole blocks, joined and verified by Hamming distance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import SAVED, mix, release, save
from quotewright.llm.components import connected_components
from quotewright.llm.ranking import SMALL

BITS = 64


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each word shingle, repeats included; of the whole sequence where there are fewer words."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    joined, n = b" ".join(found), len(found)
    digest = xxhash.xxh64_intdigest
    if n <= words:
        return np.array([digest(joined, 42)] if n else [], np.uint64)
    sizes = np.fromiter(map(len, found), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: n - words + 1].tolist(), ends[words - 1 :].tolist()
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 without words."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(``id_col``, fp long): one row per input row; null and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], [id_col, "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    return picked.mapInArrow(run, f"`{id_col}` long, fp long")


def _block_keys(fp: Column, distance: int, blocks: int) -> list[Column]:
    """One key for each choice of ``blocks - distance`` blocks: close pairs agree on one of them at least."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for at, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(at).alias("choice"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("bits")))
    return keys


def close_pairs(fps: DataFrame, distance: int = 2, blocks: int = 4, group: int = 64) -> DataFrame:
    """``fps`` (fp long, distinct) -> edges (u, v) that link all fingerprints within ``distance`` bits.

    Groups on a block key of up to ``group`` members are compared pair by pair and verified. The members
    of larger ones are linked without their pairs: those within ``distance`` bits of each other share a
    fingerprint at half that distance from both, so a star over each such shared neighbour (at most
    65 members for distance 2) makes the same components. No key, however common, is left out.
    """
    if distance not in (1, 2):
        raise ValueError("distance must be 1 or 2")
    keyed = fps.select("fp", F.explode(F.array(*_block_keys(F.col("fp"), distance, blocks))).alias("key"))
    sizes = save(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "blocks")
    small = keyed.join(sizes.where(F.col("n") <= group), "key", "left_semi").repartition("key")
    members = small.groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("f"))
    pairs = members.select(
        F.explode(
            F.expr(
                f"""flatten(transform(f, (x, i) -> transform(
                      filter(slice(f, i + 2, {group}), y -> bit_count(x ^ y) <= {distance}),
                      y -> struct(x AS u, y AS v))))"""
            )
        ).alias("e")
    ).select("e.u", "e.v")
    large = keyed.join(sizes.where(F.col("n") > group), "key", "left_semi").select("fp").distinct()
    near = F.expr(f"concat(array(fp), transform(sequence(0, {BITS - 1}), b -> fp ^ shiftleft(1L, b)))")
    shared = large.select("fp", F.explode(near).alias("near")).groupBy("near").agg(F.collect_list("fp").alias("f"))
    stars = shared.where(F.size("f") > 1).select(F.array_min("f").alias("u"), F.explode("f").alias("v")).where(
        f"u <> v AND bit_count(u ^ v) <= {distance}"
    )
    return pairs.union(stars).distinct()


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = 2
) -> DataFrame:
    """(``id_col``, fp long, component_id long): the smallest id that links of ``distance`` bits reach.

    Rows that repeat an id are kept, and so are rows with a null id, which is no component's name: a component without any other
    id has a null one. Null, empty and blank texts have fingerprint 0 and link like any other. Other columns of ``docs`` are not read.
    """
    fps = save(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes, n = save(fps.groupBy("fp").agg(F.min(id_col).alias("first")), "nodes"), fps.count()
    roots = connected_components(close_pairs(nodes.select("fp"), distance))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = save(rooted, "rooted", n)
    least = save(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least", n)
    named = save(rooted.join(least, "root").select("fp", "component_id"), "named", n)
    return fps.join(named, "fp").select(id_col, "fp", "component_id")


#: Sets the words of a wide fingerprint apart; the first is the plain SimHash.
WIDE = (0, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD1342543DE82EF95)


#: What tells a row from others: a null id or not, the id, a hash of the text. Rows that agree in these are one text.
ROW = ["no_id", "id", "text_hash"]


def _row(id_col: str, text_col: str) -> list[Column]:
    own = F.col(id_col).cast("long")
    return [own.isNull().alias("no_id"), own.alias("id"), F.xxhash64(text_col).alias("text_hash")]


class Nodes(NamedTuple):
    """``prints`` (node long, w array<long>, size long, sketch array<long>, row columns): a fingerprint, the number of distinct
    shingles and their sketch for each distinct set of shingles, and a row that has it; ``docs``: where the shingles of candidate pairs come from, ``words`` long."""

    prints: DataFrame
    docs: DataFrame
    id_col: str
    text_col: str
    words: int


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    return np.unique(shingle_hashes(text, words))


#: Ranges of hashes in a sketch; a byte of it stands for the least hash in a range, 0 for none.
RANGES = 512


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set of shingle hashes, eight bytes to a number."""
    out = np.zeros(RANGES, np.uint8)
    at = (hashes >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out[at[first]] = 1 + (mix(hashes[first]) % np.uint64(255)).astype(np.uint8)
    return out.view(np.int64)


def sketch_similarity(a: str, b: str) -> Column:
    """The share of ranges in which two sketches agree, of those in which one has a shingle: an estimate of the similarity."""
    full = lambda x: f"({x} | (shiftrightunsigned({x}, 4) & {0x0F0F0F0F0F0F0F0F}))"
    pair = lambda x: f"({x} | (shiftrightunsigned({x}, 2) & {0x3333333333333333}))"
    last = lambda x: f"bit_count(({x} | shiftrightunsigned({x}, 1)) & {0x0101010101010101})"
    bytes_in = lambda e: f"aggregate(transform(transform(zip_with({a}, {b}, (x, y) -> {e}), z -> {full('z')}), z -> {pair('z')}), 0, (s, z) -> s + {last('z')})"
    either = F.expr(bytes_in("x | y"))
    return F.when(either == 0, 1.0).otherwise((either - F.expr(bytes_in("x ^ y"))) / either)


def wide_fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(``ROW``, w array<long>, size long, sketch array<long>, digest binary): a SimHash of 256 bits of the set of shingles, four
    words from four hashes of each; how many shingles there are, their sketch, and a hash of 128 bits of them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, sizes, digests = np.zeros((b.num_rows, len(WIDE)), np.uint64), [], []
            sketches = np.zeros((b.num_rows, RANGES // 8), np.int64)
            for i, t in enumerate(b.column(3)):
                h = shingle_set(t.as_py(), words)
                rows[i] = [majority(mix(h ^ np.uint64(c)) if c else h) for c in WIDE]
                sketches[i] = sketch(h)
                sizes.append(len(h))
                digests.append(xxhash.xxh3_128_digest(h.tobytes()))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.int64())) for x in (rows.view(np.int64), sketches)]
            found = [b.column(0), b.column(1), b.column(2), lists[0], pa.array(sizes, pa.int64()), lists[1], pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(found, [*ROW, "w", "size", "sketch", "digest"])

    schema = "no_id boolean, id long, text_hash long, w array<bigint>, size long, sketch array<bigint>, digest binary"
    return docs.select(*_row(id_col, text_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def expected_distance(similarity: float) -> float:
    """Share of bits in which the SimHashes of two equally large shingle sets of this Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def most_apart(bits: int, similarity: float) -> int:
    """Three deviations over the mean number of ``bits`` in which pairs of this similarity differ."""
    p = expected_distance(similarity)
    return math.ceil(bits * p + 3 * math.sqrt(bits * p * (1 - p)))


#: The words of a fingerprint, as columns of their own.
PRINT = [f"w{i}" for i in range(len(WIDE))]


def _tables(n: int, similarity: float, recall: float) -> list[Column]:
    """Block keys: each of log2(n) random bits, as many as let a pair at ``similarity`` share a block with probability
    ``recall``. So neither a block's chance members nor the recall depend on the input's size; the number of keys does."""
    size = max(8, math.ceil(math.log2(max(n, 2))))
    agree = (1 - expected_distance(similarity)) ** size
    draw, keys = np.random.default_rng(256), []
    for at in range(max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))):
        masks = np.zeros(len(WIDE), np.uint64)
        for bit in draw.choice(len(WIDE) * BITS, size, replace=False).tolist():
            masks[bit // BITS] |= np.uint64(1 << (bit % BITS))
        words = (F.get("w", F.lit(i)).bitwiseAND(F.lit(int(m))) for i, m in enumerate(masks.view(np.int64).tolist()))
        keys.append(F.xxhash64(F.lit(at), *words))
    return keys


def _sets(nodes: Nodes, met: DataFrame) -> DataFrame:
    """(node, shingles binary): the sorted distinct hashes of the texts of ``met`` (node)."""
    words = nodes.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), words).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    wanted = nodes.prints.join(met, "node", "left_semi").select("node", *ROW)
    texts = nodes.docs.select(*_row(nodes.id_col, nodes.text_col), F.col(nodes.text_col).cast("string").alias("text"))
    same = texts.no_id.eqNullSafe(wanted.no_id) & texts.id.eqNullSafe(wanted.id) & (texts.text_hash == wanted.text_hash)
    found = texts.join(wanted, same).select("node", "text").mapInArrow(run, "node long, shingles binary")
    return found.groupBy("node").agg(F.min("shingles").alias("shingles"))  # repeated rows: one of them


def verified(pairs: DataFrame, nodes: Nodes, similarity: float) -> DataFrame:
    """Those of the ``pairs`` (u, v) whose shingle sets have a Jaccard similarity of ``similarity`` at least.

    Distance, sizes and sketches only pick the candidates, each with a margin of three deviations or more; each candidate is
    then decided by its shingles.
    """
    whole = lambda *names: nodes.prints.select("node", "w", "size", "sketch").toDF(*names)
    apart = F.expr("aggregate(zip_with(a, b, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    close = (apart <= most_apart(BITS * len(WIDE), similarity)) & F.expr(f"least(n, m) >= {similarity} * greatest(n, m)")
    margin = 3 * math.sqrt(similarity * (1 - similarity) / RANGES) + 0.02
    # of sets of more shingles than ranges all ranges tell; a small set's few ranges are nearly the whole set
    close &= sketch_similarity("c", "d") >= similarity - margin
    near = pairs.join(whole("u", "a", "n", "c"), "u").join(whole("v", "b", "m", "d"), "v").where(close).select("u", "v")
    near = save(near.distinct(), "candidates")
    met = near.select(F.col("u").alias("node")).union(near.select(F.col("v").alias("node"))).distinct()
    sets = save(_sets(nodes, met), "sets")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    one = near.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    two = one.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    return two.select("u", "v", "a", "b").mapInArrow(decide, "u long, v long").distinct()


def _close(x: str, y: str, similarity: float) -> str:
    """SQL: whether two rows with ``PRINT`` are near enough for this similarity, on the first word and then on all."""
    apart = [f"bit_count({x}{w} ^ {y}{w})" for w in PRINT]
    return f"{apart[0]} <= {most_apart(BITS, similarity)} AND {' + '.join(apart)} <= {most_apart(BITS * len(WIDE), similarity)}"


def _link(label: np.ndarray, at: int, others: np.ndarray) -> np.ndarray:
    """Gives ``others`` the label of ``at``, with all that share theirs; returns one of them for each label that this changed."""
    names, first = np.unique(label[others], return_index=True)
    new = others[first[names != label[at]]]
    label[np.isin(label, label[new])] = label[at]
    return new


def _cells(large: DataFrame, side: int, hashes: int | None = None) -> DataFrame:
    """``large`` (key, m struct<node, crowd, ...>) -> (key, lo, hi, end, m): all pairs of a key's members meet in cells (lo, hi) of a
    grid, but for those of one crowd.

    A crowd of over ``side`` members of a key is dealt to parts of its own, the others to parts in common, and every two parts but
    those of one crowd meet in one cell: so each pair meets once, and no task holds more than a cell of a key. Where ``hashes`` is
    given, a part has about so many of its members' shingles (``m.size``) at most, too.
    """
    held = lambda *by: large.groupBy(*by).agg(F.count("*").alias("c"), (F.sum("m.size") if hashes else F.lit(0).cast("long")).alias("h"))
    parts_of = lambda c, h: F.greatest(F.ceil(c / side), F.ceil(h / (hashes or 1))).cast("int")
    crowds = held("key", "m.crowd").where("crowd IS NOT NULL").withColumn("parts", parts_of(F.col("c"), F.col("h")))
    crowds = save(crowds.where("parts > 1"), "large_crowds")
    alone = held("key").join(crowds.groupBy("key").agg(F.sum("c").alias("of_c"), F.sum("h").alias("of_h")), "key", "left")
    left = [F.col(x) - F.coalesce(f"of_{x}", F.lit(0)) for x in ("c", "h")]
    rest = save(alone.select("key", parts_of(*left).alias("rest")), "rest")
    part = lambda crowd, i: F.struct(crowd.alias("crowd"), i.cast("int").alias("i"))
    common = F.lit(-1).cast("long")  # no node's number
    parts = crowds.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.col("crowd").alias("of"))
    parts = parts.union(rest.where("rest > 0").select("key", F.explode(F.sequence(F.lit(0), F.col("rest") - 1)).alias("i"), common))
    parts = save(parts.select("key", part(F.col("of"), F.col("i")).alias("part")), "parts")  # saved: Spark knows how many they are
    met = parts.toDF("key", "lo").join(parts.toDF("key", "hi"), "key").where("lo <= hi AND (lo.crowd <> hi.crowd OR lo.crowd = -1)")
    ends = F.array(F.struct(F.col("lo").alias("own"), F.lit("lo").alias("end")), F.struct(F.col("hi").alias("own"), F.lit("hi").alias("end")))
    met = save(met.select("key", "lo", "hi", F.explode(ends).alias("e")).select("key", "lo", "hi", "e.*").where("lo <> hi OR end = 'lo'"), "cells")
    met = met if met.count() <= SMALL else met.hint("merge")  # cells take far less room on disk than in a broadcast
    own = large.select("key", "m").join(rest, "key", "left").join(crowds.select("key", F.col("crowd").alias("of"), "parts"), (F.col("m.crowd") == F.col("of")) & large.key.eqNullSafe(crowds.key), "left")
    spot = F.pmod(F.xxhash64("m.node", F.lit(1)), F.coalesce("parts", "rest"))
    dealt = own.select(large.key.alias("key"), part(F.coalesce("of", common), spot).alias("own"), "m").join(met, ["key", "own"])
    return dealt.select("key", "lo", "hi", "end", "m")


def _grid_pairs(large: DataFrame, similarity: float, side: int = 2048) -> DataFrame:
    """``large`` (key, m struct<node, crowd, ``PRINT``>) -> (u, v): of the pairs of a key's members, but for those of one crowd, that
    :func:`_close` lets pass, a forest for each cell of :func:`_cells`.

    All pairs are compared, in arrays; so many rows leave a cell as it has members, however many pairs are close. Every node with a
    close pair is in its cell's forest, and both ends of a close pair are in one tree.
    """
    ends = (F.collect_list(F.when(F.col("end") == e, F.struct("m.node", F.coalesce("m.crowd", "m.node"), *(f"m.{w}" for w in PRINT)))).alias(e + "_m") for e in ("lo", "hi"))
    cells = _cells(large, side).groupBy("key", "lo", "hi").agg(*ends)
    near, near_all = most_apart(BITS, similarity), most_apart(BITS * len(WIDE), similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                same = b.column(0)[i].as_py()
                (xn, xc, *xw), (yn, yc, *yw) = ([c.field(k).to_numpy() for k in range(2 + len(PRINT))] for c in (b.column(j)[i].values for j in (1, 1 if same else 2)))
                shift, us, vs = 0 if same else len(xn), [], []
                label = np.arange(shift + len(yn))
                for at in range(0, len(xn), 256):
                    hit = np.bitwise_count(xw[0][at : at + 256, None].view(np.uint64) ^ yw[0][None, :].view(np.uint64)) <= near
                    hit &= xc[at : at + 256, None] != yc[None, :]
                    if same:
                        hit &= xn[at : at + 256, None] < yn[None, :]
                    p, q = np.nonzero(hit)
                    apart = sum(np.bitwise_count(x[at + p].view(np.uint64) ^ y[q].view(np.uint64)).astype(np.int64) for x, y in zip(xw, yw))
                    p, q = at + p[apart <= near_all], q[apart <= near_all]
                    rows, starts = np.unique(p, return_index=True)
                    for row, others in zip(rows.tolist(), np.split(q, starts[1:])):
                        new = _link(label, row, shift + others) - shift
                        us.append(np.full(len(new), xn[row]))
                        vs.append(yn[new])
                u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (us, vs))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    return cells.select((F.col("lo") == F.col("hi")).alias("same"), "lo_m", "hi_m").mapInArrow(run, "u long, v long")


def _family_links(family: DataFrame, nodes: Nodes, similarity: float, side: int = 1024, hashes: int = 1 << 18) -> DataFrame:
    """``family`` (key, m struct<node, crowd, size, ``PRINT``>) -> (u, v): links of ``similarity`` that join, with those inside crowds,
    what all such pairs of a family's members join.

    The members' shingles meet in cells of :func:`_cells`. In a cell, a pair that the fingerprints and sizes let pass is decided by its
    shingles, unless links found before have joined it; the links that join something leave the cell.
    """
    sets = save(_sets(nodes, family.select("m.node")), "sets")
    dealt = _cells(family, side, hashes).select("key", "lo", "hi", (F.col("end") == "lo").alias("first"), "m.*").join(sets, "node")
    near, near_all = most_apart(BITS, similarity), most_apart(BITS * len(WIDE), similarity)
    columns = ["node", F.coalesce("crowd", "node").alias("crowd"), *PRINT, "shingles"]

    def run(t: pa.Table) -> pa.Table:
        first, node = (t[c].to_numpy() for c in ("first", "node"))
        order = np.lexsort((node, ~first))
        node, n, us, vs = node[order], len(order), [], []
        crowd, *w = (t[c].to_numpy()[order] for c in ("crowd", *PRINT))
        w = [x.view(np.uint64) for x in w]
        label = np.unique(crowd, return_inverse=True)[1]
        found = [np.frombuffer(x, np.uint64) for x in t["shingles"].take(pa.array(order)).to_pylist()]
        size = np.fromiter(map(len, found), np.int64, n)
        names, ids = np.unique(np.concatenate(found), return_inverse=True)
        ids, held = np.split(ids, np.cumsum(size)[:-1]), np.zeros(len(names), bool)
        upto = int(first.sum())
        for i in range(upto):
            j = np.arange(i + 1 if upto == n else upto, n)  # one part with itself, or two parts
            j = j[np.bitwise_count(w[0][i] ^ w[0][j]) <= near]
            j = j[(label[j] != label[i]) & (np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]))]
            j = j[sum(np.bitwise_count(x[i] ^ x[j]).astype(np.int64) for x in w) <= near_all]
            if not len(j):
                continue
            held[ids[i]] = True
            both = np.add.reduceat(held[np.concatenate([ids[k] for k in j])], np.cumsum(size[j]) - size[j], dtype=np.int64)
            held[ids[i]] = False
            new = _link(label, i, j[both >= similarity * (size[i] + size[j] - both) - 1e-9])
            us.append(np.full(len(new), node[i]))
            vs.append(node[new])
        u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (us, vs))
        return pa.table({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    return dealt.select("key", "lo", "hi", "first", *columns).groupBy("key", "lo", "hi").applyInArrow(run, "u long, v long")


def _crowds(nodes: Nodes, keys: list[Column], similarity: float, group: int) -> tuple[DataFrame | None, DataFrame]:
    """Links found in blocks of over ``group``, and (node, w, size, crowd): a node's crowd so far, null where it has none.

    The members of such a block are compared with one of them, drawn anew in each round, until a round links few. A member that is
    linked joins its crowd, of which the next rounds have one member in each block. Which members meet here decides only what
    need not be compared later, pairs of one crowd: all other pairs of a block are left to :func:`similar_roots`.
    """
    known, links, turn = nodes.prints.select("node", "w", "size", F.lit(None).cast("long").alias("crowd")), None, 0
    own = F.coalesce("crowd", "node").alias("own")
    while True:
        sizes = _blocks(known, keys).groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", *PRINT)).alias("hub"))
        hubs = save(sizes.where(F.col("n") > group).select("key", F.col("hub.node").alias("hub"), *(F.col(f"hub.{w}").alias(f"hub_{w}") for w in PRINT)), "hubs")
        stars = _blocks(known, keys).join(hubs, "key").where(f"node <> hub AND {_close('', 'hub_', similarity)}")
        stars = save(stars.select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct(), "stars")
        compared = stars.count()
        if not compared:
            return links, known
        found = save(verified(stars, nodes, similarity), "crowds")
        links, turn = found if links is None else links.union(found), turn + 1
        names = known.select("node", own)
        joined = found.join(names.toDF("u", "to"), "u").join(names.toDF("v", "own"), "v").where("`to` <> own")
        joined = joined.groupBy("own").agg(F.min("to").alias("to"))
        joined = joined.union(joined.select(F.col("to").alias("own"), "to")).groupBy("own").agg(F.min("to").alias("to"))
        known = save(known.withColumn("own", own).join(joined, "own", "left").select("node", "w", "size", F.coalesce("to", "crowd").alias("crowd")), "known")
        if 10 * found.count() < compared:
            return links, known


def _blocks(known: DataFrame, keys: list[Column]) -> DataFrame:
    """(key, node, ``PRINT``): each node's blocks; of a crowd, one member in each block, drawn by the block."""
    keyed = lambda rows: rows.select("crowd", "node", *(F.get("w", F.lit(i)).alias(w) for i, w in enumerate(PRINT)), F.explode(F.array(*keys)).alias("key"))
    alone = keyed(known.where("crowd IS NULL")).select("key", "node", *PRINT)
    drawn = F.min(F.struct(F.xxhash64("node", "key").alias("draw"), "node", *PRINT)).alias("m")
    crowded = keyed(known.where("crowd IS NOT NULL")).groupBy("key", "crowd").agg(drawn)
    return alone.union(crowded.select("key", "m.node", *(f"m.{w}" for w in PRINT)))


def similar_roots(nodes: Nodes, n: int, similarity: float = 0.8, recall: float = 0.97, group: int = 32, first: int = 6) -> DataFrame:
    """``nodes`` -> (node, root): components of links between texts whose shingle sets are as similar as ``similarity``.

    Fingerprints of such similarity differ in too many bits for blocks that are sure to agree, so blocks are drawn at
    random (:func:`_tables`); pairs that share one are verified by their shingles. Crowds come first (:func:`_crowds`), in the
    ``first`` tables: their members are linked already. Then, in all tables, all members of a block are compared pair by pair, but
    for pairs of one crowd. In blocks over ``group`` this is done in arrays: the nodes that have close pairs there are families
    (:func:`_grid_pairs`), of whose pairs all are verified, each once, where their shingles meet (:func:`_family_links`). So no
    row is made for a pair of a family. The pairs of smaller blocks that are of no one family are rows. No pair that shares a block
    and could link anything anew is left out, however large the block, the crowd or the family.
    """
    keys = _tables(n, similarity, recall)
    # bounds three deviations off, on the first word and then on the whole fingerprint, leave few pairs to fetch sketches for
    links, known = _crowds(nodes, keys[:first], similarity, group)
    words = [F.get("w", F.lit(i)).alias(w) for i, w in enumerate(PRINT)]
    # Spark takes rows made by explode for as many as went in; it can broadcast only the right side of a semi-join, so they stay on the left
    blocked = lambda *names: known.select("node", *names, *words, F.explode(F.array(*keys)).alias("key"))
    sizes = save(blocked().groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "blocks")
    if sizes.where(F.col("n") > group).isEmpty():
        known = known.withColumn("family", F.lit(None).cast("long"))
    else:
        large = blocked("crowd").join(sizes.where(F.col("n") > group), "key", "left_semi").select("key", F.struct("node", "crowd", *PRINT).alias("m"))
        trees = connected_components(_grid_pairs(large, similarity))
        families = trees.select("node", F.col("root").alias("family")).union(trees.select("root", "root").distinct())
        known = save(known.join(families, "node", "left"), "families")
        members = known.where("family IS NOT NULL").select(F.col("family").alias("key"), F.struct("node", "crowd", "size", *words).alias("m"))
        found = save(_family_links(members, nodes, similarity), "family_links")
        links = found if links is None else links.union(found)
    blocks = blocked("crowd", "family").join(sizes.where(F.col("n") <= group), "key", "left_semi")
    blocks = blocks.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "crowd", "family", *PRINT))).alias("f"))
    apart = "coalesce(x.crowd <> y.crowd, true) AND coalesce(x.family <> y.family, true)"
    pairs = blocks.select(
        F.explode(
            F.expr(
                f"""flatten(transform(f, (x, i) -> transform(
                      filter(slice(f, i + 2, {group}), y -> {apart} AND {_close('x.', 'y.', similarity)}),
                      y -> struct(x.node AS u, y.node AS v))))"""
            )
        ).alias("e")
    ).select("e.u", "e.v")
    pairs = save(pairs.distinct(), "pairs")
    last = verified(pairs, nodes, similarity)
    return connected_components(last if links is None else links.union(last))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(``ROW``, digest): one row per input row; (digest, root, ``ROW``): its component, and one of its rows."""
    fps = save(wide_fingerprints(docs, id_col, text_col, words), "wide")
    row = F.min(F.struct(*ROW)).alias("row")
    named = fps.groupBy("digest").agg(row, F.first("w").alias("w"), F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    # numbers made once, when the table is written
    named = save(named.select(F.monotonically_increasing_id().alias("node"), "digest", "w", "size", "sketch", "row.*"), "nodes")
    roots = similar_roots(Nodes(named.drop("digest"), docs, id_col, text_col, words), named.count(), similarity)
    return fps, save(named.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), *ROW), "rooted")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(``id_col``, component_id long): the smallest id that links of ``similarity`` over ``words``-word shingles reach.

    One row per input row. Rows that repeat an id are texts of their own, and so are rows with a null id, which is no component's
    name: a component without any other id has a null one. Blank texts link with each other only.
    """
    fps, rooted = _grouped(docs, id_col, text_col, words, similarity)
    least = save(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    named = rooted.join(least, "root").select("digest", "component_id")
    return fps.join(named, "digest").select(F.col("id").alias(id_col), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``docs`` for each component of links of ``similarity`` over ``words``-word shingles, all columns.

    The one with the smallest id stays, null ids last; of rows that share that id, the one with the smaller text hash, and of rows
    that repeat id and text any one. Rows that share an id, or have none, are told apart by their texts.
    """
    first = len(SAVED)
    rooted = _grouped(docs, id_col, text_col, words, similarity)[1]
    firsts = save(rooted.groupBy("root").agg(F.min(F.struct(*ROW)).alias("row")).select("row.*"), "firsts")
    del rooted
    release(docs.sparkSession, first)
    own = dict(zip((f"__near_{c}" for c in ROW), _row(id_col, text_col)))  # names that no table has
    # plain keys, no nulls: rows that repeat lie together after the join, and texts move once
    rows = docs.withColumns(own).withColumn("__near_id", F.coalesce("__near_id", F.lit(0)))
    firsts = firsts.select("no_id", F.coalesce("id", F.lit(0)), "text_hash").toDF(*own)
    return rows.join(firsts, list(own), "left_semi").dropDuplicates(list(own)).drop(*own)
