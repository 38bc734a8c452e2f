"""Exact removal of repeated byte strings by a family of sparse suffix arrays of logarithmic depth.

Of a text's suffixes those are indexed that start at a minimizer: of the ``span`` byte strings of ``SEED`` bytes
in a window of ``length`` bytes, the leftmost one with the least hash. The choice depends on the window's bytes
alone, so equal windows have equal anchors at equal places, and each window belongs to one anchor. The windows
of an anchor are a run of neighbours; a run's bytes are its context. One entry (seed, context, place) stands for
about 39 windows of 100 bytes.

A batch of documents becomes an array of entries sorted by (seed, context). Arrays are cut into shards by ranges
of the seed. In a shard each new array is merge-scanned with the levels it meets, equal-sized levels being merged
geometrically: where contexts are equal, the later one repeats whole; where only seeds are equal, the run is
open, and its windows are compared by themselves in a second pass over the open contexts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import mix, pack, packed_texts, part_bytes, save, shards, text_bytes, unpack, unpacked_texts

SEED = 32
SEGMENT = 1 << 18
_VALUE = np.random.default_rng(41).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_MULTIPLIERS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)]


#: Other values of the bytes, for hashes that are independent of the first.
_OTHER = np.random.default_rng(43).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
#: Bits of a place in a segment: the hash of a seed gives way to them, in every segment alike.
PLACE_BITS = np.uint64(20)


def rolling(buf: np.ndarray, length: int, values: np.ndarray = _VALUE) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from each place on, built by doubling."""
    n = len(buf) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, k = values[buf], 1, 0
    out, at = None, 0
    while True:
        if length & size:
            out = power[at : at + n].copy() if out is None else mix(out) + power[at : at + n]
            at += size
        size *= 2
        if size > length:
            return mix(out)
        half = size // 2
        longer = power[: len(power) - half] * _MULTIPLIERS[k % 7]
        longer += power[half:]
        power, k = longer, k + 1


def runs(buf: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each run, and the hash of its seed; ``ends``: where each place's text ends."""
    span = length - SEED + 1
    n = len(buf) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    seeds = rolling(buf, SEED)
    bits = PLACE_BITS
    if len(buf) >> int(bits):
        raise ValueError("a segment is longer than its places have bits for")
    best = (seeds >> bits << bits) | np.arange(len(seeds), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if span > size:
        best = np.minimum(best[: size - span], best[span - size :])
    anchor = (best[:n] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    whole = np.flatnonzero(ends[:n] - np.arange(n) >= length)
    if not len(whole):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    own = anchor[whole]
    cut = np.flatnonzero(np.diff(own)) + 1
    first, last = whole[np.concatenate(([0], cut))], whole[np.concatenate((cut - 1, [len(whole) - 1]))]
    # the least hashes were chosen, so they are scattered anew
    return first, last, mix(seeds[own[np.concatenate(([0], cut))]] * np.uint64(0xA0761D6478BD642F))


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Texts end to end, about SEGMENT bytes at a time: the bytes; for each place the text's number, the shift to
    the place in that text, and the text's end."""
    held: list[tuple[int, int, bytes]] = []
    total = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), SEGMENT):  # long texts in parts that share length - 1 bytes
            held.append((i, at, t[at : at + SEGMENT + length - 1]))
            total += len(held[-1][2])
            if total >= SEGMENT:
                yield _joined(held)
                held, total = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, int, bytes]]):
    sizes = np.array([len(t) for _, _, t in held])
    ends = np.cumsum(sizes)
    shift = np.array([at for _, at, _ in held]) - (ends - sizes)
    number = np.array([i for i, _, _ in held])
    return b"".join(t for _, _, t in held), np.repeat(number, sizes), np.repeat(shift, sizes), np.repeat(ends, sizes)


class _Part:
    """The documents of a part in order of their ids, with the entries of their sparse suffix array."""

    def __init__(self, blobs: pa.ChunkedArray, length: int):
        found = sorted((i, t) for ids, texts in unpacked_texts(blobs) for i, t in zip(ids.tolist(), texts))
        self.length, self.texts = length, [t for _, t in found]
        self.ids = np.array([i for i, _ in found], np.int64)
        self.base = np.concatenate(([0], np.cumsum([len(t) for t in self.texts]))).astype(np.int64)
        self.segments, columns = [], []
        digest = xxhash.xxh3_64_intdigest
        for bytes_, number, shift, ends in _segments(self.texts, length):
            first, last, seed = runs(np.frombuffer(bytes_, np.uint8), ends, length)
            context = np.fromiter((digest(bytes_[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())), np.uint64, len(first))
            own = number[first]
            columns.append((seed, context, own, first + shift[first], last - first + 1, np.full(len(first), len(self.segments)), first))
            self.segments.append(bytes_)
        self.seed, self.context, self.number, self.start, self.windows, self.segment, self.place = (np.concatenate(c) for c in zip(*columns))
        self.order = np.lexsort((self.context, self.seed))
        seed, context = self.seed[self.order], self.context[self.order]
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (context[1:] != context[:-1])
        self.own, self.repeats = self.order[new], self.order[~new]

    def at(self) -> np.ndarray:
        """Where each entry's first window begins, counted through all texts of the part."""
        return self.base[self.number] + self.start

    def open_windows(self, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows of open entries, in order: the distinct ones' hashes (64 bits, and 32 independent ones) and entry
        numbers, the place of each, then the places of the others; sorted by hash."""
        open_ = np.sort(open_)
        hashes, checks, places, entries = [], [], [], []
        cuts = np.searchsorted(self.segment[open_], np.arange(len(self.segments) + 1))
        for k, bytes_ in enumerate(self.segments):
            own = open_[cuts[k] : cuts[k + 1]]
            if not len(own):
                continue
            n = self.windows[own]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            buf, at = np.frombuffer(bytes_, np.uint8), np.repeat(self.place[own], n) + step
            hashes.append(rolling(buf, self.length)[at])
            checks.append((rolling(buf, self.length, _OTHER)[at] >> np.uint64(32)).astype(np.uint32))
            places.append(np.repeat(self.at()[own], n) + step)
            entries.append(np.repeat(own, n))
        if not hashes:
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none.astype(np.uint32), none, none, none
        h, c, p, e = (np.concatenate(x) for x in (hashes, checks, places, entries))
        order = np.lexsort((c, h))
        h, c, p, e = h[order], c[order], p[order], e[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        return h[new], c[new], p[new], e[new], p[~new]


def _cuts(hashes: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of sorted hashes: shards are ranges of hashes."""
    own = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(own, prepend=np.uint64(n + 1)))
    return list(zip(own[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(own)]))


_ARRAYS = ["shard", "part", "entries"]
_SHARDED = "shard int, part int, entries binary"


def _sharded(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary()))], _ARRAYS)


def _index(length: int, n_shards: int):
    def run(t: pa.Table) -> pa.Table:
        part, number = _Part(t.column("texts"), length), t.column("part")[0].as_py()
        own = part.own
        seed = part.seed[own]
        columns = (part.context[own], part.ids[part.number[own]], part.start[own])
        return _sharded([(s, number, pack(np.diff(seed[a:b], prepend=np.uint64(0)), *(c[a:b] for c in columns))) for s, a, b in _cuts(seed, n_shards)])

    return run


REPEATED, OPEN = 1, 2


class Levels:
    """A logarithmic family of sorted arrays (first key, second key, document, place, number).

    ``add`` merge-scans a new array with the levels that are no more than twice its size, from small to large,
    and leaves one level in their place, so sizes grow geometrically. Of entries with equal keys the later one
    (larger document, then place) is marked repeated and leaves the family; entries that share the first key alone
    are marked open. ``close`` scans what is left together; then every pair of arrays has met.
    """

    def __init__(self, size: int):
        self.state = np.zeros(size, np.uint8)
        self.levels: list[tuple[np.ndarray, ...]] = []

    def _scan(self, a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        first, second, doc, place, number = (np.concatenate(x) for x in zip(a, b))
        order = np.lexsort((second, first))
        first, second, doc, place, number = (x[order] for x in (first, second, doc, place, number))
        same = np.flatnonzero((first[1:] == first[:-1]) & (second[1:] == second[:-1]))
        left_later = (doc[same] > doc[same + 1]) | ((doc[same] == doc[same + 1]) & (place[same] > place[same + 1]))
        later = np.where(left_later, same, same + 1)
        self.state[number[later]] = REPEATED
        keep = np.ones(len(first), bool)
        keep[later] = False
        first, second, doc, place, number = (x[keep] for x in (first, second, doc, place, number))
        near = first[1:] == first[:-1]
        self.state[number[1:][near]] = OPEN
        self.state[number[:-1][near]] = OPEN
        return first, second, doc, place, number

    def add(self, array: tuple[np.ndarray, ...]) -> None:
        near = array[0][1:] == array[0][:-1]
        self.state[array[4][1:][near]] = OPEN
        self.state[array[4][:-1][near]] = OPEN
        while self.levels and len(self.levels[-1][0]) <= 2 * len(array[0]):
            array = self._scan(self.levels.pop(), array)
        self.levels.append(array)

    def close(self) -> np.ndarray:
        while len(self.levels) > 1:
            last = self.levels.pop()
            self.levels.append(self._scan(self.levels.pop(), last))
        return self.state


def _resolve(t: pa.Table) -> pa.Table:
    """What a shard's arrays find out about each other: a state per entry, for each part."""
    shard = t.column("shard")[0].as_py()
    arrays = [unpack(x.as_py()) for x in t.column("entries")]
    sizes = [len(a[0]) for a in arrays]
    levels, upto = Levels(sum(sizes)), 0
    for (delta, context, doc, place), n in zip(arrays, sizes):
        levels.add((np.cumsum(delta), context.astype(np.uint64), doc, place, np.arange(upto, upto + n)))
        upto += n
    state = np.split(levels.close(), np.cumsum(sizes)[:-1])
    return _sharded([(shard, p, pack(s)) for p, s in zip(t.column("part").to_pylist(), state)])


def _states(answers: pa.Table) -> np.ndarray:
    """A part's answers in the order in which it sent its entries."""
    found = [unpack(x.as_py())[0] for x in answers.sort_by("shard").column("entries")]
    return np.concatenate(found) if found else np.zeros(0, np.uint8)


def _open(length: int, n_shards: int):
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _sharded([])
        part = _Part(texts.column("texts"), length)
        h, c, p, e, _ = part.open_windows(part.own[_states(answers) == OPEN])
        doc = part.ids[part.number[e]]
        place = p - part.base[part.number[e]]
        number = texts.column("part")[0].as_py()
        return _sharded([(s, number, pack(np.diff(h[a:b], prepend=np.uint64(0)), c[a:b], doc[a:b], place[a:b])) for s, a, b in _cuts(h, n_shards)])

    return run


def _finish(length: int, id_col: str):
    def run(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        names = [id_col, "n_bytes", "spans", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        if not texts.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names)
        part = _Part(texts.column("texts"), length)
        state = _states(answers.filter(pc.equal(answers.column("round"), 1)))
        _, _, p, _, local = part.open_windows(part.own[state == OPEN])
        again = _states(answers.filter(pc.equal(answers.column("round"), 2))) == REPEATED
        whole = np.concatenate((part.repeats, part.own[state == REPEATED]))
        single = np.concatenate((p[again], local))
        change = np.zeros(part.base[-1] + 1, np.int32)
        at = part.at()
        np.add.at(change, np.concatenate((at[whole], single)), 1)
        np.add.at(change, np.concatenate((at[whole] + part.windows[whole] - 1 + length, single + length)), -1)
        covered = np.cumsum(change[:-1], dtype=np.int32) > 0
        del change
        begins, ends = [], []
        kept = []
        for k, text in enumerate(part.texts):
            own = covered[part.base[k] : part.base[k + 1]]
            if not own.any():
                begins.append(np.zeros(0, np.int64))
                ends.append(begins[-1])
                kept.append(text)
                continue
            turn = np.flatnonzero(np.diff(own.view(np.int8), prepend=0, append=0))
            begins.append(turn[::2])
            ends.append(turn[1::2])
            kept.append(np.frombuffer(text, np.uint8)[~own].tobytes())
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in begins]))).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (begins, ends)], ["start", "end"])
        spans = pa.ListArray.from_arrays(offsets, pairs)
        return pa.table([pa.array(part.ids), pa.array(np.diff(part.base)), spans, pa.array(kept, pa.binary())], names)

    return run


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_bytes, spans, kept): each text without the bytes of ``length``-byte strings that also start earlier.

    Earlier means in a smaller id, or in the same text at a smaller place; strings are judged on the input and may
    overlap. ``spans`` are the maximal removed runs [start, end), ``kept`` the other bytes. Null texts count as
    empty, texts under ``length`` bytes stay whole. A text with a null id has no place in the order: it stays whole, and nothing
    repeats it. Rows that repeat an id are texts of their own. An empty table gives an empty result. Other columns are not read.

    Seeds and contexts are compared by hashes of 128 bits together, windows by 96 bits: among 10**12 open windows a
    wrong match has a chance of one in 100,000.
    """
    if length < 2 * SEED:
        raise ValueError(f"length must be at least {2 * SEED}")
    own = docs.where(F.col(id_col).isNotNull())
    total = text_bytes(own, text_col)
    n = shards(total, part_bytes(total))
    texts = packed_texts(own, id_col, text_col, F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(n)))
    sent = texts.groupBy("part").applyInArrow(_index(length, n), _SHARDED)
    states = save(sent.groupBy("shard").applyInArrow(_resolve, _SHARDED), "states")
    opened = texts.groupBy("part").cogroup(states.groupBy("part")).applyInArrow(_open(length, n), _SHARDED)
    verdicts = opened.groupBy("shard").applyInArrow(_resolve, _SHARDED)
    answers = states.withColumn("round", F.lit(1)).union(verdicts.withColumn("round", F.lit(2)))
    schema = f"`{id_col}` long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    found = texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_finish(length, id_col), schema)
    raw = F.coalesce(F.encode(F.col(text_col).cast("string"), "UTF-8"), F.lit(b""))
    none = F.array().cast(found.schema["spans"].dataType)
    nameless = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias(id_col), F.length(raw).cast("long").alias("n_bytes"), none.alias("spans"), raw.alias("kept"))
    return found.unionByName(nameless)
