"""Packing token sequences into windows of fixed capacity by exact complements, then best fit.

Only the histogram of lengths, at most ``capacity`` rows, reaches the driver. The plan made from it says how
many windows hold which lengths; every piece then finds its window by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import save

#: How byte-level BPE splits a text before merging (a fixed value of that vocabulary).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` JSON file, run by a faster library; same ids.

    The file's token names spell each byte as a printable character: bytes that are printable in Latin-1 stand
    for themselves, the others follow from code point 256 on. A token's id is its merge rank. The file's added tokens are
    special ones: ``encode`` with ``allowed_special="all"`` gives their ids, ``encode_ordinary`` takes them for text.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model = file["model"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {chr(b): b for b in plain}
    names |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    ranks = {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if all(c in names for c in token)}
    added = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
    special = {t.encode() for t in added}
    return tiktoken.Encoding("corpus", pat_str=SPLIT, mergeable_ranks={t: i for t, i in ranks.items() if t not in special}, special_tokens=added)


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
    group_col: str | None = None,
) -> DataFrame:
    """(``id_col``, piece, start, length, ids_crc32[, ids][, ``group_col``]): each text's ids and ``end_id``, cut if over ``capacity``.

    All pieces of a cut text but the first are full. Null and empty texts give the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(encoder(tokenizer).encode, allowed_special="all")
        for b in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            texts_of = []
            for i, (name, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1))):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                first = len(ids) % capacity or capacity
                for k, end in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, end - capacity)
                    own = ids[start:end]
                    for to, x in zip(rows, (name, k, start, end - start, zlib.crc32(own.tobytes()), own.tolist() if keep_ids else None)):
                        to.append(x)
                    texts_of.append(i)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            n = 5 + keep_ids
            arrays, names = [pa.array(x, t) for x, t in zip(rows[:n], kinds)], [id_col, "piece", "start", "length", "ids_crc32", "ids"][:n]
            more = [b.column(2).take(pa.array(texts_of, pa.int64()))] if group_col else []
            yield pa.RecordBatch.from_arrays([*arrays, *more], [*names, *[group_col] * len(more)])

    schema = f"`{id_col}` long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids + (f", `{group_col}` long" if group_col else "")
    group = [F.col(group_col).cast("long")] if group_col else []
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), *group).mapInArrow(run, schema)


class _Sums:
    """An index of the sums of one, two and three available lengths, kept under their counts.

    For a sum, the index holds the largest first length with which it can still be made. Counts only fall, so
    that length does too: an entry that has run out moves down, and never up again.
    """

    def __init__(self, have: np.ndarray):
        self.have = have
        top = np.arange(len(have))
        self.pairs, self.triples = top - 1, top - 2

    def _left(self, *lengths: int) -> bool:
        return all(self.have[x] >= lengths.count(x) for x in lengths)

    def _halves(self, total: int, most: int) -> np.ndarray:
        """The larger lengths, none over ``most``, of the pairs of this sum; the largest first."""
        low, high = (total + 1) // 2, int(self.pairs[total])
        if high < low:
            return np.zeros(0, np.int64)
        small, large = self.have[total - high : total - low + 1], self.have[low : high + 1][::-1]
        found = (small > 0) & (large > 0)
        if 2 * low == total:
            found[-1] = self.have[low] > 1
        halves = high - np.flatnonzero(found)
        self.pairs[total] = halves[0] if len(halves) else 0
        return halves[halves <= most]

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that add up to ``gap``; the largest first."""
        if self.have[gap] > 0:
            return (gap,)
        halves = self._halves(gap, gap)
        if len(halves):
            return int(halves[0]), gap - int(halves[0])
        open_ = np.flatnonzero(self.have[: max(0, int(self.triples[gap])) + 1])[::-1]
        for at in open_[3 * open_ >= gap].tolist():
            for half in self._halves(gap - at, at).tolist():
                if self._left(at, half, gap - at - half):
                    self.triples[gap] = at
                    return at, half, gap - at - half
        self.triples[gap] = 0
        return None


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: windows with the same contents are handled together."""
    rooms: dict[int, list[list]] = defaultdict(list)  # free space -> [lengths, windows]
    free = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(free[length:])
            if len(fits):
                room = length + int(fits[0])
                held, n = rooms[room].pop()
                took = min(n, left)
                if n > took:
                    rooms[room].append([held, n - took])
                free[room] = bool(rooms[room])
                fill = 1
            else:
                fill = min(capacity // length, left)
                held, took, room = (), left // fill, capacity
            rooms[room - fill * length].append([(*held, *[length] * fill), took])
            free[room - fill * length] = True
            left -= took * fill
    return [(tuple(held), n) for groups in rooms.values() for held, n in groups]


def _complements(counts: np.ndarray, capacity: int, least: int) -> list[tuple[tuple[int, ...], int]]:
    """Exact complements of lengths from ``least`` on, then best fit of what is left and of the shorter ones."""
    have, made = counts.copy(), []
    have[:least] = 0
    sums = _Sums(have)
    for length in range(capacity, 0, -1):
        while have[length] > 0:
            have[length] -= 1
            rest = () if length == capacity else sums.fill(capacity - length)
            have[length] += 1
            if rest is None:
                break
            held = (length, *rest)
            n = min(int(have[x]) // held.count(x) for x in held)
            for x in held:
                have[x] -= n
            made.append((held, n))
    have[:least] = counts[:least]
    return made + _best_fit(have, capacity)


#: Shares of the capacity under which pieces may be held back for the residue.
HELD_BACK = (0, 1 / 16, 1 / 8, 3 / 16, 1 / 4)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Contents and number of windows for a histogram of lengths.

    From the longest length down, singles, pairs and triples that fill its gap exactly are consumed, as many as
    the counts allow; what is left goes by best fit. Exact fills use up the short pieces that the residue needs, so the plan is
    made with several bounds under which pieces are held back; the one with the fewest windows stays, then the lowest bound.
    """
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    plans = [_complements(have, capacity, max(1, int(capacity * share))) for share in HELD_BACK]
    return min(plans, key=lambda p: sum(n for _, n in p))


def place(found: DataFrame, capacity: int = 2048, id_col: str = "doc_id", group_col: str | None = None) -> DataFrame:
    """``found`` (rows of :func:`pieces`, saved) with sequence_id and offset; windows hold pieces of one group, and are numbered
    group by group."""
    by = [group_col, "length"] if group_col else ["length"]
    n = found.count()
    salts = max(32, n // 500_000)
    salted = found.withColumn("salt", F.pmod(F.xxhash64(id_col, "piece"), F.lit(salts)))
    sums = save(salted.groupBy(*by, "salt").agg(F.count("*").alias("n")), "lengths")
    groups: dict[int, dict[int, int]] = defaultdict(dict)
    for r in sums.groupBy(*by).agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows a group
        groups[r[group_col] if group_col else 0][r.length] = r.n
    before = Window.partitionBy(*by).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy(*by, "salt").orderBy(id_col, "piece"))
    ranked = salted.withColumn("nth", nth).join(sums, [*by, "salt"]).withColumn("nth", F.col("nth") - 1 + F.col("before"))
    ranked = ranked.drop("salt", "before")

    slots, first = [], 0
    for nth_group, group in enumerate(sorted(groups)):
        upto: dict[int, int] = defaultdict(int)
        for held, m in plan(groups[group], capacity):
            at = 0
            for length in sorted(set(held), reverse=True):
                each = held.count(length)
                slots.append((nth_group * (capacity + 1) + length, upto[length], each, first, at))
                upto[length] += m * each
                at += each * length
            first += m
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    keys, order = (table[:, 0] << 40) + table[:, 1], np.array(sorted(groups), np.int64)
    names = ranked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, nth = (b.column(names.index(c)).to_numpy() for c in ("length", "nth"))
            group = np.searchsorted(order, b.column(names.index(group_col)).to_numpy()) if group_col else 0
            slot = table[np.searchsorted(keys, (group * (capacity + 1) + length << 40) + nth, "right") - 1]
            k = nth - slot[:, 1]
            own = {"sequence_id": slot[:, 3] + k // slot[:, 2], "offset": slot[:, 4] + k % slot[:, 2] * length}
            kept = [(c, b.column(i)) for i, c in enumerate(names) if c != "nth"]
            yield pa.RecordBatch.from_arrays([*(x for _, x in kept), *map(pa.array, own.values())], [*(c for c, _ in kept), *own])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "nth")
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
    group_col: str | None = None,
) -> DataFrame:
    """Every document's pieces with their window (sequence_id) and place in it (offset), gapless from 0.

    ``tokenizer`` is the path of a byte-level BPE file, the same on every executor. Rows that repeat an id are
    packed one by one. An empty table gives an empty result. With ``group_col`` (whole numbers), groups are packed apart and
    sequences are numbered in the groups' order; the driver has a histogram of each. Other columns of ``docs`` are not read.
    """
    found = save(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, keep_ids, group_col), "pieces")
    return place(found, capacity, id_col, group_col)
