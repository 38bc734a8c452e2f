"""What the operators of this subpackage share: tables, intermediate results, packed arrays."""

from __future__ import annotations

import atexit
import gc
import math
import tempfile
import uuid
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words everywhere in this subpackage.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: Tables that :func:`save` has written and nothing has removed, in order.
SAVED: list[str] = []
#: Tables written, in all; after so many each time the driver drops what it holds for plans that are gone.
WRITTEN, CLEAN_AFTER = count(1), 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; one of our own only where that is unset and the session is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quotewright-")
        spark.sparkContext.setCheckpointDir(folder)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return folder


def save(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Writes ``df`` as a table into the shared folder and reads it back, which cuts its lineage.

    The files outlive lost executors. They are removed when the driver's Python ends. Where about how many ``rows`` of a
    few numbers there are is known, files hold about 100,000 of them instead of a share for each shuffle partition.
    """
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / 100_000)))
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quotewright-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    SAVED.append(path)
    if not next(WRITTEN) % CLEAN_AFTER:
        clean(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int) -> None:
    """Removes the tables saved from number ``since`` on, but for the last one, and what Spark holds for them.

    An operator calls it once a table is written on which alone, and on its input, its result depends.
    """
    for path in SAVED[since:-1]:
        _remove(spark, path)
    del SAVED[since:-1]
    clean(spark)


def clean(spark: SparkSession) -> None:
    """Drops what the driver holds for plans that are gone; Spark then clears their shuffles and broadcasts. Many short queries in a
    row otherwise let the driver's heap grow as far as it may, whatever the input's size."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder's owner clears it
        pass


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores before them until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def text_bytes(df: DataFrame, text: str) -> int:
    return df.select(F.sum(F.octet_length(text))).first()[0] or 0


def shards(n_bytes: int, each: int) -> int:
    """As many parts of about ``each`` bytes as hold ``n_bytes``; grows with the input without a limit."""
    return max(4, math.ceil(n_bytes / each))


def pack(*arrays: np.ndarray) -> bytes:
    """Numpy arrays as one compressed blob; the bytes of a number are stored plane by plane."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(f"{a.dtype.str},{len(a)};".encode())
        parts.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"")
    head = b"".join(parts[::2])
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(parts[1::2]))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for item in raw[4:at].decode().split(";")[:-1]:
        kind, n = item.split(",")
        size, n = np.dtype(kind).itemsize, int(n)
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * size
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply), in place on a copy."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def chunks(ids: list, texts: list[bytes], size: int) -> Iterator[tuple[list, list[bytes]]]:
    """Consecutive documents, about ``size`` bytes at a time."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield ids[start : i + 1], texts[start : i + 1]
            start, total = i + 1, 0
    if start < len(ids):
        yield ids[start:], texts[start:]


def part_bytes(total: int) -> int:
    """Size of a part of a corpus of ``total`` bytes: a 64th of it, between 8 and 24 MB."""
    return min(24 << 20, max(8 << 20, total // 64))


#: Stands for a null id in packed texts; no other row may have it.
NO_ID = -(1 << 63)


def packed_texts(docs: DataFrame, id_col: str, text_col: str, part: Column, *numbers: Column) -> DataFrame:
    """``docs`` -> (part int, texts binary): whole texts, those of a part and an Arrow batch in one blob.

    A blob holds ids, ``numbers`` (whole ones), text lengths and UTF-8 bytes, compressed, so that a shuffle by part moves
    little. Null texts count as empty, null ids become ``NO_ID``. Read it with :func:`unpacked_texts`, or :func:`unpacked_rows`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            parts, *longs = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, *range(3, b.num_columns)))
            texts = [(t.as_py() or "").encode() for t in b.column(0)]
            order = np.argsort(parts, kind="stable")
            cuts = np.flatnonzero(np.diff(parts[order])) + 1
            names, blobs = [], []
            for own in np.split(order, cuts):
                own_texts = [texts[i] for i in own]
                sizes = np.fromiter(map(len, own_texts), np.int64, len(own_texts))
                names.append(int(parts[own[0]]))
                blobs.append(pack(*(x[own].astype(np.int64) for x in longs), sizes, np.frombuffer(b"".join(own_texts), np.uint8)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["part", "texts"])

    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    longs = [x.alias(f"n{i}") for i, x in enumerate((ids, *numbers))]
    return docs.select(F.col(text_col).cast("string").alias("text"), part.cast("int").alias("part"), *longs).mapInArrow(run, "part int, texts binary")


def unpacked_rows(blobs: pa.ChunkedArray) -> Iterator[tuple]:
    """The (ids, numbers..., texts) of each blob."""
    for blob in blobs:
        *longs, sizes, raw = unpack(blob.as_py())
        raw, ends = raw.tobytes(), np.cumsum(sizes).tolist()
        yield *longs, [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def unpacked_texts(blobs: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """The (ids, texts) of each blob."""
    for ids, *_, texts in unpacked_rows(blobs):
        yield ids, texts


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_STEP = 0xD6E8FEB86659FD93
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            steps = [np.full(size, x, np.uint64) for x in (_STEP, pow(_STEP, -1, 1 << 64))]
            for s in steps:
                s[0] = 1
            _POWERS[size] = tuple(np.multiply.accumulate(s) for s in steps)
    return _POWERS[size]


def word_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' words in order, and the number of words of each text.

    Words are runs of bytes other than ASCII white space. The hash is polynomial over random byte values,
    modulo 2**64, finalized.
    """
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[buf]
    edge = np.diff(np.concatenate(([True], space)).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text_ends = np.cumsum(sizes + 1) - 1
    upto = np.searchsorted(starts, text_ends)
    return hashes, np.diff(np.concatenate(([0], upto)))
