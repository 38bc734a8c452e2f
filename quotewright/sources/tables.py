"""Checkpoints, screenings, registry and sheets in storage."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.records import CHECKPOINT, PARTIAL_CHECKPOINT, REGISTRY, SCREENING
from quotewright.sources import xlsx


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.mkdirs(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a folder has been written to its end."""
    return _exists(spark, f"{path}/_SUCCESS")


def _read_json(spark: SparkSession, path: str, schema: T.StructType, partial: bool) -> DataFrame:
    """Files of one document each, or the JSON Lines that :func:`write_documents` writes; a folder of these is of one kind.

    What is not JSON gives no row; a missing folder gives none at all.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    name, written = F.col("_metadata.file_name"), r"^part-\d{5}-"
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").where(~name.rlike(written) & (name.endswith(".partial.json") == F.lit(partial)))
    lines = spark.read.text(path, pathGlobFilter="part-*.json").where(name.rlike(written))
    rows = files.unionByName(lines).select(F.from_json("value", schema).alias("d"))
    return rows.where("d.paper_id IS NOT NULL").select("d.*")


def append_batch(df: DataFrame, path: str) -> None:
    """Adds a numbered folder to a table of batches."""
    spark = df.sparkSession
    known = [name for name in _folders(spark, path) if name.startswith("batch=")]
    df.write.parquet(f"{path}/batch={1 + max((int(n[6:]) for n in known), default=0):06d}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "paper_id") -> DataFrame:
    """A table of batches: of a key's rows those of its last batch. A missing table is empty."""
    empty = spark.createDataFrame([], schema)
    if not _folders(spark, path):
        return empty
    rows = spark.read.schema(T.StructType([*empty.schema, T.StructField("batch", T.IntegerType())])).parquet(path)
    last = rows.groupBy(key).agg(F.max("batch").alias("batch"))
    return rows.join(last, [key, "batch"], "left_semi").drop("batch")


def keep_batches(rows: DataFrame, path: str) -> None:
    """Leaves ``rows`` alone in a table of batches: they become its last batch, then the others go."""
    spark = rows.sparkSession
    old = _folders(spark, path)
    append_batch(rows, path)
    for name in old:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    if not _exists(spark, path):
        return []
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    return [f.getPath().getName() for f in found if f.isDirectory()]


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, CHECKPOINT, partial=False)


def read_partial_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, PARTIAL_CHECKPOINT, partial=True)


def read_screenings(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, SCREENING, partial=False)


def unfinished(work: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """``work`` without what is done, unless it is to be done again."""
    return work if force else work.join(done.select("paper_id"), "paper_id", "left_anti")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines; blank and malformed lines and rows without an id are passed over; of an id's lines the last counts."""
    if not _exists(spark, path):
        return spark.createDataFrame([], REGISTRY)
    number, name = _version(spark, path)
    line = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.text(f"{path}/{name}" if name else path).withColumn("line", line)
    rows = lines.where(F.try_parse_json("value").isNotNull()).select("line", F.from_json("value", REGISTRY).alias("d"))
    rows = rows.where("d.record_id IS NOT NULL AND d.record_id <> ''")
    return rows.groupBy(F.col("d.record_id").alias("id")).agg(F.max_by("d", "line").alias("d")).select("d.*")


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    return lines.where((F.trim("value") != "") & F.try_parse_json("value").isNull())


#: The folder whose files, numbered from 1, name a registry's versions. A number is given once, to the writer that makes the file.
COMMITS = "_commits"


class Conflict(Exception):
    """Another writer has made the version that was to be made."""


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _version(spark: SparkSession, path: str) -> tuple[int, str]:
    """The number and the folder of a registry's newest version; 0 if it has none, with the folder that an older layout's file names."""
    if not _exists(spark, f"{path}/{COMMITS}"):
        return 0, _content(spark, f"{path}/_current") if _exists(spark, f"{path}/_current") else ""
    folder, fs = _place(spark, f"{path}/{COMMITS}")
    number = max((int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()), default=0)
    return number, _named(spark, path, number) if number else ""


def _named(spark: SparkSession, path: str, number: int) -> str:
    return _content(spark, f"{path}/{COMMITS}/{number:012d}")


def _content(spark: SparkSession, path: str) -> str:
    place, fs = _place(spark, path)
    file = fs.open(place)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
    file.close()
    return text


def _commit(spark: SparkSession, path: str, number: int, name: str) -> None:
    """Makes ``name`` version ``number``, in one step that succeeds for one writer: a rename that does not overwrite, or
    on a local disk, where a rename would look and then move, a link."""
    folder, fs = _place(spark, f"{path}/{COMMITS}")
    fs.mkdirs(folder)
    fresh, _ = _place(spark, f"{path}/{COMMITS}/_{name}")
    out = fs.create(fresh)
    out.write(bytearray(name, "ascii"))
    out.close()
    target, _ = _place(spark, f"{path}/{COMMITS}/{number:012d}")
    jvm = spark.sparkContext._jvm
    try:
        if fs.getUri().getScheme() == "file":
            os.link(fresh.toUri().getPath(), target.toUri().getPath())
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fresh, target, none)
    except Exception as e:
        if isinstance(e, FileExistsError) or fs.exists(target):
            raise Conflict(f"version {number} of {path} is there already") from e
        raise
    finally:
        fs.delete(fresh, False)


def write_registry(registry: DataFrame, path: str) -> int:
    """``registry`` as the newest version, whatever others wrote meanwhile; see :func:`update_registry`."""
    return update_registry(registry.sparkSession, path, lambda _: registry)


def update_registry(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], attempts: int = 10) -> int:
    """Writes what ``change`` makes of a registry as its next version, and gives its number.

    A version is a folder of its own, sorted by id, that a small numbered file names. Of two writers that started from one version, one gets
    the next number; the other drops its folder and changes the version that won, so both changes are kept. Readers find a whole version at any
    time; the folder of the one before stays for those that still read it, older ones go. :class:`Conflict` after ``attempts`` lost races.
    """
    for _ in range(attempts):
        number, before = _version(spark, path)
        name = f"v-{uuid.uuid4().hex}"
        try:
            change(read_registry(spark, path)).sort("record_id").write.json(f"{path}/{name}")
            _commit(spark, path, number + 1, name)
        except Exception as e:
            folder, fs = _place(spark, f"{path}/{name}")
            fs.delete(folder, True)
            if isinstance(e, Conflict) or _version(spark, path)[0] > number:  # what was read may have gone
                continue
            raise
        if number > 1:
            folder, fs = _place(spark, f"{path}/{_named(spark, path, number - 1)}")
            fs.delete(folder, True)
        return number + 1
    raise Conflict(f"{path}: {attempts} attempts met other writers")


def write_documents(df: DataFrame, path: str) -> None:
    """Checkpoints, partial ones or screenings as JSON, one line each."""
    df.write.mode("overwrite").json(path)


def write_sheet(df: DataFrame, path: str) -> None:
    """CSV with a header; a byte order mark opens the first column's name, so that spreadsheets read UTF-8."""
    first = df.columns[0]
    df.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").csv(path, header=True, escape='"')


def write_workbook(df: DataFrame, path: str, sheet: str = "metadados") -> None:
    """A spreadsheet file at ``path``; see :mod:`quotewright.sources.xlsx`."""
    xlsx.register(df.sparkSession)
    df.write.format("xlsx").option("sheetName", sheet).mode("overwrite").save(path)


def column_widths(df: DataFrame, rows: int = 500, most: int = 60) -> DataFrame:
    """(column, width) for a spreadsheet: the longest of the name and the first rows' values, plus 2, at most ``most``."""
    head = df.limit(rows)
    sizes = F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(4)).alias("n")) for c in df.columns))
    long = head.select(F.explode(sizes).alias("s")).groupBy("s.column").agg(F.max("s.n").alias("n"))
    return long.select("column", F.least(F.greatest("n", F.length("column")) + 2, F.lit(most)).alias("width"))


@dataclass(frozen=True)
class Profile:
    """Settings of a run. ``window_token_budget`` is kept for old files; nothing reads it."""

    name: str
    model: str
    api_base: str
    temperature_a: float = 0.1
    temperature_b: float = 0.4
    max_tokens: int = 8000
    min_num_ctx: int = 8000
    request_timeout_s: int = 900
    window_token_budget: int = 4000
    max_concurrency: int = 1
    fallback_budgets: tuple[int | None, ...] = (4000, 12000, None)
    arbiter_max_tokens: int = 1500
    arbiter_min_num_ctx: int = 8000

    def temperatures(self) -> tuple[float, float]:
        """Of the two extractions; the second is never cooler than 0.4."""
        return self.temperature_a, max(self.temperature_a, self.temperature_b, 0.4)

    def override(self, **given: object) -> Profile:
        """With the settings that are given; None leaves one as it is."""
        return replace(self, **{k: v for k, v in given.items() if v is not None})


def load_profile(name: str, folder: str) -> Profile:
    """``folder``/``name``.json on the driver; unknown keys are an error, a missing file names those there are."""
    path = Path(folder) / f"{name}.json"
    if not path.exists():
        raise FileNotFoundError(f"no profile {name!r} in {folder}; available: {sorted(p.stem for p in Path(folder).glob('*.json'))}")
    given = json.loads(path.read_text(encoding="utf-8"))
    if unknown := set(given) - {f.name for f in fields(Profile)}:
        raise ValueError(f"profile {name!r} has unknown keys: {sorted(unknown)}")
    if "fallback_budgets" in given:
        given["fallback_budgets"] = tuple(given["fallback_budgets"])
    return Profile(**{"name": name} | given)
