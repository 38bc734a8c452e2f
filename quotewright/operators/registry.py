"""The work registry: what is pending, status updates, bibliographic columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.functions.records import EXTRACTION_STATUSES
from quotewright.functions.text import now_iso, paper_id_of
from quotewright.operators.screening import proceeds


def pending(registry: DataFrame) -> DataFrame:
    """Full text is there and extraction is still to do, or to do again."""
    return registry.where((F.col("fulltext_status") == "done") & F.col("extraction_status").isin("pending", "failed"))


def staging_map(todo: DataFrame) -> DataFrame:
    """(paper_id, record_id, pdf_path) of pending records with a path; of ids that clash once made safe the last stays."""
    rows = todo.where(F.coalesce(F.col("fulltext.pdf_path"), F.lit("")) != "").select("record_id", F.col("fulltext.pdf_path").alias("pdf_path"))
    rows = rows.withColumn("paper_id", paper_id_of(F.col("record_id")))
    return rows.groupBy("paper_id").agg(F.max_by("record_id", "record_id").alias("record_id"), F.max_by("pdf_path", "record_id").alias("pdf_path"))


# Why a record's file is not staged.
NO_PATH = "! registry: {} tem fulltext_status=done mas sem pdf_path -- pulando."
NO_FILE = "! registry: PDF nao encontrado para {}: {} -- pulando."


def stage_pdfs(todo: DataFrame, root: str, target: str) -> DataFrame:
    """Copies the files of pending records to ``target``/<paper_id>.pdf: (record_id, paper_id, pdf_path, staged, copied, message).

    Paths that are not absolute start at ``root``; folders may be local or named by a URI. A file that is there already stays and counts as staged.
    Records without a path or whose file is missing are rows with a message. Of ids that clash once made safe the last is
    staged, as in :func:`staging_map`. Copies are made by tasks, each under a name of its own that is moved at last, so a repeated task does no harm.
    Call an action once: each one looks at the files again.
    """
    text = F.coalesce(F.col("fulltext.pdf_path"), F.lit(""))
    rows = todo.select("record_id", paper_id_of(F.col("record_id")).alias("paper_id"), text.alias("pdf_path"))
    last = F.row_number().over(Window.partitionBy("paper_id").orderBy(F.desc(F.col("pdf_path") != ""), F.desc("record_id"))) == 1
    rows = rows.withColumn("mine", last & (F.col("pdf_path") != ""))

    def open_fs(path: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for record, paper, path, mine in zip(*(c.to_pylist() for c in b.columns)):
                source = path if path.startswith("/") or "://" in path else f"{root.rstrip('/')}/{path}"
                message, copied = None, False
                if not path:
                    message = NO_PATH.format(record)
                elif mine:
                    (from_, a), (to, z) = open_fs(source), open_fs(f"{target.rstrip('/')}/{paper}.pdf")
                    if from_.get_file_info(a).type != fs.FileType.File:
                        message = NO_FILE.format(record, source)
                    elif to.get_file_info(z).type != fs.FileType.File:
                        to.create_dir(z.rsplit("/", 1)[0], recursive=True)
                        fresh = f"{z}.{uuid.uuid4().hex}"
                        fs.copy_files(a, fresh, source_filesystem=from_, destination_filesystem=to)
                        to.move(fresh, z)
                        copied = True
                out.append((record, paper, path or None, bool(mine) and message is None, copied, message))
            kinds = [pa.string()] * 3 + [pa.bool_()] * 2 + [pa.string()]
            names = ["record_id", "paper_id", "pdf_path", "staged", "copied", "message"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names)

    return rows.mapInArrow(run, "record_id string, paper_id string, pdf_path string, staged boolean, copied boolean, message string")


def paper_rollup(sheet: DataFrame) -> DataFrame:
    return sheet.groupBy("paper_id").agg(F.count("*").cast("int").alias("n_models_extracted"), F.bool_or("needs_review").alias("needs_review"))


def derive_status(staged: DataFrame, checkpoints: DataFrame, screenings: DataFrame, rollup: DataFrame, strict: bool = False) -> DataFrame:
    """(record_id, status, checkpoint_path, n_models_extracted, needs_review) for each staged paper.

    Done with a checkpoint; else not applicable if screened; else failed. ``strict`` asks that the screening excluded it.
    """
    done = checkpoints.select("paper_id", F.lit(True).alias("done")).distinct()
    screened = screenings.where(~proceeds(F.col("decision"))) if strict else screenings
    screened = screened.select("paper_id", F.lit(True).alias("screened")).distinct()
    rows = staged.join(done, "paper_id", "left").join(screened, "paper_id", "left").join(rollup, "paper_id", "left")
    is_done = F.coalesce("done", F.lit(False))
    status = F.when(is_done, "done").when(F.coalesce("screened", F.lit(False)), "not_applicable").otherwise("failed")
    return rows.select(
        "record_id",
        status.alias("status"),
        F.when(is_done, F.concat("paper_id", F.lit(".json"))).alias("checkpoint_path"),
        F.when(is_done, F.coalesce("n_models_extracted", F.lit(0))).alias("n_models_extracted"),
        F.when(is_done, F.coalesce("needs_review", F.lit(False))).alias("needs_review"),
    )


def status_counts(updates: DataFrame) -> DataFrame:
    return updates.agg(*(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("done", "not_applicable", "failed")))


def mark_status(registry: DataFrame, updates: DataFrame, now: Column | None = None) -> DataFrame:
    """``registry`` with ``updates`` applied: unknown ids and statuses are passed over, the extraction block is set by 'done'
    alone. Of several updates of a record the one with the largest ``update_order``, if that column is there, prevails.
    """
    now = now_iso() if now is None else now
    valid = updates.where(F.col("status").isin(*EXTRACTION_STATUSES))
    order = F.col("update_order") if "update_order" in updates.columns else F.lit(0)
    names = ("status", "checkpoint_path", "n_models_extracted", "needs_review")
    last = valid.groupBy("record_id").agg(
        F.max_by(F.struct(*names), order).alias("u"),
        F.max_by(F.struct(*names[1:]), F.when(F.col("status") == "done", order)).alias("d"),
        F.bool_or(F.col("status") == "done").alias("was_done"),
    )
    rows = registry.join(last, "record_id", "left")
    hit, kind = F.col("u").isNotNull(), registry.schema["extraction"].dataType
    block = F.struct(F.col("d.checkpoint_path"), F.col("d.n_models_extracted").cast("int"), F.col("d.needs_review"), now.alias("extracted_at")).cast(kind)
    return rows.withColumns(
        {
            "extraction_status": F.when(hit, F.col("u.status")).otherwise(F.col("extraction_status")),
            "extraction": F.when(F.coalesce("was_done", F.lit(False)), block).otherwise(F.col("extraction")),
            "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
        }
    ).select(*registry.columns)


def merge_bibliography(sheet: DataFrame, ids: DataFrame, registry: DataFrame) -> DataFrame:
    """``sheet`` with its bibliographic columns from the registry, by ``ids`` (paper_id, record_id); others stay as they are."""
    text = lambda c: F.coalesce(c, F.lit(""))
    fields = {"doi": "doi"} | {k.capitalize(): f"metadata.{k}" for k in ("year", "author", "journal", "country", "latitude", "longitude")}
    found = ids.join(registry, "record_id").select("paper_id", F.struct(*(text(F.col(f)).alias(c) for c, f in fields.items())).alias("_b"))
    rows = sheet.join(found, "paper_id", "left")
    new = {c: F.when(F.col("_b").isNotNull(), F.col(f"_b.{c}")).otherwise(F.col(c)) for c in fields}
    return rows.withColumns(new).select(*(f"`{c}`" for c in sheet.columns))
