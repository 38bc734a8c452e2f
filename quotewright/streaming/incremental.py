"""Incremental runs: what is new is read once, worked off and merged into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_available(source: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands what a stream has that was not handed over before to ``work`` (batch, number), then stops.

    The stream's own checkpoint remembers what is done, so a run that is interrupted goes on where it was.
    """
    query = source.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def new_documents(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", glob: str | None = None) -> DataFrame:
    """A stream of the files in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def append_new(target: str, key: str) -> Callable[[DataFrame, int], None]:
    """Work that appends the rows of a batch whose key the Parquet table ``target`` lacks; a repeated batch adds nothing."""

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        try:
            known = spark.read.parquet(target).select(F.col(key).alias("_known"))
            fresh = fresh.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("append").parquet(target)

    return work
