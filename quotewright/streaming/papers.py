"""Papers that come in over time: each is asked for once, and again after a wait if that failed, by a state per paper.

Two folders feed the stream: papers, and the results of what was asked. The state says how far a paper is, so nothing that was
done is read again to find out what is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quotewright.sources import boundary, tables

#: An event: a paper with its text, or the result of its n-th asking, ``ok`` or not.
EVENT = "paper_id string, source_text string, ok boolean, raw string, error string"
REQUEST = "paper_id string, source_text string, attempt int"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PaperStates(StatefulProcessor):
    """new -> asked -> done, or failed: then asked again when a timer of ``wait_ms``, doubled at each failure, has run out, or at once
    if that is 0, up to ``attempts`` times. A paper that comes again is passed over; its text is kept until it is done or given up."""

    def __init__(self, attempts: int, wait_ms: int) -> None:
        self.attempts, self.wait_ms = attempts, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("paper", "stage string, attempt int, source_text string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stage, attempt, text = self.state.get() if self.state.exists() else ("new", 0, None)
        ask = False
        for row in (r for frame in rows for r in frame.itertuples(index=False)):
            if pd.isna(row.ok):
                if stage == "new":
                    stage, attempt, text, ask = "asked", 1, row.source_text, True
            elif stage == "asked" and row.ok:
                stage, text = "done", None
            elif stage == "asked" and attempt >= self.attempts:
                stage, text = "given up", None
            elif stage == "asked" and not self.wait_ms:
                attempt, ask = attempt + 1, True
            elif stage == "asked":
                stage = "failed"
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms * 2 ** (attempt - 1))
        self.state.update((stage, attempt, text))
        yield self._requests(key, text, attempt) if ask else self._requests()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stage, attempt, text = self.state.get()
        if stage == "failed":
            self.state.update(("asked", attempt + 1, text))
            yield self._requests(key, text, attempt + 1)
        else:
            yield self._requests()

    def _requests(self, key: tuple = (), text: str | None = None, attempt: int = 0) -> pd.DataFrame:
        row = [(key[0], text, attempt)] if key else []
        return pd.DataFrame(row, columns=["paper_id", "source_text", "attempt"]).astype({"attempt": "int32"})

    def close(self) -> None:
        pass


def requests(spark: SparkSession, papers: str, results: str, attempts: int = 3, wait_ms: int = 0) -> DataFrame:
    """The stream of what is to be asked (paper_id, source_text, attempt), from JSON files in the two folders.

    With ``wait_ms`` timers run, for which a query makes batches without end: then start it with a trigger of its own, not one
    that stops when all is read.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    for folder in (papers, results):
        tables.make_folder(spark, folder)
    read = lambda path: spark.readStream.schema(EVENT).option("recursiveFileLookup", "true").json(path)
    events = read(papers).select("paper_id", "source_text", F.lit(None).cast("boolean").alias("ok"), "raw", "error").unionByName(read(results))
    return events.where("paper_id IS NOT NULL").groupBy("paper_id").transformWithStateInPandas(PaperStates(attempts, wait_ms), REQUEST, "Append", "ProcessingTime" if wait_ms else "None")


def ask_batch(client: boundary.Client, results: str, template: str, limit: int = 1) -> Callable[[DataFrame, int], None]:
    """Work for a batch of requests: the answers, or errors, become a folder of results named by the batch.

    A batch that is worked again after a crash asks nothing if its folder is complete; with a
    :class:`boundary.Remembering` client it asks for what had no answer alone.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark, folder = batch.sparkSession, f"{results}/batch-{number:012d}"
        if tables.is_complete(spark, folder):
            return
        prompt = boundary.prompt_of(template, paper_id=F.col("paper_id"), source_text=F.col("source_text"))
        answers = boundary.ask(batch, prompt, client, wait=0.0, limit=limit)
        answers.select("paper_id", F.col("raw").isNotNull().alias("ok"), "raw", "error").write.mode("overwrite").json(folder)

    return work


def answers(spark: SparkSession, results: str) -> DataFrame:
    """(paper_id, raw): the answers so far."""
    return spark.read.schema(EVENT).option("recursiveFileLookup", "true").json(results).where("ok").select("paper_id", "raw")
