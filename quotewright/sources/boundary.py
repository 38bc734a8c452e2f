"""The boundary to outside services: a parser of PDF files, language models. Off unless a client is given.

A client is a function that can be shipped to executors. What it answers is stored before anything is derived from it, so a
lost executor repeats calls at most for the partitions it had not written.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.records import ARBITRATION, EXTRACTION, SCREENING, json_schema
from quotewright.sources.pool import in_order, share, spread

#: (prompt, strict) -> answer; strict asks for the schema, else for any JSON object.
Client = Callable[[str, bool], str]
ATTEMPTS, SHORTEST_WAIT, LONGEST_WAIT = 3, 2.0, 30.0
# What servers say that don't know schemas.
LOCAL_PREFIXES, SPARE_TOKENS = ("ollama/", "ollama_chat/"), 1024
SCHEMA_HINTS = ("response_format", "json_schema", "guided", "unsupported")


@dataclass(frozen=True)
class Settings:
    """What a client is made with."""

    model: str
    api_base: str
    temperature: float
    max_tokens: int
    request_timeout_s: int
    min_num_ctx: int
    #: extraction, screening or arbiter
    purpose: str = "extraction"


def wait_until_ready(alive: Callable[[], bool], most: float, every: float = 2.0) -> None:
    """Asks a service until it answers; a failure to ask counts as no. TimeoutError after ``most`` seconds."""
    end = time.monotonic() + most
    while True:
        try:
            if alive():
                return
        except Exception:  # noqa: BLE001
            pass
        if time.monotonic() >= end:
            raise TimeoutError(f"the service was not ready within {most:g} s")
        time.sleep(min(every, max(0.0, end - time.monotonic())))


def schema_unsupported(message: str) -> bool:
    return any(h in message.lower() for h in SCHEMA_HINTS)


def call(client: Client, prompt: str, attempts: int = ATTEMPTS, wait: float = SHORTEST_WAIT, any_error: bool = False) -> str:
    """Up to ``attempts`` tries with doubling waits. A server that rejects the schema is asked once more without it;
    ``any_error`` does so after every failure."""
    for attempt in range(attempts):
        try:
            try:
                return client(prompt, True)
            except Exception as e:
                if not any_error and not schema_unsupported(str(e)):
                    raise
                return client(prompt, False)
        except Exception:
            if attempt == attempts - 1:
                raise
            time.sleep(min(LONGEST_WAIT, wait * 2**attempt))
    raise AssertionError("no attempt")


def _calls(rows: DataFrame, work: Callable, made: list[tuple[str, T.DataType, pa.DataType]], limit: int) -> DataFrame:
    """``rows`` with what ``work`` makes of the last column's values, which is dropped, and the ``seconds`` each took.

    At most ``limit`` calls are open at once over all tasks, in the rows' order inside a task; Arrow batches are taken as results leave.
    """
    rows, parts = spread(rows, limit) if limit > 1 else (rows.repartition(1), 1)

    def timed(value: object) -> tuple:
        begin = time.monotonic()
        return *work(value), time.monotonic() - begin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        taken: deque[pa.RecordBatch] = deque()

        def values() -> Iterator[object]:
            for b in batches:
                if b.num_rows:
                    taken.append(b)
                    yield from (x.as_py() for x in b.column(b.num_columns - 1))

        results: list[tuple] = []
        for result in in_order(values(), timed, share(limit, parts, TaskContext.get().partitionId())):
            results.append(result)
            if len(results) == taken[0].num_rows:
                b = taken.popleft()
                arrays = [pa.array(x, k) for x, k in zip(zip(*results), [*(k for *_, k in made), pa.float64()])]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *arrays], [*b.schema.names[:-1], *(n for n, *_ in made), "seconds"])
                results = []

    new = [T.StructField(n, k) for n, k, _ in made] + [T.StructField("seconds", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *new]))


def ask(rows: DataFrame, prompt: Column, client: Client, wait: float = SHORTEST_WAIT, any_error: bool = False, limit: int = 1) -> DataFrame:
    """``rows`` with ``raw``, the client's answer to each prompt, or ``error``, and the ``seconds`` it took. One row's failure
    stops no other. Up to ``limit`` calls are open at once, over all tasks together."""

    def one(text: str | None) -> tuple[str | None, str | None]:
        try:
            return call(client, text or "", wait=wait, any_error=any_error), None
        except Exception as e:  # noqa: BLE001
            return None, str(e)

    made = [(n, T.StringType(), pa.string()) for n in ("raw", "error")]
    return _calls(rows.select("*", prompt.cast("string").alias("__prompt")), one, made, limit)


def prompt_of(template: str, **values: Column) -> Column:
    """A template with {names} filled in; other braces stay."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def criteria_block(criteria: dict[str, str]) -> str:
    return "\n".join(f"{code}: {said}" for code, said in criteria.items())


def parse_pdfs(files: DataFrame, parser: Callable[[bytes], str], limit: int = 1) -> DataFrame:
    """(paper_id, path, content) -> (paper_id, xml, seconds): the parser's TEI, null where it fails; up to ``limit`` calls at once."""

    def one(content: bytes | None) -> tuple[str | None]:
        try:
            return (parser(content),)
        except Exception:  # noqa: BLE001  one paper's failure stops no other
            return (None,)

    return _calls(files.select("paper_id", "content"), one, [("xml", T.StringType(), pa.string())], limit)


@dataclass(frozen=True)
class Remembering:
    """A :data:`Client` that keeps each answer in ``folder``, which executors share, before it gives it.

    A prompt that has been answered is not asked again, by whichever task or run: what is lost with an executor, or a
    killed run, are the calls that were open. Failures are not kept.
    """

    client: Client
    folder: str

    def __call__(self, prompt: str, strict: bool) -> str:
        system, folder = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        name = hashlib.sha256(prompt.encode()).hexdigest()
        place = f"{folder}/{name[:3]}/{name}"
        if system.get_file_info(place).type == fs.FileType.File:
            with system.open_input_stream(place) as file:
                return file.read().decode()
        answer = self.client(prompt, strict)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        fresh = f"{place}.{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as file:
            file.write(answer.encode())
        system.move(fresh, place)
        return answer


@dataclass(frozen=True)
class ChatClient:
    """A :data:`Client` of a chat completion service over HTTP, made from :class:`Settings` and the schema of its answers.

    Strict calls ask for the schema, others for any JSON object. Models of a local server that cuts prompts to its context get a
    context that holds the prompt, at three characters a token, and the answer.
    """

    settings: Settings
    schema_name: str
    schema: str
    system: str = ""

    def request(self, prompt: str, strict: bool) -> dict:
        s = self.settings
        shape = {"name": self.schema_name, "schema": json.loads(self.schema), "strict": True}
        messages = [{"role": r, "content": t} for r, t in (("system", self.system), ("user", prompt)) if t]
        body = {
            "model": s.model, "messages": messages, "temperature": s.temperature, "max_tokens": s.max_tokens,
            "response_format": {"type": "json_schema", "json_schema": shape} if strict else {"type": "json_object"},
        }
        if s.model.startswith(LOCAL_PREFIXES):
            size = sum(len(m["content"]) for m in messages) // 3
            body["num_ctx"] = max(s.min_num_ctx, size + s.max_tokens + SPARE_TOKENS)
        return body

    def __call__(self, prompt: str, strict: bool) -> str:
        place = self.settings.api_base.rstrip("/") + "/chat/completions"
        body = json.dumps(self.request(prompt, strict)).encode()
        asked = urllib.request.Request(place, body, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(asked, timeout=self.settings.request_timeout_s) as answer:
                return json.load(answer)["choices"][0]["message"]["content"]
        except urllib.error.HTTPError as e:  # the body says what the server does not know
            raise RuntimeError(f"{e.code}: {e.read().decode('utf-8', 'replace')[:2000]}") from e


def chat_client(settings: Settings) -> ChatClient:
    """A :class:`ChatClient` with the schema of what its purpose answers."""
    name, kind = {"extraction": ("paper_extraction", EXTRACTION), "screening": ("screening_result", SCREENING), "arbiter": ("arbiter_decision", ARBITRATION)}[settings.purpose]
    return ChatClient(settings, name, json.dumps(json_schema(kind)))
