"""A PDF parser's web service as a data source: ``spark.read.format("parsed_pdfs").option("url", ...).load(folder)``."""

from __future__ import annotations

import math
import time
import urllib.request
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from quotewright.sources.pool import in_order, retried, share

# The service's paths and the form fields of a full-text request.
ALIVE, FULL_TEXT = "/api/isalive", "/api/processFulltextDocument"
FORM = {"consolidateHeader": "1", "consolidateCitations": "0", "includeRawCitations": "0", "teiCoordinates": "0"}
SCHEMA = "paper_id string, path string, xml string, error string, tries int, seconds double"


@dataclass(frozen=True)
class ParserService:
    """A client that can be shipped: calling it with the bytes of a PDF gives its TEI."""

    url: str
    timeout: float = 180.0

    def alive(self) -> bool:
        try:
            with urllib.request.urlopen(self.url.rstrip("/") + ALIVE, timeout=10) as answer:
                return answer.status == 200 and answer.read().strip().lower() == b"true"
        except OSError:
            return False

    def __call__(self, content: bytes, name: str = "paper.pdf") -> str:
        mark = uuid.uuid4().hex
        parts = [f'--{mark}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in FORM.items()]
        head = f'--{mark}\r\nContent-Disposition: form-data; name="input"; filename="{name}"\r\nContent-Type: application/pdf\r\n\r\n'
        body = b"".join([*parts, head.encode(), content, f"\r\n--{mark}--\r\n".encode()])
        request = urllib.request.Request(self.url.rstrip("/") + FULL_TEXT, body, {"Content-Type": f"multipart/form-data; boundary={mark}"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return answer.read().decode("utf-8", "replace")


@dataclass
class Files(InputPartition):
    """What one task parses, with how many threads."""

    paths: tuple[str, ...]
    threads: int


class ParserReader(DataSourceReader):
    """Plans the folder's files over tasks; filters on ``paper_id`` and ``path`` choose files before any is read."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.folder, self.service = options["path"], ParserService(options["url"], float(options.get("timeout", 180)))
        self.limit = int(options.get("maxConcurrency", 1))
        self.per_task = int(options.get("filesPerTask", 1000))
        self.attempts, self.wait, self.longest = int(options.get("attempts", 3)), float(options.get("wait", 2)), float(options.get("longestWait", 30))
        self.ready = float(options.get("readyWait", 0))
        self.asked: list[tuple[str, frozenset | str]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In, StringStartsWith)) else None
            if name not in ("paper_id", "path"):
                yield f
            elif isinstance(f, StringStartsWith):
                self.asked.append((name, f.value))
            else:
                self.asked.append((name, frozenset(f.value if isinstance(f, In) else [f.value])))

    def _wanted(self, paper: str, path: str) -> bool:
        of = {"paper_id": paper, "path": path}
        return all(of[name].startswith(x) if isinstance(x, str) else of[name] in x for name, x in self.asked)

    def partitions(self) -> list[Files]:
        """Tasks of at most ``filesPerTask`` files, but as many as the limit allows to run at once; sorted by name.

        More tasks than the limit would exceed it where there are slots, so a longer folder has larger tasks.
        """
        system, root = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        found = [x.path for x in system.get_file_info(fs.FileSelector(root)) if x.is_file and x.path.lower().endswith(".pdf")]
        found = sorted(p for p in found if self._wanted(_stem(p), p))
        n = max(1, min(self.limit, math.ceil(len(found) / max(1, min(self.per_task, math.ceil(len(found) / self.limit))))))
        return [Files(tuple(found[i::n]), share(self.limit, n, i)) for i in range(n)]

    def read(self, part: Files) -> Iterator[pa.RecordBatch]:
        """A row a file: its TEI, or the error after the last try. A service that is down is waited for, up to ``readyWait``."""
        system = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder else fs.LocalFileSystem()

        def one(path: str) -> tuple:
            begin = time.monotonic()

            def ask() -> str:
                with system.open_input_stream(path) as file:
                    content = file.read()
                try:
                    return self.service(content, path.rsplit("/", 1)[-1])
                except OSError:  # the service can not be reached, or not in time
                    end = time.monotonic() + self.ready
                    while time.monotonic() < end and not self.service.alive():
                        time.sleep(min(1.0, self.ready))
                    raise

            xml, error, tries = retried(ask, self.attempts, self.wait, self.longest)
            return _stem(path), path, xml, error, tries, time.monotonic() - begin

        kinds = [pa.string()] * 4 + [pa.int32(), pa.float64()]
        names = ["paper_id", "path", "xml", "error", "tries", "seconds"]
        for row in in_order(part.paths, one, part.threads):
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)


def _stem(path: str) -> str:
    return path.rsplit("/", 1)[-1][: -len(".pdf")]


class ParsedPdfs(DataSource):
    """Options: ``url`` (needed), ``maxConcurrency`` (calls open at once over all tasks, 1), ``filesPerTask`` (1000), ``attempts`` (3),
    ``wait`` and ``longestWait`` (seconds between tries, doubling from 2 to 30), ``timeout`` (180), ``readyWait`` (0)."""

    @classmethod
    def name(cls) -> str:
        return "parsed_pdfs"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ParserReader:
        if "url" not in self.options or "path" not in self.options:
            raise ValueError("parsed_pdfs needs a folder and the option url")
        return ParserReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ParsedPdfs)
