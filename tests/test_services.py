"""Services over HTTP, played by a small server: the parser as a data source, chat requests, and limits on open calls."""

import json
import sys
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quotewright.functions.records import EXTRACTION, json_schema
from quotewright.plans import batch
from quotewright.sources import boundary, pool, service
from quotewright.sources.tables import Profile

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Handler(BaseHTTPRequestHandler):
    """``flaky`` files fail at first, ``broken`` ones always; every request is noted."""

    def log_message(self, *args):
        pass

    def said(self, code, body):
        self.send_response(code)
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):
        self.said(200, b"true\n")

    def do_POST(self):
        begin, body = time.monotonic(), self.rfile.read(int(self.headers["Content-Length"]))
        notes = self.server.notes
        if self.path == "/chat/completions":
            asked = json.loads(body)
            notes.append(asked)
            if asked["response_format"]["type"] == "json_schema" and asked["model"] == "plain":
                return self.said(400, b"response_format is unknown here")
            return self.said(200, json.dumps({"choices": [{"message": {"content": asked["messages"][-1]["content"].upper()}}]}).encode())
        name = body.split(b'filename="')[1].split(b'"')[0].decode()
        time.sleep(self.server.slow)
        notes.append((name, begin, time.monotonic()))
        times = sum(n[0] == name for n in notes)
        if name.startswith("broken") or (name.startswith("flaky") and times == 1):
            return self.said(503, b"busy")
        self.said(200, f"<TEI>{name} {b'consolidateHeader' in body} {body.count(b'%PDF')}</TEI>".encode())


@pytest.fixture
def server():
    found = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    found.notes, found.slow = [], 0.0
    threading.Thread(target=found.serve_forever, daemon=True).start()
    found.url = f"http://127.0.0.1:{found.server_port}"
    yield found
    found.shutdown()


@pytest.fixture
def folder(tmp_path):
    for name in ("a1", "a2", "b1", "flaky1", "broken1"):
        (tmp_path / f"{name}.pdf").write_bytes(b"%PDF " + name.encode())
    (tmp_path / "notes.txt").write_text("no paper")
    return str(tmp_path)


def reader(spark, server, **options):
    service.register(spark)
    return spark.read.format("parsed_pdfs").options(url=server.url, wait="0", **options)


def open_at_once(notes):
    return max(sum(b <= begin < e for _, b, e in notes) for _, begin, _ in notes)


def test_folder_is_parsed_with_retries(spark, server, folder):
    got = {r.paper_id: r for r in reader(spark, server, maxConcurrency="3").load(folder).collect()}
    assert sorted(got) == ["a1", "a2", "b1", "broken1", "flaky1"]
    assert got["a1"].xml == "<TEI>a1.pdf True 1</TEI>" and (got["a1"].tries, got["flaky1"].tries, got["broken1"].tries) == (1, 2, 3)
    assert got["broken1"].xml is None and "503" in got["broken1"].error and got["flaky1"].error is None
    assert got["a1"].seconds >= 0


def test_filters_choose_files_before_they_are_sent(spark, server, folder):
    rows = reader(spark, server).load(folder)
    assert [r.paper_id for r in rows.where("paper_id = 'b1'").collect()] == ["b1"]
    assert sorted(r.paper_id for r in rows.where("paper_id LIKE 'a%'").collect()) == ["a1", "a2"]
    assert rows.where(F.col("paper_id").isin("a1", "gone")).where("tries = 1").count() == 1  # the second is Spark's own
    assert sorted(n for n, *_ in server.notes) == ["a1.pdf", "a1.pdf", "a2.pdf", "b1.pdf"]
    assert rows.where("paper_id = 'gone'").count() == 0


def test_options_are_asked_for(spark, server, folder):
    with pytest.raises(Exception, match="needs a folder and the option url"):
        service.register(spark) or spark.read.format("parsed_pdfs").load(folder).collect()


def test_limit_of_the_source_holds_over_all_tasks(spark, server, tmp_path):
    for i in range(12):
        (tmp_path / f"p{i:02}.pdf").write_bytes(b"%PDF")
    server.slow = 0.4
    assert reader(spark, server, maxConcurrency="3").load(str(tmp_path)).count() == 12
    assert open_at_once(server.notes) == 3


@pytest.mark.parametrize(("limit", "rounds"), [(4, 3), (6, 2), (1, 12)])
def test_twelve_slow_calls(spark, server, limit, rounds):
    """A limit over the slots is made up by threads, one under them by fewer tasks."""
    server.slow, url = 0.5, server.url

    def slow(prompt, strict):
        return service.ParserService(url)(b"%PDF", prompt)

    rows = spark.range(12).select(F.concat(F.lit("p"), F.col("id")).alias("p"))
    got = boundary.ask(rows, F.col("p"), slow, limit=limit).collect()
    assert {r.raw for r in got} == {f"<TEI>p{i} True 1</TEI>" for i in range(12)} and all(r.seconds >= 0.5 for r in got)
    assert open_at_once(server.notes) == limit
    took = max(e for *_, e in server.notes) - min(b for _, b, _ in server.notes)
    assert rounds * 0.5 <= took < (rounds + 2) * 0.5 + 2


def test_order_and_pressure_of_the_pool():
    taken = []

    def items():
        for i in range(40):
            taken.append(i)
            yield i

    out = pool.in_order(items(), lambda i: time.sleep(0.01 * (i % 3)) or i, 4)
    assert next(out) == 0 and len(taken) <= 9  # eight, and one for the result that left
    assert list(out) == list(range(1, 40))
    assert [pool.share(7, 3, i) for i in range(3)] == [3, 2, 2] and pool.share(2, 4, 3) == 1


def test_answers_stay_with_their_rows_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = boundary.ask(spark.range(100), F.col("id"), lambda p, strict: f"answer {p}", limit=6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.id, r.raw) for r in got) == [(i, f"answer {i}") for i in range(100)]


def test_chat_requests(server):
    made = []
    profile = Profile("t", "ollama/m", server.url, max_tokens=50, min_num_ctx=100)
    batch.clients_of(lambda s: made.append(boundary.chat_client(s)) or made[-1], profile)
    a, b, judge, screen = made
    assert boundary.call(a, "x" * 3000) == "X" * 3000
    asked = server.notes[-1]
    assert asked["num_ctx"] == 3000 // 3 + 50 + 1024 and asked["max_tokens"] == 50 and asked["temperature"] == 0.1
    assert asked["response_format"]["json_schema"]["schema"]["properties"]["records"]["items"]["properties"]["model_class"]["enum"][0] == "logistic_regression"
    assert (a.schema_name, judge.schema_name, screen.schema_name) == ("paper_extraction", "arbiter_decision", "screening_result")
    assert (b.settings.temperature, judge.settings.temperature) == (0.4, 0.0)
    plain = boundary.chat_client(boundary.Settings("plain", server.url, 0.0, 9, 5, 8000))
    assert boundary.call(plain, "y") == "Y" and server.notes[-1]["response_format"] == {"type": "json_object"} and "num_ctx" not in server.notes[-1]


def test_schema_export():
    found = json_schema(EXTRACTION)
    assert found["required"] == ["paper_id", "records", "extraction_warnings"]
    record = found["properties"]["records"]["items"]
    assert record["properties"]["auc"]["properties"]["quote"] == {"type": ["string", "null"]} and record["properties"]["baseline"]["enum"] == ["yes", "no", "not_reported", None]


def test_directory_run_over_the_service(spark, server, tmp_path):
    (tmp_path / "pdfs").mkdir()
    (tmp_path / "pdfs" / "one.pdf").write_bytes(b"%PDF")
    server.slow = 0.1
    record = {"records": [{"model_used": {"value": "RF", "quote": "RF"}}]}
    clients = batch.Clients(lambda p, s: json.dumps(record), lambda p, s: json.dumps(record), wait=0.0)
    parser = service.ParserService(server.url)
    batch.run_directory(spark, str(tmp_path / "pdfs"), parser, clients, Profile("t", "m", "u", fallback_budgets=(None,), max_concurrency=2), str(tmp_path / "out"), alive=parser.alive)
    done = spark.read.parquet(str(tmp_path / "out" / "checkpoints")).first()
    assert done.timing.grobid_s >= 0.1 and done.timing.total_s >= done.timing.grobid_s
