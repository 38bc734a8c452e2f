"""Workbooks, staged files, the registry between writers, the seeded draw, TEI blocks in SQL, papers with a state each."""

import os
import random
import sys
import threading
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quotewright.functions.records import REGISTRY
from quotewright.operators import blocks, registry, sheet
from quotewright.plans import batch
from quotewright.sources import boundary, tables, tei, xlsx
from quotewright.streaming import incremental, papers

cloudpickle.register_pickle_by_value(sys.modules[__name__])
M = f"{{{xlsx.MAIN}}}"


def workbook(path):
    """name -> (widths, rows) of a spreadsheet file."""
    with zipfile.ZipFile(path) as book:
        assert book.testzip() is None
        names = [s.get("name") for s in ET.fromstring(book.read("xl/workbook.xml")).iter(f"{M}sheet")]
        out = {}
        for i, name in enumerate(names, 1):
            root = ET.fromstring(book.read(f"xl/worksheets/sheet{i}.xml"))
            cells = ([("".join(c.itertext()) or None) if c.get("t") == "inlineStr" else c.findtext(f"{M}v") for c in row] for row in root.iter(f"{M}row"))
            out[name] = [int(c.get("width")) for c in root.iter(f"{M}col")], list(cells)
        return out


def test_workbook_is_read_back(spark, tmp_path):
    rows = [("é <&> \x01\n", 1, 1.5, True), (None, None, float("nan"), False), ("x" * 70, -2, 0.0, None)]
    df = spark.createDataFrame(rows, "text string, n int, `a & b` double, flag boolean").coalesce(1)
    path = str(tmp_path / "s.xlsx")
    for _ in range(2):  # a second one takes the first one's place
        tables.write_workbook(df, path, 'a "b"')
    assert workbook(path) == {'a "b"': ([60, 6, 7, 7], [["text", "n", "a & b", "flag"], ["é <&> \n", "1", "1.5", "1"], [None, None, "nan", "0"], ["x" * 70, "-2", "0.0", None]])}
    assert os.listdir(tmp_path) == ["s.xlsx"]  # no fragments stay


def test_rows_keep_their_order_over_tasks_and_worksheets(spark, tmp_path):
    xlsx.register(spark)
    df = spark.range(0, 1000, 1, 7).select("id", F.repeat(F.lit("y"), F.when(F.col("id") >= 500, 50).otherwise(3)).alias("y"))
    df.write.format("xlsx").option("rowsPerSheet", "301").mode("overwrite").save(str(tmp_path / "t.xlsx"))
    found = workbook(str(tmp_path / "t.xlsx"))
    ids = [int(r[0]) for _, rows in found.values() for r in rows[1:]]
    assert ids == list(range(1000)) and all(len(rows) <= 301 and rows[0] == ["id", "y"] for _, rows in found.values())
    assert {tuple(w) for w, _ in found.values()} == {(5, 5)}  # the first 500 rows alone set widths
    df.limit(0).write.format("xlsx").mode("overwrite").save(str(tmp_path / "none.xlsx"))
    assert workbook(str(tmp_path / "none.xlsx"))["Sheet1"] == ([4, 3], [["id", "y"]])


def registered(spark, *ids, **paths):
    rows = [{"record_id": i, "fulltext_status": "done", "extraction_status": "pending", "fulltext": {"pdf_path": paths.get(i[-1])}} for i in ids]
    return spark.createDataFrame(rows, REGISTRY)


def test_files_are_staged_and_skips_reported(spark, tmp_path):
    (tmp_path / "lib").mkdir()
    for name in ("a", "b"):
        (tmp_path / "lib" / f"{name}.pdf").write_text(name)
    reg = registered(spark, "doi:a", "doi:b", "doi:c", "doi:d", "doi/d", a="lib/a.pdf", b=str(tmp_path / "lib" / "b.pdf"), c="lib/gone.pdf")
    got = {r.record_id: r for r in registry.stage_pdfs(registry.pending(reg), str(tmp_path), str(tmp_path / "out")).collect()}
    assert {k: (r.staged, r.copied) for k, r in got.items()} == {"doi:a": (True, True), "doi:b": (True, True), "doi:c": (False, False), "doi:d": (False, False), "doi/d": (False, False)}
    assert got["doi:c"].message == f"! registry: PDF nao encontrado para doi:c: {tmp_path}/lib/gone.pdf -- pulando." and got["doi:d"].message.endswith("sem pdf_path -- pulando.")
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {"doi_a.pdf": "a", "doi_b.pdf": "b"}
    (tmp_path / "lib" / "a.pdf").write_text("newer")
    again = {r.record_id: r for r in registry.stage_pdfs(registry.pending(reg), str(tmp_path), str(tmp_path / "out")).collect()}
    assert (again["doi:a"].staged, again["doi:a"].copied) == (True, False) and (tmp_path / "out" / "doi_a.pdf").read_text() == "a"


def test_two_writers_keep_both_updates(spark, tmp_path):
    path = str(tmp_path / "reg")
    assert tables.write_registry(registered(spark, *(f"r{i}" for i in range(6))), path) == 1
    start, tries, numbers = threading.Barrier(3), [], []

    def mark(i):
        updates = spark.createDataFrame([(f"r{i}", "failed", None, None, None)], "record_id string, status string, checkpoint_path string, n_models_extracted int, needs_review boolean")

        def change(reg):
            tries.append(i)
            if tries.count(i) == 1:
                start.wait(60)  # all have read version 1
            return registry.mark_status(reg, updates)

        numbers.append(tables.update_registry(spark, path, change))

    threads = [threading.Thread(target=mark, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    assert sorted(numbers) == [2, 3, 4] and len(tries) > 3
    got = {r.record_id: r.extraction_status for r in tables.read_registry(spark, path).collect()}
    assert got == {f"r{i}": "failed" if i < 3 else "pending" for i in range(6)}
    kept = [p for p in os.listdir(path) if p.startswith("v-")]
    assert len(kept) == 2  # the version before stays for its readers


def test_a_number_is_given_once(spark, tmp_path):
    path = str(tmp_path / "reg")
    tables.write_registry(registered(spark, "a"), path)
    with pytest.raises(tables.Conflict):
        tables._commit(spark, path, 1, "v-other")
    early = tables.read_registry(spark, path)
    batch.registry_update_at(spark, path, spark.createDataFrame([("a", "failed")], "record_id string, status string").selectExpr("*", "string(null) checkpoint_path", "int(null) n_models_extracted", "boolean(null) needs_review"))
    assert early.first().extraction_status == "pending" and tables.read_registry(spark, path).first().extraction_status == "failed"


def test_registry_of_an_older_layout(spark, tmp_path):
    (tmp_path / "v-1").mkdir()
    (tmp_path / "v-1" / "part-0.json").write_text('{"record_id":"a"}')
    (tmp_path / "_current").write_text("v-1")
    assert tables.read_registry(spark, str(tmp_path)).count() == 1
    assert tables.write_registry(tables.read_registry(spark, str(tmp_path)), str(tmp_path)) == 1 and tables.read_registry(spark, str(tmp_path)).count() == 1


@pytest.mark.parametrize("size", [100_000, 7])
def test_seeded_draw_is_the_generators(spark, monkeypatch, size):
    monkeypatch.setattr(sheet, "RANGE", size)
    df = spark.range(200).select("id", (F.col("id") * 37 % 199).alias("k"), (F.col("id") < 3).alias("needs_review"))
    rows = sheet.audit_sample(df, F.col("k"), seed=11)
    clean = sorted((i * 37 % 199, i) for i in range(3, 200))
    want = {clean[p][0] for p in random.Random(11).sample(range(197), k=sheet.audit_size(200) - 3)}
    assert {r.k for r in rows.collect() if r.audit_reason != "auto-flagged"} == want
    assert "Window [row_number() windowspecdefinition(k" not in rows._jdf.queryExecution().toString()


def test_tei_blocks_in_sql(spark):
    ns = 'xmlns="http://www.tei-c.org/ns/1.0"'
    figure = '<figure type="table"><label>1</label><head>Res</head><table><row><cell>m</cell></row><row><cell>rf</cell></row></table></figure><figure type="table"><head>lost</head></figure>'
    body = f"<div><head>É</head><p>x</p><div><p>y</p></div></div>{figure}"
    xml = f"<TEI {ns}><teiHeader><titleStmt><title>T</title></titleStmt><abstract><p>A</p></abstract></teiHeader><text><body>{body}</body></text></TEI>"
    files = spark.createDataFrame([("p", xml), ("bad", "<TEI"), ("none", None), ("empty", f"<TEI {ns}/>")], "paper_id string, xml string")
    tei.register(spark)
    files.createOrReplaceTempView("tei_files")
    got = spark.sql("SELECT f.paper_id, b.* FROM tei_files f, LATERAL tei_blocks(f.xml) b").collect()
    want = blocks.segment(tei.parse_papers(files).where("title IS NOT NULL")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and {r.kind for r in got} == {"fixed", "section", "table", "warning"}
    whole, short = tei.parse_papers(files).where("paper_id = 'p'").select(
        *(blocks.render(blocks.blocks_of(*(F.col(c) for c in ("title", "abstract", "sections", "tables", "empty_table_labels"))), notice=n) for n in (True, False))
    ).first()
    assert "AVISO DE PARSING" in whole and whole.startswith(short) and "AVISO" not in short


class Counting:
    """Notes each call in a file; fails for papers named ``flaky`` the first time, dies at ``stop`` while a file says so."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, prompt, strict):
        with open(f"{self.folder}/calls", "a") as f:
            f.write(prompt + "\n")
        calls = open(f"{self.folder}/calls").read().split("\n")
        if prompt == "stop" and os.path.exists(f"{self.folder}/killed"):
            os._exit(1)  # the worker dies, and the batch with it
        if prompt == "flaky" and calls.count(prompt) == 1:
            raise ValueError("busy")
        return f"answer to {prompt}"


def test_a_killed_stream_asks_no_paper_twice(spark, tmp_path):
    inbox, results, state = (str(tmp_path / n) for n in ("in", "results", "state"))
    (tmp_path / "in").mkdir()
    client = boundary.Remembering(Counting(str(tmp_path)), str(tmp_path / "answers"))

    def run():
        incremental.run_available(papers.requests(spark, inbox, results), papers.ask_batch(client, results, "{paper_id}"), state)

    (tmp_path / "in" / "1.json").write_text("\n".join(f'{{"paper_id":"{p}","source_text":"t"}}' for p in ("one", "two", "stop", "one")))
    (tmp_path / "killed").write_text("")
    with pytest.raises(Exception):  # noqa: B017  whatever the lost worker is reported as
        run()
    (tmp_path / "killed").unlink()
    run()  # the batch that died again: what was answered is not asked
    (tmp_path / "in" / "2.json").write_text('{"paper_id":"two","source_text":"again"}\n{"paper_id":"flaky","source_text":"t"}')
    for _ in range(3):  # results come back
        run()
    calls = (tmp_path / "calls").read_text().split()
    assert (calls.count("one"), calls.count("two"), calls.count("flaky")) == (1, 1, 2)
    assert {r.paper_id: r.raw for r in papers.answers(spark, results).collect()} == {p: f"answer to {p}" for p in ("one", "two", "stop", "flaky")}


def test_a_timer_asks_again(spark, tmp_path):
    inbox, results = str(tmp_path / "in"), str(tmp_path / "results")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"paper_id":"flaky","source_text":"t"}')
    work = papers.ask_batch(Counting(str(tmp_path)), results, "{paper_id}")
    query = papers.requests(spark, inbox, results, wait_ms=50).writeStream.foreachBatch(work).option("checkpointLocation", str(tmp_path / "s")).trigger(processingTime="100 milliseconds").start()
    try:
        for _ in range(90):
            if query.awaitTermination(1) or list((tmp_path / "results").glob("*/*.json")) and papers.answers(spark, results).count():
                break
    finally:
        query.stop()
    assert papers.answers(spark, results).first().raw == "answer to flaky" and (tmp_path / "calls").read_text().split() == ["flaky"] * 2
