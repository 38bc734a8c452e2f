"""Whole runs with clients that answer from the prompt."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quotewright.functions.records import REGISTRY, SCREENING
from quotewright.plans import batch
from quotewright.sources import boundary, tables
from quotewright.sources.tables import Profile

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have the tests

EVIDENCE = ("model_used", "sample_size", "default_rate", "variables_used", "auc", "accuracy", "f1_score", "recall", "specificity", "standard_deviation", "standard_error")


def answer(model, auc, quote):
    record = {f: {"value": None} for f in EVIDENCE} | {f: "no" for f in ("baseline", "financial", "productive", "climatic", "hybrid")}
    record |= {"model_used": {"value": model, "quote": model}, "auc": {"value": auc, "quote": quote}}
    return json.dumps({"records": [record]})


def extract_a(prompt, strict):
    if prompt.startswith("broken"):
        return "no json"
    if "deep result" not in prompt:
        return '{"records": []}'
    return answer("Random Forest", "0.91", "AUC of 0.91")


def extract_b(prompt, strict):
    return answer("Random Forest", "0.71", "AUC of 0.71")


def screen(prompt, strict):
    if strict:
        raise ValueError("response_format unsupported")
    if prompt.startswith("fails"):
        raise ValueError("down")
    return json.dumps({"decision": "exclude" if prompt.startswith("out") else "include_review_only", "justification": "j"})


def arbiter(prompt, strict):
    return '```json\n{"decisions": [{"field_name": "auc", "choice": "a"}]}\n```'


def papers(spark, *ids):
    kind = "paper_id string, title string, abstract string, sections array<struct<header:string,text:string>>, tables array<struct<label:string,caption:string,text:string>>, empty_table_labels array<string>"
    body = [{"header": "Results", "text": "AUC accuracy " + "words " * 40}, {"header": "Late", "text": "deep result with an AUC of 0.91 for the Random Forest " + "filler " * 300}]
    return spark.createDataFrame([(i, "T", "A", body, [], []) for i in ids], kind)


CLIENTS = batch.Clients(extract_a, extract_b, screen, arbiter, wait=0.0)
PROFILE = Profile("t", "m", "u", fallback_budgets=(120, None))


def test_run_from_papers_to_sheet(spark, tmp_path):
    done = batch.process_papers(papers(spark, "one", "out", "broken", "fails"), CLIENTS, PROFILE, str(tmp_path))
    got = {r.paper_id: r for r in done.collect()}
    assert set(got) == {"one", "fails"}  # a failed screening lets its paper pass, a failed extraction does not
    one = got["one"]
    assert one.fallback_level == 1 and one.extraction_a.records[0].auc.value == "0.91" and one.extraction_b.records[0].auc.value == "0.71"
    assert [(r.field_name, r.choice) for r in one.arbiter_resolutions] == [("auc", "a")] and not one.record_count_mismatch
    assert one.verifications[0].all_verified and one.extraction_reconciled.records[0].extraction_notes == "[arbitro: auc<-a]"
    assert one.timing.total_s >= one.timing.extraction_a_s >= 0
    sheet = batch.consolidate_run(done, tables.read_batches(spark, f"{tmp_path}/screening", SCREENING), str(tmp_path)).collect()
    summary = batch.run_summary(papers(spark, "one", "out", "broken", "fails"), done, tables.read_batches(spark, f"{tmp_path}/screening", SCREENING)).first()
    assert (summary.papers, summary.processed, summary.excluded, summary.screened_not_processed, summary.failed, summary.records) == (4, 2, 1, 1, 1, 2)
    assert [(r.AUC, r.needs_review, r.arbiter_resolved_fields) for r in sheet] == [("0.91", False, "auc")] * 2
    assert all((tmp_path / f"{n}.csv").exists() for n in ("metadados_extraidos", "auditoria_amostra", "triagem_prisma"))
    report = batch.compare_folders(spark, str(tmp_path), str(tmp_path)).collect()
    assert [(r.records_a, r.divergent_fields_b, r.arbiter_resolved_a) for r in report] == [(1, 1, 1)] * 2


def test_run_from_registry(spark, tmp_path):
    rows = [{"record_id": f"doi:{n}", "doi": n, "fulltext_status": "done", "extraction_status": "pending", "fulltext": {"pdf_path": "p"}, "metadata": {"year": "2020"}} for n in ("one", "out")]
    reg = spark.createDataFrame(rows, REGISTRY)
    clients = batch.Clients(extract_a, extract_b, lambda p, s: screen(p.removeprefix("doi_"), s), None, wait=0.0)
    sheet, after = batch.registry_run(reg, papers(spark, "doi_one", "doi_out", "doi_other"), clients, PROFILE, str(tmp_path))
    assert [(r.paper_id, r.Year, r.needs_review) for r in sheet.collect()] == [("doi_one", "2020", True)]
    got = {r.record_id: r for r in after.collect()}
    assert got["doi:one"].extraction_status == "done" and got["doi:one"].extraction.n_models_extracted == 1 and got["doi:out"].extraction_status == "not_applicable"


def test_calls_are_tried_again():
    seen = []

    def flaky(prompt, strict):
        seen.append(strict)
        if len(seen) < 3:
            raise OSError("reset")
        return "ok"

    assert boundary.call(flaky, "p", wait=0.0) == "ok" and seen == [True, True, True]
    with pytest.raises(OSError):
        boundary.call(lambda p, s: (_ for _ in ()).throw(OSError("down")), "p", wait=0.0)


def test_prompts(spark):
    text = boundary.prompt_of("{a} {b} {c}", a=F.lit("x"), b=F.lit(None))
    assert spark.range(1).select(text).first()[0] == "x  {c}" and boundary.criteria_block({"I1": "y", "I2": "z"}) == "I1: y\nI2: z"


def counting(log, answer):
    def ask(prompt, strict):
        with open(log, "a") as f:
            f.write(prompt.split("\n")[0] + "\n")
        return answer(prompt, strict)

    return ask


def asked(log):
    return sorted(log.read_text().split()) if log.exists() else []


def test_a_run_is_taken_up_again(spark, tmp_path):
    logs = {n: tmp_path / n for n in "abs"}
    down = tmp_path / "down"
    down.write_text("")

    def b(prompt, strict):
        if down.exists() and prompt.startswith("late"):
            raise OSError("down")
        return extract_b(prompt, strict)

    clients = batch.Clients(counting(logs["a"], extract_a), counting(logs["b"], b), counting(logs["s"], lambda p, s: screen(p, False)), None, wait=0.0)
    out = str(tmp_path / "run")
    rows = papers(spark, "one", "late")
    assert [r.paper_id for r in batch.process_papers(rows, clients, Profile("t", "m", "u", fallback_budgets=(None,)), out).collect()] == ["one"]
    assert asked(logs["a"]) == ["late", "one"] and asked(logs["s"]) == ["late", "one"]
    assert [r.paper_id for r in tables.read_batches(spark, f"{out}/partial", batch.PARTIAL).collect()] == ["late"]
    down.unlink()
    for log in logs.values():
        log.unlink()
    profile = Profile("t", "m", "u", fallback_budgets=(None,))
    assert sorted(r.paper_id for r in batch.process_papers(rows, clients, profile, out).collect()) == ["late", "one"]
    assert asked(logs["a"]) == [] and asked(logs["s"]) == [] and asked(logs["b"]) == ["late"]  # A is reused, what is done is passed over
    assert tables.read_batches(spark, f"{out}/partial", batch.PARTIAL).count() == 0
    logs["b"].unlink()
    assert len(batch.process_papers(rows, clients, profile, out, force=True).collect()) == 2
    assert asked(logs["a"]) == asked(logs["b"]) == asked(logs["s"]) == ["late", "one"]


def test_directory_to_sheet(spark, tmp_path):
    (tmp_path / "pdf").mkdir()
    for name in ("one", "bad"):
        (tmp_path / "pdf" / f"{name}.pdf").write_bytes(name.encode())
    log = tmp_path / "parsed"

    def parser(content):
        with open(log, "a") as f:
            f.write(content.decode() + "\n")
        if content == b"bad":
            raise ValueError("no text")
        return '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title>T</title></titleStmt></teiHeader><text><body><div><head>Results</head><p>deep result with an AUC of 0.91 for the Random Forest</p></div></body></text></TEI>'

    out = str(tmp_path / "run")
    for turn in (1, 2):
        sheet = batch.run_directory(spark, str(tmp_path / "pdf"), parser, CLIENTS, PROFILE, out, alive=lambda: True).collect()
        assert [(r.paper_id, r.AUC) for r in sheet] == [("one", "0.91")]
        assert asked(log) == ["bad"] * turn + ["one"]
    with pytest.raises(TimeoutError):
        boundary.wait_until_ready(lambda: False, 0.0)


def test_profiles_reach_the_clients():
    made = []
    clients = batch.clients_of(lambda s: made.append(s) or extract_a, Profile("t", "m", "u", temperature_a=0.2, request_timeout_s=7, max_tokens=9))
    assert clients.arbiter and clients.screen and [s.temperature for s in made] == [0.2, 0.4, 0.0, 0.0]
    assert [s.max_tokens for s in made] == [9, 9, 1500, 9] and {s.request_timeout_s for s in made} == {7}
