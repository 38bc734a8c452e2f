import json

import pytest
from pyspark.sql import functions as F

from quotewright.functions.records import EVIDENCE_FIELDS, EXTRACTION, RECORD
from quotewright.operators import blocks, dedup, pairing, registry, repair, runs, screening, sheet, verify
from quotewright.operators.sanity import sanity_flags

YES_NO = ("baseline", "financial", "productive", "climatic", "hybrid")


def record(**given):
    out = {}
    for f in RECORD:
        if f.name in EVIDENCE_FIELDS:
            v = given.get(f.name)
            out[f.name] = v if isinstance(v, dict) else {"value": v, "quote": None, "source_section": None}
        else:
            out[f.name] = given.get(f.name, "not_reported" if f.name in YES_NO else None)
    return out


def papers(spark, *rows):
    return spark.createDataFrame([{"paper_id": f"p{i}", "records": r, "extraction_warnings": []} for i, r in enumerate(rows)], EXTRACTION)


# --- blocks


def parsed(spark, **given):
    row = {"paper_id": "p", "title": "T", "abstract": "A", "sections": [], "tables": [], "empty_table_labels": []} | given
    kind = "paper_id string, title string, abstract string, sections array<struct<header:string,text:string>>, tables array<struct<label:string,caption:string,text:string>>, empty_table_labels array<string>"
    return spark.createDataFrame([row], kind)


def test_segments_in_order_and_renders_back(spark):
    df = parsed(spark, sections=[{"header": "Intro", "text": "words"}], tables=[{"label": "1", "caption": "c", "text": "| a |"}], empty_table_labels=["Table 4"])
    rows = blocks.segment(df).orderBy("block_pos").collect()
    assert [r.kind for r in rows] == ["fixed", "section", "table", "warning"]
    window = blocks.select_window(blocks.segment(df), None).first().window
    assert window == "\n".join(r.rendered for r in rows) and "Table 4" in window and window.startswith("TITLE: T\nABSTRACT: A")


def block_rows(spark, *rows):
    return spark.createDataFrame([("p", i, k, t) for i, (k, t) in enumerate(rows)], "paper_id string, block_pos int, kind string, rendered string")


def test_budget_prefers_metrics_and_keeps_order(spark):
    rows = block_rows(spark, ("fixed", "t"), ("section", "x" * 300), ("section", "AUC accuracy recall " * 10), ("warning", "w"))
    picked = blocks.select_window(rows, 80).first()
    assert [b.pos for b in picked.blocks] == [0, 2, 3] and picked.used_tokens == 67
    assert [b.pos for b in blocks.select_window(rows, 1).first().blocks] == [0, 3]
    assert len(blocks.select_window(rows, None).first().blocks) == 4


def test_a_block_that_does_not_fit_is_passed_over(spark):
    rows = block_rows(spark, ("fixed", ""), ("section", "auc auc " + "x" * 600), ("section", "y" * 90), ("section", "z" * 90))
    assert [b.pos for b in blocks.select_window(rows, 65).first().blocks] == [0, 2, 3]


def test_dense_tables_score_up_to_threefold(spark):
    rows = block_rows(spark, ("table", "auc 1234567890"), ("section", "auc 1234567890"), ("section", "CALIBRAÇÃO"))
    score = blocks.block_score(F.col("kind"), F.col("rendered"))
    assert [r[0] for r in rows.orderBy("block_pos").select(score).collect()] == [9.0, 3.0, 3.0]


def test_ladder_takes_the_first_level_with_records(spark):
    df = spark.createDataFrame([("a", 0, []), ("a", 1, [1]), ("a", 2, [1, 2]), ("b", 0, []), ("b", 1, [])], "paper_id string, level int, records array<int>")
    got = {r.paper_id: (r.fallback_level, r.records) for r in blocks.climb_ladder(df).collect()}
    assert got == {"a": (1, [1]), "b": (1, [])}


# --- sanity


def flags(spark, **given):
    df = papers(spark, [record(**given)]).select(F.explode("records").alias("r")).select(sanity_flags(F.col("r")).alias("f"))
    return {f.field_name: (f.ok, f.parsed_value, f.message) for f in df.first().f}


def test_ranges(spark):
    assert flags(spark, auc="0.87")["auc"] == (True, 0.87, "ok")
    assert flags(spark, auc="1.5")["auc"] == (False, 1.5, "AUC parseado=1.5 fora do intervalo esperado [0.5, 1.0]")
    assert not flags(spark, auc="0.3")["auc"][0] and not flags(spark, auc="none")["auc"][0]
    assert flags(spark, auc="none")["auc"][2].startswith("AUC parseado=None")
    assert flags(spark, sample_size="1,200")["sample_size"] == (True, 1200.0, "ok")
    assert flags(spark, default_rate="12%")["default_rate"][:2] == (True, pytest.approx(0.12))
    assert not flags(spark, standard_error="-1")["standard_error"][0]
    assert flags(spark) == {}


def test_prose_is_flagged(spark):
    got = flags(spark, sample_size="They analyzed a sample of 12 farms")
    assert got["sample_size.value_shape"][2].startswith("sample_size.value parece prosa/resumo (7 palavras)")


# --- quotes


def test_quotes(spark):
    source = spark.createDataFrame([("p", "The model reached\n an AUC of 0.87 on the test set.")], "paper_id string, source_text string")
    quotes = [(1, "reached an  AUC of 0.87"), (2, "completely invented sentence about rainfall"), (3, None), (4, " x "), (5, "reached an AUC of 0.78")]
    df = spark.createDataFrame([("p", i, q) for i, q in quotes] + [("q", 6, "without a source")], "paper_id string, i int, quote string")
    got = {r.i: r for r in verify.check_quotes(df, source).collect()}
    assert len(got) == 6 and got[1].verified and got[1].similarity == 100
    assert not got[2].verified and got[2].reason.startswith("similaridade ") and got[2].reason.endswith(" < limiar 90.0")
    assert got[3].reason == "quote vazio" and got[4].reason.startswith("quote muito curto")
    assert got[5].verified and 90 < got[5].similarity < 100
    assert not got[6].verified and got[6].similarity == 0


def test_bundles_of_quotes(spark, monkeypatch):
    monkeypatch.setattr(verify, "BUNDLE", 3)
    text = " ".join(f"finding number {i} of the paper" for i in range(20))
    source = spark.createDataFrame([("p", text)], "paper_id string, source_text string")
    rows = [("p", i, f"finding number {i}" if i % 3 == 0 else f"finding  number\n{i}" if i % 3 == 1 else f"finding nunber {i} of the") for i in range(20)] + [(None, 20, "finding number"), (None, 21, None)]
    got = {r.score: r for r in verify.check_quotes(spark.createDataFrame(rows, "paper_id string, score int, quote string"), source).collect()}
    assert len(got) == 22 and all(got[i].verified and (got[i].similarity == 100) == (i % 3 < 2) for i in range(20))
    assert got[20].similarity == 0 and got[21].reason == "quote vazio"


def test_record_without_values_is_verified(spark):
    source = spark.createDataFrame([("p0", "text")], "paper_id string, source_text string")
    bad = record(auc={"value": "0.9", "quote": "nowhere at all", "source_section": None})
    got = verify.verify_records(papers(spark, [record(), bad]), source).orderBy("record_index").collect()
    assert [(r.all_verified, r.unverified_fields) for r in got] == [(True, []), (False, ["auc"])]
    assert [f.field_name for f in got[1].field_results] == list(EVIDENCE_FIELDS)


# --- dedup


def kept(spark, *records):
    r = dedup.deduplicate(papers(spark, list(records))).first()
    return [(x.model_used.value, x.auc.value) for x in r.records], r.extraction_warnings


def test_duplicates_collapse(spark):
    got, said = kept(spark, record(model_used="RF", auc="0.91"), record(model_used="RF", auc="0.91"), record(model_used="XGBoost", auc="0.88"))
    assert got == [("RF", "0.91"), ("XGBoost", "0.88")] and len(said) == 1 and said[0].startswith("Deduplicacao: 1 registro(s) de 'RF'")


def test_the_fullest_record_stays(spark):
    df = dedup.deduplicate(papers(spark, [record(model_used="RF", auc="0.9"), record(model_used="RF", auc="0.9", accuracy="0.8", extraction_notes="n")]))
    assert df.first().records[0].accuracy.value == "0.8"


def test_other_metrics_and_no_common_metric_stay_apart(spark):
    assert len(kept(spark, record(model_used="RF", auc="0.91"), record(model_used="RF", auc="0.60"))[0]) == 2
    assert len(kept(spark, record(model_used="RF", auc="0.91"), record(model_used="RF", recall="0.6"))[0]) == 2
    assert len(kept(spark, record(model_used="RF", auc="x"), record(model_used="RF", auc="0.6"))[0]) == 1
    assert kept(spark) == ([], []) and len(kept(spark, record())[0]) == 1


def test_chains_collapse(spark):
    got, _ = kept(spark, *(record(model_used="RF", auc=v) for v in ("0.9005", "0.9155", "0.9305")))
    assert len(got) == 1


# --- pairing


def compared(spark, a, b):
    kind = f"paper_id string, records_a array<{RECORD.simpleString()}>, records_b array<{RECORD.simpleString()}>"
    return pairing.compare_extractions(spark.createDataFrame([{"paper_id": "p", "records_a": a, "records_b": b}], kind))


def test_order_does_not_matter(spark):
    a = [record(model_used=m, auc="0.9") for m in ("Random Forest", "XGBoost", "Logistic Regression")]
    rows = compared(spark, a, [a[2], a[0], a[1]]).collect()
    assert sorted((r.index_a, r.index_b) for r in rows) == [(0, 1), (1, 2), (2, 0)] and not any(r.has_divergence for r in rows)


def test_missing_in_b(spark):
    rows = compared(spark, [record(model_used="Random Forest"), record(model_used="Neural net")], [record(model_used="Random Forest")]).collect()
    got = {r.index_a: r for r in rows}
    assert got[1].index_b is None and got[1].has_divergence and got[1].divergences == [] and not got[0].has_divergence


def test_spelling_pairs_but_diverges(spark):
    row = compared(spark, [record(model_used="XGBoost", auc="0.95")], [record(model_used="XG Boost", auc="0.60")]).first()
    assert row.index_b == 0 and row.match_score == pytest.approx(66.667, abs=0.01)
    got = {d.field_name: d for d in row.divergences if d.diverges}
    assert set(got) == {"auc", "model_used"} and got["auc"].detail == "diff relativa=0.368" and got["model_used"].detail == "similaridade=66.7"
    assert len(row.divergences) == 19


def decided(spark, decisions):
    rows = compared(spark, [record(model_used="RF", auc="0.9", financial="yes")], [record(model_used="RF", auc={"value": "0.5", "quote": "q", "source_section": None}, financial="no")])
    df = spark.createDataFrame([("p", 0, decisions)], "paper_id string, index_a int, decisions array<struct<field_name:string,choice:string>>")
    return pairing.apply_decisions(rows, df).first()


def test_arbiter(spark):
    row = decided(spark, [("auc", "b"), ("financial", "a"), ("recall", "b"), ("nonsense", "b")])
    assert row.reconciled.auc.value == "0.5" and row.reconciled.auc.quote == "q" and row.reconciled.financial == "yes" and row.a.auc.value == "0.9"
    assert [(x.field_name, x.choice) for x in row.resolutions] == [("auc", "b"), ("financial", "a")]
    assert row.reconciled.extraction_notes == "[arbitro: auc<-b, financial<-a]"
    row = decided(spark, [("auc", "neither")])
    assert row.reconciled.auc.value == "0.9" and row.resolutions == [] and row.reconciled.extraction_notes is None


# --- sheet


def test_sheet_states(spark):
    records = papers(spark, [record(model_used="RF", auc="0.9"), record(auc="7")]).select("paper_id", F.posexplode("records").alias("record_index", "r"))
    nothing = lambda kind: spark.createDataFrame([], kind)
    comparisons = compared(spark, [record(model_used="RF", auc="0.9")], [record(model_used="RF", auc="0.5")]).withColumn("paper_id", F.lit("p0"))
    resolved = spark.createDataFrame([("p0", 0, "auc")], "paper_id string, index_a int, field_name string")
    checks = nothing("paper_id string, record_index int, all_verified boolean, unverified_fields array<string>")
    plain = {r.record_index: r for r in sheet.consolidate(records, checks, comparisons, resolved).collect()}
    assert plain[0].dual_extraction_diverges is False and plain[0].arbiter_resolved_fields == "auc" and not plain[0].needs_review
    assert plain[1].dual_extraction_diverges is None and plain[1].sanity_failed and plain[1].needs_review and plain[1].Model_used is None
    open_ = {r.record_index: r for r in sheet.consolidate(records, checks, comparisons, resolved.limit(0)).collect()}
    assert open_[0].dual_divergent_fields == "auc" and open_[0].needs_review
    assert len(sheet.consolidate(records, checks, comparisons, resolved).columns) == 40


def test_audit_size_and_draw(spark):
    assert [sheet.audit_size(n) for n in (0, 10, 100, 25, 75)] == [5, 5, 18, 5, 14]
    df = spark.range(100).select("id", (F.col("id") < 3).alias("needs_review"))
    for seed in (None, 42):
        rows = sheet.audit_sample(df, F.col("id"), seed=seed).collect()
        assert len(rows) == 18 and {r.id for r in rows if r.audit_reason == "auto-flagged"} == {0, 1, 2}
        assert len({r.id for r in rows}) == 18
    assert len(sheet.audit_sample(spark.range(4).select("id", F.lit(True).alias("needs_review")), F.col("id")).collect()) == 4


# --- repair and screening


def answers(spark, *raws):
    return spark.createDataFrame([(f"p{i}", r) for i, r in enumerate(raws)], "paper_id string, raw string")


def valid(**given):
    r = record(model_used="RF") | {f: "no" for f in YES_NO} | given
    return {"paper_id": "p0", "records": [r], "extraction_warnings": ["w"]}


def test_valid_answers_stay(spark):
    row = repair.read_extractions(answers(spark, json.dumps(valid()))).first()
    assert row.status == "ok" and row.records[0].model_used.value == "RF" and row.extraction_warnings == ["w"] and row.records[0].extraction_notes is None


def test_malformed_answers_are_repaired(spark):
    odd = {"records": [{"model_name": "RF", "auc": "0.9", "variables": ["a", None, "b"], "financial": True, "productive": "sim", "hybrid": "?",
                        "agricultural_context": "no", "type_data_used": ["financial"], "model_class": "k-NN", "recall": None, "sensitivity": "0.7"}]}
    r = repair.read_extractions(answers(spark, "Claro:\n" + json.dumps(odd))).first()
    assert r.status == "repaired"
    x = r.records[0]
    assert (x.model_used.value, x.variables_used.value, x.financial, x.productive, x.hybrid, x.climatic) == ("RF", "a, b", "yes", "yes", "not_reported", "not_reported")
    assert (x.agricultural_context, x.type_data_used, x.model_class, x.recall.value) == ("not_reported", "financial", "knn", None)
    assert "campo 'model_used' recuperado de alias" in x.extraction_notes and "campo 'climatic'='None' normalizado" in x.extraction_notes


def test_answers_beyond_repair(spark):
    number = json.dumps(valid(auc={"value": 0.9}))
    rows = repair.read_extractions(answers(spark, number, "{", None, "[1]", '{"records": 3}')).collect()
    assert {r.status for r in rows} == {"error"} and all(r.records is None for r in rows)
    assert repair.read_extractions(answers(spark, number), coerce=True).first().records[0].auc.value == "0.9"


def test_screening_answers(spark):
    good = {"decision": "exclude", "justification": "j", "exclusion_criteria_met": [{"code": "E9"}, {"code": "Z1"}]}
    odd = {"decision": "Incluir", "inclusion_criteria_met": ["I1", "I99", 4]}
    rows = {r.paper_id: r for r in repair.read_screenings(answers(spark, json.dumps(good), json.dumps(odd), '{"decision": "?"}', "x")).collect()}
    assert rows["p0"].status == "ok" and rows["p0"].unknown_codes == ["Z1"]
    assert rows["p1"].decision == "include_review_and_metaanalysis" and [c.code for c in rows["p1"].inclusion_criteria_met] == ["I1"]
    assert rows["p2"].decision == "exclude" and "nao reconhecida" in rows["p2"].screening_warnings[0]
    assert rows["p3"].status == "error" and rows["p3"].decision is None


def test_gate_lets_failures_pass(spark):
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "paper_id string")
    seen = spark.createDataFrame([("a", "exclude"), ("b", None)], "paper_id string, decision string")
    assert sorted(r.paper_id for r in screening.gate(work, seen).collect()) == ["b", "c"]


# --- registry and runs


def test_registry_round(spark):
    from quotewright.functions.records import REGISTRY

    rows = [{"record_id": f"doi:{i}", "fulltext_status": "done", "extraction_status": s, "fulltext": {"pdf_path": f"{i}.pdf"}} for i, s in enumerate(("pending", "failed", "done"))]
    reg = spark.createDataFrame(rows, REGISTRY)
    todo = registry.staging_map(registry.pending(reg))
    assert sorted(r.paper_id for r in todo.collect()) == ["doi_0", "doi_1"]
    ids = lambda *x: spark.createDataFrame([(i, "include_review_only") for i in x], "paper_id string, decision string")
    rollup = registry.paper_rollup(spark.createDataFrame([("doi_0", True), ("doi_0", False)], "paper_id string, needs_review boolean"))
    status = registry.derive_status(todo, ids("doi_0"), ids("doi_1"), rollup)
    assert {r.record_id: r.status for r in status.collect()} == {"doi:0": "done", "doi:1": "not_applicable"}
    strict = registry.derive_status(todo, ids("doi_0"), ids("doi_1"), rollup, strict=True)
    assert {r.record_id: r.status for r in strict.collect()} == {"doi:0": "done", "doi:1": "failed"}
    extra = spark.createDataFrame([("doi:9", "done"), ("doi:2", "odd")], "record_id string, status string")
    marked = registry.mark_status(reg, status.unionByName(extra, allowMissingColumns=True), now=F.lit("now"))
    got = {r.record_id: r for r in marked.collect()}
    assert len(got) == 3 and got["doi:0"].extraction.n_models_extracted == 2 and got["doi:0"].extraction.needs_review
    assert got["doi:1"].extraction is None and got["doi:1"].updated_at == "now" and got["doi:2"].updated_at is None


def test_later_updates_prevail(spark):
    from quotewright.functions.records import REGISTRY

    reg = spark.createDataFrame([{"record_id": "a", "extraction_status": "pending"}], REGISTRY)
    kind = "record_id string, status string, checkpoint_path string, n_models_extracted int, needs_review boolean, update_order int"
    ups = spark.createDataFrame([("a", "done", "x", 1, False, 0), ("a", "failed", None, None, None, 1)], kind)
    row = registry.mark_status(reg, ups).first()
    assert row.extraction_status == "failed" and row.extraction.checkpoint_path == "x"


def test_runs_of_old_checkpoints(spark):
    from quotewright.functions.records import CHECKPOINT

    old = {"paper_id": "a", "source_text_len": 90, "extraction_a": {"paper_id": "a", "records": [record()], "extraction_warnings": []}}
    new = old | {"paper_id": "b", "estimated_prompt_tokens": 7, "comparisons": [{"index_a": 0, "index_b": None, "divergences": [{"field_name": "auc", "diverges": True}]}, {"index_a": None, "index_b": 1, "divergences": []}]}
    a, b = (runs.summarize(spark.createDataFrame([x], CHECKPOINT)) for x in (old, new))
    rows = runs.compare_runs(a, b).collect()
    assert (rows[0].records_a, rows[0].prompt_tokens_a, rows[0].unmatched_a, rows[0].records_b) == (1, 30, 0, None)
    assert (rows[1].prompt_tokens_b, rows[1].divergent_fields_b, rows[1].unmatched_b) == (7, 1, 1)
    assert runs.column_means(runs.compare_runs(a, b)).first().prompt_tokens_a == 30
