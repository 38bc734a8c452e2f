"""Whole runs: papers to checkpoints, checkpoints to sheets, registry to registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions.records import CHECKPOINT, EXTRACTION, SCREENING
from quotewright.operators import blocks, dedup, pairing, registry, repair, runs, screening, sheet, verify
from quotewright.sources import boundary, tables, tei
from quotewright.sources.tables import Profile


@dataclass(frozen=True)
class Clients:
    """Who answers; None leaves a step out. Templates name {paper_id} and {source_text}, the arbiter's also {fields}."""

    extract_a: boundary.Client
    extract_b: boundary.Client
    screen: boundary.Client | None = None
    arbiter: boundary.Client | None = None
    extract_template: str = "{paper_id}\n{source_text}"
    screen_template: str = "{paper_id}\n{source_text}"
    arbiter_template: str = "{paper_id}\n{fields}\n{source_text}"
    wait: float = boundary.SHORTEST_WAIT


def clients_of(make: Callable[[boundary.Settings], boundary.Client], profile: Profile, screening: bool = True, arbiter: bool = True, **given: object) -> Clients:
    """Clients made with a profile's settings: two extractions at their temperatures, the arbiter cold and with short answers."""

    def settings(temperature: float, max_tokens: int, context: int, purpose: str = "extraction") -> boundary.Settings:
        return boundary.Settings(profile.model, profile.api_base, temperature, max_tokens, profile.request_timeout_s, context, purpose)

    a, b = (make(settings(t, profile.max_tokens, profile.min_num_ctx)) for t in profile.temperatures())
    judge = make(settings(0.0, profile.arbiter_max_tokens, profile.arbiter_min_num_ctx, "arbiter")) if arbiter else None
    screen = make(settings(0.0, profile.max_tokens, profile.min_num_ctx, "screening")) if screening else None
    return Clients(a, b, screen, judge, **given)


#: Extraction A as it is kept until its paper is finished.
PARTIAL = T.StructType([
    T.StructField("paper_id", T.StringType()), T.StructField("source_text", T.StringType()), T.StructField("fallback_level", T.IntegerType()),
    T.StructField("records", EXTRACTION["records"].dataType), T.StructField("extraction_warnings", EXTRACTION["extraction_warnings"].dataType),
    T.StructField("seconds", T.DoubleType()),
])


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def screen_papers(papers: DataFrame, clients: Clients, out: str, limit: int = 1) -> DataFrame:
    """Screening results of ``papers``, added to those in ``out``/screening; a failed one has no decision, lets its paper pass
    and is asked again in the next run."""
    full = blocks.render(blocks.blocks_of(*(F.col(c) for c in ("title", "abstract", "sections", "tables", "empty_table_labels"))))
    rows = papers.select("paper_id", blocks.screening_text(F.col("abstract"), full).alias("source_text"))
    prompt = boundary.prompt_of(clients.screen_template, paper_id=F.col("paper_id"), source_text=F.col("source_text"))
    answers = _stored(boundary.ask(rows, prompt, clients.screen, clients.wait, any_error=True, limit=limit).select("paper_id", "raw"), f"{out}/answers/screening")
    tables.append_batch(repair.read_screenings(answers).where("status <> 'error'").select(*SCREENING.names), f"{out}/screening")
    return tables.read_batches(papers.sparkSession, f"{out}/screening", SCREENING)


def extract_ladder(papers: DataFrame, clients: Clients, budgets: tuple[int | None, ...], out: str, limit: int = 1) -> DataFrame:
    """Extraction A at rising budgets: each level asks only for papers without a record so far.

    (paper_id, source_text, fallback_level, records, extraction_warnings); papers whose answers fail are absent.
    """
    left, found = papers.select("paper_id"), None
    for level, budget in enumerate(budgets):
        windows = blocks.window_of_papers(papers.join(left, "paper_id", "left_semi"), budget).where(F.trim("window") != "")
        rows = windows.select("paper_id", F.col("window").alias("source_text"))
        prompt = boundary.prompt_of(clients.extract_template, paper_id=F.col("paper_id"), source_text=F.col("source_text"))
        answers = _stored(boundary.ask(rows, prompt, clients.extract_a, clients.wait, limit=limit), f"{out}/answers/a{level}")
        read = dedup.deduplicate(repair.read_extractions(answers).where("status <> 'error'").drop("status"))
        got = _stored(answers.select("paper_id", "source_text", "seconds").join(read, "paper_id").withColumn("fallback_level", F.lit(level)), f"{out}/answers/read{level}")
        last = level == len(budgets) - 1
        kept = got if last else got.where(F.size("records") > 0)
        found = kept if found is None else found.unionByName(kept)
        left = left.join(kept.select("paper_id"), "paper_id", "left_anti")
        if not last and left.isEmpty():
            break
    return found


def arbitrate(compared: DataFrame, sources: DataFrame, clients: Clients, out: str, limit: int = 1) -> DataFrame:
    """(paper_id, index_a, decisions) for divergent pairs; an answer that is not one gives none."""
    open_ = F.filter("divergences", lambda d: d["diverges"])
    rows = compared.where("index_a IS NOT NULL AND index_b IS NOT NULL").where(F.size(open_) > 0)
    line = lambda d: F.concat(F.lit('- campo "'), d["field_name"], F.lit('": A="'), F.coalesce(d["value_a"], F.lit("None")), F.lit('" | B="'), F.coalesce(d["value_b"], F.lit("None")), F.lit('"'))
    rows = rows.select("paper_id", "index_a", F.array_join(F.transform(open_, line), "\n").alias("fields")).join(sources, "paper_id")
    prompt = boundary.prompt_of(clients.arbiter_template, paper_id=F.col("paper_id"), fields=F.col("fields"), source_text=F.col("source_text"))
    answers = _stored(boundary.ask(rows, prompt, clients.arbiter, clients.wait, limit=limit).select("paper_id", "index_a", "raw", "seconds"), f"{out}/answers/arbiter")
    kind = T.StructType([T.StructField("decisions", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("field_name", "choice")])))])
    given = F.from_json(repair.recovered_json(F.col("raw")), kind)["decisions"]
    rows = answers.select("paper_id", "index_a", given.alias("decisions")).where("decisions IS NOT NULL")
    return rows.where(F.forall("decisions", lambda d: d["field_name"].isNotNull() & F.coalesce(d["choice"].isin("a", "b", "neither"), F.lit(False))))


def process_papers(papers: DataFrame, clients: Clients, profile: Profile, out: str, force: bool = False) -> DataFrame:
    """Parsed papers -> their checkpoints, stored in ``out``/checkpoints: screening, extraction A by the ladder, B on A's window,
    comparison, arbitration, verification against the window.

    At most ``profile.max_concurrency`` calls are open at once. Papers with a checkpoint are passed over, screenings are not asked again, and extraction A of a paper that was not finished
    is taken from ``out``/partial, which is cleared of finished papers; ``force`` does everything again.
    """
    spark, limit = papers.sparkSession, profile.max_concurrency
    if "parse_s" not in papers.columns:
        papers = papers.withColumn("parse_s", F.lit(None).cast("double"))
    known = lambda name, schema: tables.read_batches(spark, f"{out}/{name}", schema)
    # what is to be done is fixed before anything is added
    todo = _stored(tables.unfinished(papers.select("paper_id"), known("checkpoints", CHECKPOINT), force), f"{out}/answers/todo")
    asked, papers = papers, papers.join(todo, "paper_id", "left_semi")
    if clients.screen:
        screened = screen_papers(tables.unfinished(papers, known("screening", SCREENING), force), clients, out, limit)
        papers = screening.gate(papers, screened)
    resumed = known("partial", PARTIAL).join(papers, "paper_id", "left_semi")
    fresh = extract_ladder(tables.unfinished(papers, resumed, force), clients, profile.fallback_budgets, out, limit)
    tables.append_batch(fresh.select(*(F.col(f.name).cast(f.dataType) for f in PARTIAL)), f"{out}/partial")
    a = known("partial", PARTIAL).join(papers, "paper_id", "left_semi")
    if force:  # an older extraction of a paper that failed this time doesn't count
        a = a.join(fresh, "paper_id", "left_semi")
    a = _stored(a, f"{out}/answers/a")
    sources = a.select("paper_id", "source_text")
    prompt = boundary.prompt_of(clients.extract_template, paper_id=F.col("paper_id"), source_text=F.col("source_text"))
    answers = _stored(boundary.ask(sources, prompt, clients.extract_b, clients.wait, limit=limit).select("paper_id", "raw", "seconds"), f"{out}/answers/b")
    b = dedup.deduplicate(repair.read_extractions(answers).where("status <> 'error'").drop("status"))
    b = b.select("paper_id", F.col("records").alias("records_b"), F.col("extraction_warnings").alias("warnings_b"))
    both = a.join(b, "paper_id").withColumnRenamed("records", "records_a")
    compared = _stored(pairing.compare_extractions(both), f"{out}/answers/compared")
    decisions = arbitrate(compared, sources, clients, out, limit) if clients.arbiter else compared.select("paper_id", "index_a", F.lit(None).cast("array<struct<field_name:string,choice:string>>").alias("decisions")).limit(0)
    decided = _stored(pairing.apply_decisions(compared, decisions), f"{out}/answers/decided")

    kinds = {f.name: f.dataType for f in CHECKPOINT}
    ordered = lambda c, name: F.transform(F.array_sort(F.collect_list(F.struct("index_a", c))), lambda x: x[c]).alias(name)
    reconciled = decided.where("index_a IS NOT NULL").groupBy("paper_id").agg(ordered("reconciled", "reconciled"), F.flatten(ordered("resolutions", "r")).alias("resolutions"))
    comparison = F.struct("index_a", "index_b", "model_used_a", "model_used_b", "match_score", "divergences")
    comparisons = decided.groupBy("paper_id").agg(F.collect_list(comparison).alias("comparisons"))
    checked = verify.verify_records(reconciled.select("paper_id", F.col("reconciled").alias("records")), sources)
    verification = F.struct("record_index", "model_used", "all_verified", "unverified_fields", "field_results")
    verified = checked.groupBy("paper_id").agg(F.array_sort(F.collect_list(verification)).alias("verifications"))
    rows = both.join(reconciled, "paper_id", "left").join(comparisons, "paper_id", "left").join(verified, "paper_id", "left")
    rows = rows.join(papers.select("paper_id", "empty_table_labels", "parse_s"), "paper_id", "left")
    rows = rows.join(answers.select("paper_id", F.col("seconds").alias("b_s")), "paper_id", "left")
    if clients.arbiter:
        judged = spark.read.parquet(f"{out}/answers/arbiter").groupBy("paper_id").agg(F.sum("seconds").alias("arbiter_s"))
        rows = rows.join(judged, "paper_id", "left")
    else:
        rows = rows.withColumn("arbiter_s", F.lit(None).cast("double"))
    spent = [F.col(c) for c in ("parse_s", "seconds", "b_s", "arbiter_s")]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in spent), F.lit(0.0))
    timing = F.struct(*(c.alias(n) for c, n in zip(spent, ("grobid_s", "extraction_a_s", "extraction_b_s", "arbiter_s"))), total.alias("total_s"))

    def extraction(records: str, warnings: str):
        return F.struct(F.col("paper_id"), F.col(records).alias("records"), F.col(warnings).alias("extraction_warnings"))

    made = {
        "paper_id": F.col("paper_id"),
        "source_text_len": F.length("source_text"),
        "estimated_prompt_tokens": F.floor(F.length("source_text") / 3),
        "fallback_level": F.col("fallback_level"),
        "timing": timing,
        "empty_table_labels": F.col("empty_table_labels"),
        "extraction_a": extraction("records_a", "extraction_warnings"),
        "extraction_b": extraction("records_b", "warnings_b"),
        "extraction_reconciled": extraction("reconciled", "extraction_warnings"),
        "arbiter_resolutions": F.col("resolutions"),
        "record_count_mismatch": F.size("records_a") != F.size("records_b"),
        "comparisons": F.col("comparisons"),
        "verifications": F.col("verifications"),
    }
    rows = rows.withColumn("reconciled", F.coalesce("reconciled", "records_a"))
    tables.append_batch(rows.select(*(c.cast(kinds[n]).alias(n) for n, c in made.items())), f"{out}/checkpoints")
    finished = known("checkpoints", CHECKPOINT)
    tables.keep_batches(_stored(tables.unfinished(known("partial", PARTIAL), finished), f"{out}/answers/left"), f"{out}/partial")
    return finished.join(asked.select("paper_id"), "paper_id", "left_semi")


def run_directory(
    spark: SparkSession, pdfs: str, parser: Callable[[bytes], str], clients: Clients, profile: Profile, out: str, force: bool = False,
    alive: Callable[[], bool] | None = None, most_wait: float = 180.0,
) -> DataFrame:
    """PDF files in a folder -> the sheet, with its audit sample and the screening sheet beside it.

    Waits for the parser's service if ``alive`` asks it. Each file is parsed once: its TEI is kept in ``out``/tei_cache. Files that
    can't be parsed make no row and are tried again in the next run.
    """
    if alive is not None:
        boundary.wait_until_ready(alive, most_wait)
    kind = "paper_id string, xml string, seconds double"
    files = tei.read_pdfs(spark, pdfs)
    cached = tables.read_batches(spark, f"{out}/tei_cache", kind)
    parsed = boundary.parse_pdfs(files.join(cached, "paper_id", "left_anti"), parser, profile.max_concurrency).where("xml IS NOT NULL")
    tables.append_batch(parsed, f"{out}/tei_cache")
    known = tables.read_batches(spark, f"{out}/tei_cache", kind).join(files.select("paper_id"), "paper_id", "left_semi")
    papers = known.select("paper_id", tei.parsed(F.col("xml")).alias("p"), F.col("seconds").alias("parse_s")).select("paper_id", "p.*", "parse_s")
    process_papers(papers, clients, profile, out, force)
    screenings = tables.read_batches(spark, f"{out}/screening", SCREENING) if clients.screen else None
    return consolidate_run(tables.read_batches(spark, f"{out}/checkpoints", CHECKPOINT), screenings, out)


def run_summary(asked: DataFrame, checkpoints: DataFrame, screenings: DataFrame | None = None) -> DataFrame:
    """One row: papers asked for, processed, excluded by screening, screened but not processed, failed; records, and papers with
    as many records in both extractions."""
    done = checkpoints.select("paper_id", F.size("extraction_a.records").alias("n"), (~F.col("record_count_mismatch")).alias("even"), F.lit(True).alias("done"))
    rows = asked.select("paper_id").distinct().join(done, "paper_id", "left")
    none = F.lit(None).cast("string")
    rows = rows.withColumn("decision", none) if screenings is None else rows.join(screenings.select("paper_id", "decision"), "paper_id", "left")
    out = F.coalesce(F.col("decision") == "exclude", F.lit(False))
    missing = F.col("done").isNull()
    return rows.agg(
        F.count("*").alias("papers"), F.count("done").alias("processed"), F.count_if(out).alias("excluded"),
        F.count_if(missing & F.col("decision").isNotNull() & ~out).alias("screened_not_processed"), F.count_if(missing & ~out).alias("failed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.count_if("even").alias("even_counts"),
    )


def screened_not_processed(checkpoints: DataFrame, screenings: DataFrame) -> DataFrame:
    """(paper_id, decision) of papers that screening lets pass and that have no checkpoint."""
    open_ = screenings.where(F.col("decision").isNotNull() & screening.proceeds(F.col("decision")))
    return open_.join(checkpoints.select("paper_id"), "paper_id", "left_anti").select("paper_id", "decision")


def consolidate_run(checkpoints: DataFrame, screenings: DataFrame | None, out: str, seed: int | None = None) -> DataFrame:
    """The sheet of a run and its audit sample, written to ``out`` as CSV and as workbooks, and the screening sheet if there is one."""
    rows = _stored(sheet.consolidate_checkpoints(checkpoints), f"{out}/sheet")
    key = F.crc32(F.concat_ws("/", "paper_id", "record_index"))
    audit = _stored(sheet.audit_sample(rows, key, seed=seed), f"{out}/audit")
    made = {"metadados_extraidos": rows.drop("record_index"), "auditoria_amostra": audit.drop("record_index")}
    if screenings is not None:
        made["triagem_prisma"] = screening.screening_sheet(screenings)
    for name, frame in made.items():
        tables.write_sheet(frame, f"{out}/{name}.csv")
        tables.write_workbook(frame, f"{out}/{name}.xlsx", "triagem" if name == "triagem_prisma" else "metadados")
    return rows


def compare_folders(spark: SparkSession, a: str, b: str, out: str | None = None) -> DataFrame:
    """Two runs' checkpoint folders side by side, by paper; as CSV in ``out`` if that is given."""
    report = runs.compare_runs(*(runs.summarize(tables.read_batches(spark, f"{p}/checkpoints", CHECKPOINT)) for p in (a, b))).orderBy("paper_id")
    if out is not None:
        tables.write_sheet(report, out)
    return report


def registry_update_at(spark: SparkSession, path: str, updates: DataFrame, attempts: int = 10) -> int:
    """Status updates applied to the registry stored at ``path``, beside what other runs write to it meanwhile."""
    return tables.update_registry(spark, path, lambda reg: registry.mark_status(reg, updates), attempts)


def registry_run(reg: DataFrame, papers: DataFrame, clients: Clients, profile: Profile, out: str) -> tuple[DataFrame, DataFrame]:
    """Works off what is pending in a registry: (the sheet with its bibliographic columns, the registry as it is then).

    ``papers``: parsed papers by paper_id, the record id made safe.
    """
    staged = registry.staging_map(registry.pending(reg))
    todo = papers.join(staged.select("paper_id"), "paper_id", "left_semi")
    checkpoints = process_papers(todo, clients, profile, out)
    spark = reg.sparkSession
    screenings = tables.read_batches(spark, f"{out}/screening", SCREENING) if clients.screen else spark.createDataFrame([], SCREENING)
    rows = consolidate_run(checkpoints, screenings, out)
    updates = registry.derive_status(staged, checkpoints, screenings, registry.paper_rollup(rows))
    return registry.merge_bibliography(rows, staged.select("paper_id", "record_id"), reg), registry.mark_status(reg, updates)
