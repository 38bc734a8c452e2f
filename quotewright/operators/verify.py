"""Values held against their quotes, quotes against the source text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.functions.fuzzy import partial_ratios_column
from quotewright.functions.records import EVIDENCE_FIELDS
from quotewright.functions.text import collapse, collapse_ends

THRESHOLD = 90.0
SHORTEST = 3
#: Quotes that meet a text in one row.
BUNDLE = 256


def check_quotes(quotes: DataFrame, sources: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``quotes`` (paper_id, quote, ...) with verified, similarity and reason, against ``sources`` (paper_id, source_text).

    Blank and very short quotes fail. A quote found word for word, white space aside, scores 100 inside the JVM; the fuzzy matcher
    gets the others. A paper's quotes, ``BUNDLE`` at most, meet its text in one row, so a text is joined once and sent to
    the matcher once, if at all, and is dropped before the quotes part again. A paper without a source counts as having an empty one.
    """
    blank = F.coalesce(collapse_ends(F.col("quote")) == "", F.lit(True))
    rows = quotes.select("paper_id", F.struct(*(F.col(f"`{c}`") for c in quotes.columns)).alias("row"), collapse(F.col("quote")).alias("q"), blank.alias("blank"))
    rows = rows.withColumn("open", ~F.col("blank") & (F.length("q") >= SHORTEST))
    nth = F.row_number().over(Window.partitionBy("paper_id").orderBy(F.desc("open"), "q"))
    bundled = rows.withColumn("bundle", F.floor(nth / BUNDLE)).groupBy("paper_id", "bundle").agg(F.collect_list(F.struct("row", "q", "blank", "open")).alias("items"))
    texts = sources.select("paper_id", collapse(F.col("source_text")).alias("s"))
    met = bundled.join(texts, "paper_id", "left").withColumn("s", F.coalesce("s", F.lit("")))
    met = met.withColumn("exact", F.transform("items", lambda i: i["open"] & F.contains(F.col("s"), i["q"])))
    left = F.zip_with("items", "exact", lambda i, x: F.when(i["open"] & ~x, i["q"]))
    met = met.withColumn("left", left).withColumn("s", F.when(F.exists("left", lambda q: q.isNotNull()), F.col("s")))
    scored = met.withColumn("scores", partial_ratios_column(F.col("left"), F.col("s"))).select(F.explode(F.arrays_zip("items", "exact", "scores")).alias("z"))
    scored = scored.withColumn("score", F.when(F.col("z.exact"), 100.0).otherwise(F.coalesce("z.scores", F.lit(0.0))))
    low = F.concat(F.lit("similaridade "), F.format_string("%.1f", F.bround("score", 1)), F.lit(f" < limiar {threshold}"))
    passed = F.col("z.items.open") & (F.col("score") >= threshold)
    reason = F.when(F.col("z.items.blank"), "quote vazio").when(~F.col("z.items.open"), "quote muito curto para verificar com confianca").when(passed, "ok").otherwise(low)
    return scored.select("z.items.row.*", passed.alias("verified"), F.col("score").alias("similarity"), reason.alias("reason"))


def evidence_rows(papers: DataFrame, records: Column) -> DataFrame:
    """One row per evidence field of each record: paper_id, record_index, model_used, field_pos, field_name, value, quote."""
    rows = papers.select("paper_id", F.posexplode(records).alias("record_index", "r"))
    fields = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"r.{f}.value").alias("value"), F.col(f"r.{f}.quote").alias("quote")) for f in EVIDENCE_FIELDS))
    rows = rows.select("paper_id", "record_index", F.col("r.model_used.value").alias("model_used"), F.posexplode(fields).alias("field_pos", "f"))
    return rows.select("paper_id", "record_index", "model_used", "field_pos", "f.*")


def verify_records(papers: DataFrame, sources: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Papers (paper_id, records) -> per record: model_used, all_verified, unverified_fields, field_results.

    Null values need no quote and pass; a record without values is verified.
    """
    rows = evidence_rows(papers, F.col("records"))
    empty = rows.where("value IS NULL").withColumns(
        {"quote": F.lit(None).cast("string"), "verified": F.lit(True), "similarity": F.lit(100.0), "reason": F.lit("valor nulo, nada a verificar")}
    )
    checked = empty.unionByName(check_quotes(rows.where("value IS NOT NULL"), sources, threshold))
    names = ("field_name", "value", "quote", "verified", "similarity", "reason")
    return summarize_fields(checked.groupBy("paper_id", "record_index").agg(
        F.first("model_used").alias("model_used"), F.array_sort(F.collect_list(F.struct("field_pos", *names))).alias("f")
    ).withColumn("field_results", F.transform("f", lambda x: F.struct(*(x[n].alias(n) for n in names)))).drop("f"))


def summarize_fields(records: DataFrame) -> DataFrame:
    """Adds all_verified and unverified_fields to rows with field_results."""
    failed = F.filter("field_results", lambda f: f["value"].isNotNull() & ~f["verified"])
    out = records.withColumn("all_verified", F.size(failed) == 0)
    return out.withColumn("unverified_fields", F.transform(failed, lambda f: f["field_name"]))
