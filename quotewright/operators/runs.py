"""Two runs side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("records", "prompt_tokens", "fallback_level", "divergent_fields", "unmatched", "arbiter_resolved", "total_s")


def summarize(checkpoints: DataFrame) -> DataFrame:
    """One row per paper; fields that older checkpoints lack count as empty."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    diverging = F.transform("comparisons", lambda c: F.size(F.filter(c["divergences"], lambda d: d["diverges"])))
    tokens = F.when(F.coalesce("estimated_prompt_tokens", F.lit(0)) != 0, F.col("estimated_prompt_tokens"))
    third = F.floor(F.coalesce("source_text_len", F.lit(0)) / 3)
    values: dict[str, Column] = {
        "records": size(F.coalesce("extraction_reconciled", "extraction_a")["records"]),
        "prompt_tokens": F.coalesce(tokens, third),
        "fallback_level": F.coalesce("fallback_level", F.lit(0)),
        "divergent_fields": F.coalesce(F.aggregate(diverging, F.lit(0), lambda a, x: a + F.greatest(x, F.lit(0))), F.lit(0)),
        "unmatched": size(F.filter("comparisons", lambda c: c["index_b"].isNull())),
        "arbiter_resolved": size("arbiter_resolutions"),
        "total_s": F.col("timing.total_s"),
    }
    return checkpoints.select("paper_id", *(v.alias(k) for k, v in values.items()))


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Summaries of two runs -> a row per paper of either, columns with _a and _b, null where a run lacks it."""
    sides = [df.select("paper_id", *(F.col(m).alias(f"{m}_{s}") for m in METRICS)) for df, s in ((a, "a"), (b, "b"))]
    return sides[0].join(sides[1], "paper_id", "full").orderBy("paper_id")


def column_means(report: DataFrame) -> DataFrame:
    return report.agg(*(F.bround(F.avg(F.col(c).try_cast("double")), 2).alias(c) for c in report.columns if c != "paper_id"))
