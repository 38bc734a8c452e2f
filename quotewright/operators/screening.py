"""The eligibility gate and its sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.functions.records import ALL_CODES, CRITERIA


def proceeds(decision: Column) -> Column:
    """All but 'exclude' proceed; so does a paper whose screening failed and has no decision."""
    return ~decision.eqNullSafe(F.lit("exclude"))


def gate(papers: DataFrame, screenings: DataFrame) -> DataFrame:
    """``papers`` that proceed to extraction, by their decision in ``screenings``."""
    excluded = screenings.where(~proceeds(F.col("decision"))).select("paper_id")
    return papers.join(excluded, "paper_id", "left_anti")


def known_codes(criteria: Column) -> Column:
    vocabulary = F.array(*map(F.lit, ALL_CODES))
    return F.filter(criteria, lambda c: F.array_contains(vocabulary, c["code"]))


def exclusion_rule(screenings: DataFrame) -> DataFrame:
    """Whether an exclusion code agrees with the decision; a check beside the gate, which reads the decision alone."""
    has = F.size("exclusion_criteria_met") > 0
    return screenings.select("paper_id", "decision", has.alias("has_exclusion_code"), (has == ~proceeds(F.col("decision"))).alias("consistent"))


def screening_sheet(screenings: DataFrame) -> DataFrame:
    codes = lambda c: F.array_join(F.transform(F.coalesce(c, F.array().cast("array<struct<code:string,quote:string,note:string>>")), lambda x: x["code"]), ", ").alias(c)
    return screenings.select(
        "paper_id",
        "decision",
        *map(codes, CRITERIA),
        F.coalesce("justification", F.lit("")).alias("justification"),
        F.array_join(F.coalesce("screening_warnings", F.array().cast("array<string>")), "; ").alias("screening_warnings"),
    )
