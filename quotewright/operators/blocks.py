"""Papers as ordered blocks: segmenting, scoring, filling a token budget, rendering, the budget ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.functions.numbers import let
from quotewright.functions.records import WARNING
from quotewright.functions.text import (
    ANCHOR_PATTERN,
    METRIC_PATTERN,
    MODEL_PATTERN,
    collapse_ends,
    digit_density,
    estimated_tokens,
    matches,
)

PINNED = ("fixed", "warning")
BUDGETS = (4000, 12000, None)


def _block(kind: str, label: Column, rendered: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), label.alias("label"), rendered.alias("rendered"))


def blocks_of(title: Column, abstract: Column, sections: Column, tables: Column, lost: Column) -> Column:
    """A parsed paper as array<struct<kind, label, rendered>>: title and abstract, sections, tables, the warning."""
    fixed = _block("fixed", F.lit("title_abstract"), F.concat(F.lit("TITLE: "), title, F.lit("\nABSTRACT: "), abstract))

    def section(s: Column) -> Column:
        return _block("section", s["header"], F.concat(F.lit("\n=== SECTION: "), s["header"], F.lit(" ===\n"), s["text"]))

    def table(t: Column) -> Column:
        label = F.concat(t["label"], F.lit(" - "), t["caption"])
        return _block("table", label, F.concat(F.lit("\n=== TABLE: "), label, F.lit(" ===\n"), t["text"]))

    notice = F.concat(F.lit(WARNING[0]), F.array_join(lost, "; "), F.lit(WARNING[1]))
    warning = F.when(F.size(lost) > 0, F.array(_block("warning", F.lit("aviso_parsing"), notice)))
    return F.concat(F.array(fixed), F.transform(sections, section), F.transform(tables, table), F.coalesce(warning, F.array()))


def segment(papers: DataFrame) -> DataFrame:
    """Parsed papers (paper_id, title, abstract, sections, tables, empty_table_labels) -> one row per block."""
    parts = blocks_of(*(F.col(c) for c in ("title", "abstract", "sections", "tables", "empty_table_labels")))
    rows = papers.select("paper_id", F.posexplode(parts).alias("block_pos", "b"))
    return rows.select("paper_id", "block_pos", "b.kind", "b.label", "b.rendered")


def block_score(kind: Column, rendered: Column) -> Column:
    """Weighted pattern counts, up to threefold for tables dense in digits; infinite for pinned kinds."""
    score = 3.0 * matches(rendered, METRIC_PATTERN) + 2.0 * matches(rendered, MODEL_PATTERN) + 1.0 * matches(rendered, ANCHOR_PATTERN)
    dense = 1.0 + F.least(digit_density(rendered) * 10, F.lit(2.0))
    return F.when(kind.isin(*PINNED), F.lit(float("inf"))).when(kind == "table", score * dense).otherwise(score)


def render(blocks: Column, notice: bool = True) -> Column:
    """The blocks as one text, without the notice about lost tables if that is not wanted."""
    if not notice:
        blocks = F.filter(blocks, lambda b: b["kind"] != "warning")
    return F.array_join(F.transform(blocks, lambda b: b["rendered"]), "\n")


def window_of_papers(papers: DataFrame, budget: int | None) -> DataFrame:
    """:func:`select_window` of the blocks of parsed papers, which stay in their papers' rows: nothing is shuffled."""
    parts = blocks_of(*(F.col(c) for c in ("title", "abstract", "sections", "tables", "empty_table_labels")))
    items = F.transform(parts, lambda b, i: F.struct(i.alias("pos"), b["kind"].alias("kind"), b["rendered"].alias("rendered")))
    return _filled(papers.select("paper_id", items.alias("items")), budget)


def select_window(blocks: DataFrame, budget: int | None) -> DataFrame:
    """(paper_id, block_pos, kind, rendered, ...) -> (paper_id, blocks, used_tokens, window) under a token budget.

    Pinned blocks are in, at the cost of their joint text. Of the others the best scored come first, ties in
    document order; one that does not fit is passed over and the next is tried. The window keeps document order.
    No budget takes all.
    """
    item = F.struct(F.col("block_pos").alias("pos"), "kind", "rendered")
    return _filled(blocks.groupBy("paper_id").agg(F.array_sort(F.collect_list(item)).alias("items")), budget)


def _filled(papers: DataFrame, budget: int | None) -> DataFrame:
    """``papers`` (paper_id, items array<struct<pos, kind, rendered>> by pos) with their windows.

    Blocks are chosen by numbers alone, their places, ranks and costs; texts are fetched by the places chosen, at last.
    """
    if budget is None:
        chosen = papers.withColumn("blocks", F.col("items")).withColumn("window", render(F.col("blocks")))
        return chosen.select("paper_id", "blocks", estimated_tokens(F.col("window")).alias("used_tokens"), "window")

    def numbers(b: Column, i: Column) -> Column:
        pinned = b["kind"].isin(*PINNED)
        rank = F.when(pinned, F.lit(0.0)).otherwise(-block_score(b["kind"], b["rendered"]))
        return F.struct(rank.alias("rank"), i.alias("at"), estimated_tokens(b["rendered"]).alias("cost"), pinned.alias("pinned"), F.length(b["rendered"]).alias("size"))

    def fill(all_: Column) -> Column:
        pinned, open_ = F.filter(all_, lambda b: b["pinned"]), F.array_sort(F.filter(all_, lambda b: ~b["pinned"]))
        joined = F.aggregate(pinned, F.lit(0), lambda n, b: n + b["size"]) + F.greatest(F.size(pinned) - 1, F.lit(0))
        start = F.struct(F.floor(joined / 3).cast("int").alias("used"), F.transform(pinned, lambda b: b["at"]).alias("chosen"))

        def take(state: Column, b: Column) -> Column:
            grown = F.struct((state["used"] + b["cost"]).alias("used"), F.array_append(state["chosen"], b["at"]).alias("chosen"))
            return F.when(state["used"] + b["cost"] <= budget, grown).otherwise(state)

        return F.aggregate(open_, start, take)

    filled = papers.withColumn("fill", let(F.transform("items", numbers), fill))
    filled = filled.withColumn("blocks", F.transform(F.array_sort("fill.chosen"), lambda i: F.get(F.col("items"), i)))
    return filled.select("paper_id", "blocks", F.col("fill.used").alias("used_tokens"), render(F.col("blocks")).alias("window"))


def screening_text(abstract: Column, full: Column) -> Column:
    """The abstract, or the full text where it is blank."""
    return F.when(collapse_ends(abstract) != "", abstract).otherwise(full)


def climb_ladder(answers: DataFrame, levels: int = len(BUDGETS)) -> DataFrame:
    """Extractions tried at rising budgets (paper_id, level, records, ...) -> the first with a record, else the last level."""
    found = F.min_by(F.struct("*"), F.when(F.size("records") > 0, F.col("level")).otherwise(F.col("level") + levels * 2))
    last = F.max_by(F.struct("*"), F.col("level"))
    picked = answers.groupBy("paper_id").agg(found.alias("f"), last.alias("l"))
    chosen = F.when(F.size("f.records") > 0, F.col("f")).otherwise(F.col("l"))
    return picked.select(chosen.alias("c")).select("c.*").withColumnRenamed("level", "fallback_level")
