"""Repeated records of one model inside a paper."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.functions.fuzzy import similar_names
from quotewright.functions.numbers import number_in, scaled_value, unscaled_value
from quotewright.functions.records import DEDUP_METRICS, EVIDENCE_FIELDS, RECORD

NAME_THRESHOLD = 90.0
METRIC_TOLERANCE = 0.02
#: Pairs of records that are compared one by one.
FEW = 64


def filled_fields(record: Column) -> Column:
    """Evidence fields with a value and other fields that are not null."""
    parts = [record[f.name]["value"] if f.name in EVIDENCE_FIELDS else record[f.name] for f in RECORD]
    total = F.lit(0)
    for p in parts:
        total = total + p.isNotNull().cast("int")
    return total


class _Sets:
    """Disjoint sets of places; the smallest place stands for its set."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.root[max(a, b)] = min(a, b)


def _near(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    return ~(np.abs(x - y) / np.maximum(np.maximum(np.abs(x), np.abs(y)), 1e-9) > tolerance)


def _spans(x: np.ndarray, y: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``x`` where the values within the tolerance begin and end in ``y``; both ascend. Below a tolerance of one they are a run."""
    if tolerance >= 1:
        return np.zeros(len(x), np.int64), np.full(len(x), len(y))
    wide = np.maximum(np.abs(x) / (1 - tolerance), 1e-9) * tolerance * (1 + 1e-9) + 1e-15
    lo, hi = np.searchsorted(y, x - wide, "left"), np.searchsorted(y, x + wide, "right")
    for end, step in ((lo, 1), (hi, -1)):  # the ends to the bit, as the rule rounds
        while True:
            far = np.flatnonzero(lo < hi)
            far = far[~_near(x[far], y[end[far] - (step < 0)], tolerance)]
            if not len(far):
                break
            end[far] += step
    return lo, hi


def _link(sets: _Sets, one: np.ndarray, two: np.ndarray, numbers: np.ndarray, common: list[int], tolerance: float) -> None:
    """Joins places of ``one`` and ``two`` that agree in all ``common`` metrics, where all of them have numbers.

    In one metric, what agrees with a value is a run of the sorted others, so a run's neighbours are joined once, without its pairs.
    With more metrics, runs of the most selective one are held against the others.
    """
    if not common:
        for i in (*one.tolist(), *two.tolist()):
            sets.join(int(one[0]), i)
        return
    if len(one) * len(two) <= FEW:
        rows = [(j, [float(numbers[j, m]) for m in common]) for j in two.tolist()]
        for i in one.tolist():
            own = [float(numbers[i, m]) for m in common]
            for j, other in rows:
                if not any(abs(x - y) / max(abs(x), abs(y), 1e-9) > tolerance for x, y in zip(own, other)):
                    sets.join(i, j)
        return
    best = None
    for m in common:
        a, b = one[np.argsort(numbers[one, m], kind="stable")], two[np.argsort(numbers[two, m], kind="stable")]
        lo, hi = _spans(numbers[a, m], numbers[b, m], tolerance)
        size = int((hi - lo).sum())
        if best is None or size < best[0]:
            best = size, a, b, lo, hi
    _, a, b, lo, hi = best
    if len(common) == 1 and tolerance < 1:
        done = 0  # runs begin and end in ascending order
        for i, l, r in zip(a.tolist(), lo.tolist(), hi.tolist()):
            if l < r:
                sets.join(i, int(b[l]))
                for j in range(max(l, done), r - 1):
                    sets.join(int(b[j]), int(b[j + 1]))
                done = max(done, r - 1)
        return
    for i, l, r in zip(a.tolist(), lo.tolist(), hi.tolist()):
        others = b[l:r]
        for j in others[_near(numbers[i][common], numbers[others][:, common], tolerance).all(1)].tolist():
            sets.join(i, j)


def _labels_of(names: list[str], given: np.ndarray, numbers: np.ndarray, threshold: float, tolerance: float) -> list[int]:
    """The smallest position that a chain of duplicates reaches from each record. Duplicates have similar names and a common metric, and
    none that differs; where a number is missing, it does not differ. Records with one name and the same numbers are taken once."""
    sets = _Sets(len(names))
    held = ~np.isnan(numbers)
    kinds = given * (1 << numbers.shape[1]) + held @ (1 << np.arange(numbers.shape[1]))
    distinct: dict[int, dict[int, np.ndarray]] = {}

    def groups(at: list[int]) -> dict[int, np.ndarray]:
        """Of the records of a name, those that are alike joined and one of each kept, by which metrics they give."""
        if at[0] not in distinct:
            first: dict[tuple[int, bytes], int] = {}
            for i in at:
                if given[i]:
                    one = first.setdefault((int(kinds[i]), (numbers[i] + 0.0).tobytes()), i)
                    sets.join(one, i)
            by: dict[int, list[int]] = {}
            for (kind, _), i in first.items():
                by.setdefault(kind, []).append(i)
            distinct[at[0]] = {kind: np.array(i) for kind, i in by.items()}
        return distinct[at[0]]

    width = numbers.shape[1]
    for _, at, bt in similar_names(names, None, threshold):
        for p, one in groups(at).items():
            for q, two in groups(bt).items():
                if (p >> width) & (q >> width):
                    _link(sets, one, two, numbers, [m for m in range(width) if p & q & (1 << m)], tolerance)
    return [sets.find(i) for i in range(len(names))]


def _labels(names: pa.Array, given: pa.Array, numbers: pa.Array, threshold: float, tolerance: float) -> pa.Array:
    """The labels of each paper, one paper after the other."""
    flat, ends = [np.zeros(0, np.int32)], [0]
    for n, g, x in zip(names, given, numbers):
        values = x.values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(DEDUP_METRICS), -1).T
        labels = _labels_of(n.as_py(), g.values.to_numpy(zero_copy_only=False).astype(np.int64), values, threshold, tolerance)
        flat.append(np.array(labels, np.int32))
        ends.append(ends[-1] + len(labels))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))


def label_duplicates(papers: DataFrame, threshold: float = NAME_THRESHOLD, tolerance: float = METRIC_TOLERANCE) -> DataFrame:
    """``papers`` with label, array<int> beside records. Numbers are parsed natively; only names and doubles go to the UDF,
    and no shuffle is made."""
    records = F.coalesce("records", F.array().cast(records_type()))
    given = lambda r: sum((r[m]["value"].isNotNull().cast("int") * (1 << i) for i, m in enumerate(DEDUP_METRICS)), F.lit(0))

    def numbers(m: str) -> Column:
        """Step by step over the records: the rule for Python UDFs doesn't take lambdas inside lambdas."""
        raw = F.transform(records, lambda r: r[m]["value"])
        return F.zip_with(raw, F.transform(F.transform(raw, number_in), lambda x: unscaled_value(x)), scaled_value)

    columns = (
        F.transform(records, lambda r: F.coalesce(r["model_used"]["value"], F.lit(""))),
        F.transform(records, given),
        F.array(*map(numbers, DEDUP_METRICS)),
    )
    return papers.withColumn("label", F.arrow_udf(lambda n, g, x: _labels(n, g, x, threshold, tolerance), "array<int>")(*columns))


def _groups(labels: pa.Array, filled: pa.Array) -> pa.Array:
    """Of each paper the groups by label: members, and the first of those with the most filled fields."""
    out = []
    for own, counts in zip(labels, filled):
        groups: dict[int, list[int]] = {}
        for i, label in enumerate(own.as_py()):
            groups.setdefault(label, []).append(i)
        n = counts.as_py()
        out.append([{"m": groups[g], "best": max(groups[g], key=lambda i: (n[i], -i))} for g in sorted(groups)])
    return pa.array(out, pa.list_(pa.struct([("m", pa.list_(pa.int32())), ("best", pa.int32())])))


def records_type() -> str:
    return f"array<{RECORD.simpleString()}>"


def deduplicate(papers: DataFrame, threshold: float = NAME_THRESHOLD, tolerance: float = METRIC_TOLERANCE) -> DataFrame:
    """Papers (paper_id, records, extraction_warnings) with one record per model and a warning per collapsed group.

    A group keeps the record with the most filled fields, the first of equals, at the place of its first member.
    """
    rows = label_duplicates(papers, threshold, tolerance).withColumnRenamed("label", "_label")
    name = lambda i: F.get(F.col("records"), i)["model_used"]["value"]
    filled = F.transform(F.coalesce("records", F.array().cast(records_type())), filled_fields)
    rows = rows.withColumn("_groups", F.arrow_udf(_groups, "array<struct<m:array<int>,best:int>>")(F.col("_label"), filled))

    def warning(g: Column) -> Column:
        dropped = F.filter(g["m"], lambda i: i != g["best"])
        names = F.array_join(F.transform(dropped, lambda i: F.when(F.coalesce(name(i), F.lit("")) == "", "?").otherwise(name(i))), ", ")
        return F.concat(
            F.lit("Deduplicacao: "), F.size(dropped).cast("string"), F.lit(" registro(s) de '"), F.coalesce(name(g["best"]), F.lit("None")),
            F.lit("' considerados duplicatas do mesmo modelo (nomes: "), names,
            F.lit(") e descartados -- mantido o registro com mais campos preenchidos. Revisar se sao de fato o mesmo modelo."),
        )

    said = F.transform(F.filter("_groups", lambda g: F.size(g["m"]) > 1), warning)
    kept = F.transform("_groups", lambda g: F.get(F.col("records"), g["best"]))
    out = rows.withColumn("extraction_warnings", F.concat(F.coalesce("extraction_warnings", F.array().cast("array<string>")), said))
    return out.withColumn("records", F.when(F.size("records") > 1, kept).otherwise(F.col("records"))).drop("_label", "_groups")
