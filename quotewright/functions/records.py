"""Schemas and vocabularies of extracted records."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields of a model record, in the orders in which they are reported.
EVIDENCE_FIELDS = (
    "model_used", "sample_size", "default_rate", "variables_used", "auc", "accuracy",
    "f1_score", "recall", "specificity", "standard_deviation", "standard_error",
)
NUMERIC_FIELDS = (
    "sample_size", "default_rate", "auc", "accuracy", "f1_score",
    "recall", "specificity", "standard_deviation", "standard_error",
)
TEXT_FIELDS = ("model_used", "variables_used")
CATEGORICAL_FIELDS = (
    "model_class", "baseline", "type_data_used", "financial",
    "productive", "climatic", "hybrid", "agricultural_context",
)
PROPORTIONS = ("default_rate", "accuracy", "f1_score", "recall", "specificity")
DEDUP_METRICS = ("auc", "accuracy", "f1_score", "recall", "specificity")

# Closed vocabularies.
MODEL_CLASSES = (
    "logistic_regression", "linear_regression", "discriminant_analysis", "decision_tree", "random_forest",
    "gradient_boosting", "svm", "neural_network", "deep_learning", "naive_bayes", "knn", "ensemble_other",
    "bayesian_model", "survival_model", "other_statistical", "other",
)
DATA_TYPES = ("financial", "productive", "climatic", "hybrid")
CONTEXTS = ("small", "medium", "large", "not_reported", "mixed")
YES_NO = ("yes", "no", "not_reported")
DECISIONS = ("include_review_and_metaanalysis", "include_review_only", "exclude")
EXTRACTION_STATUSES = ("pending", "done", "failed", "not_applicable")

# Codes of the screening criteria by list.
CRITERIA = {
    "inclusion_criteria_met": tuple(f"I{i}" for i in range(1, 9)),
    "exclusion_criteria_met": tuple(f"E{i}" for i in range(1, 12)),
    "metaanalysis_inclusion_criteria_met": tuple(f"M{i}" for i in range(1, 8)),
    "metaanalysis_exclusion_criteria_met": tuple(f"ME{i}" for i in range(1, 7)),
}
ALL_CODES = tuple(code for codes in CRITERIA.values() for code in codes)

# The notice about tables whose content was lost, around their labels.
WARNING = (
    "\n=== AVISO DE PARSING ===\nAs seguintes tabelas foram identificadas no PDF mas o parser NAO conseguiu "
    "extrair o conteudo numerico delas (vieram vazias): ",
    ". Os valores dessas tabelas podem ainda aparecer em texto corrido nas secoes "
    "de resultados/discussao/comparacao acima -- procure ativamente por eles la "
    "antes de considerar um dado como nao reportado.",
)

EVIDENCE = T.StructType([T.StructField(n, T.StringType()) for n in ("value", "quote", "source_section")])
#: A record's fields in order: evidence where it carries a quote, else a word of a vocabulary.
RECORD = T.StructType(
    [
        T.StructField(n, EVIDENCE if n in EVIDENCE_FIELDS else T.StringType())
        for n in (
            "model_used", "model_class", "baseline", "sample_size", "default_rate", "type_data_used", "financial",
            "productive", "climatic", "hybrid", "variables_used", "agricultural_context", "auc", "accuracy",
            "f1_score", "recall", "specificity", "standard_deviation", "standard_error", "extraction_notes",
        )
    ]
)
EXTRACTION = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("records", T.ArrayType(RECORD)),
        T.StructField("extraction_warnings", T.ArrayType(T.StringType())),
    ]
)
CRITERION = T.StructType([T.StructField(n, T.StringType()) for n in ("code", "quote", "note")])
SCREENING = T.StructType(
    [T.StructField("paper_id", T.StringType()), T.StructField("decision", T.StringType())]
    + [T.StructField(n, T.ArrayType(CRITERION)) for n in CRITERIA]
    + [T.StructField("justification", T.StringType()), T.StructField("screening_warnings", T.ArrayType(T.StringType()))]
)
DIVERGENCE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("field_name", "value_a", "value_b")]
    + [T.StructField("diverges", T.BooleanType()), T.StructField("detail", T.StringType())]
)
COMPARISON = T.StructType(
    [T.StructField("index_a", T.IntegerType()), T.StructField("index_b", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("model_used_a", "model_used_b")]
    + [T.StructField("match_score", T.DoubleType()), T.StructField("divergences", T.ArrayType(DIVERGENCE))]
)
RESOLUTION = T.StructType(
    [T.StructField("index_a", T.IntegerType()), T.StructField("field_name", T.StringType()), T.StructField("choice", T.StringType())]
)
FIELD_RESULT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("field_name", "value", "quote")]
    + [T.StructField("verified", T.BooleanType()), T.StructField("similarity", T.DoubleType()), T.StructField("reason", T.StringType())]
)
VERIFICATION = T.StructType(
    [
        T.StructField("record_index", T.IntegerType()),
        T.StructField("model_used", T.StringType()),
        T.StructField("all_verified", T.BooleanType()),
        T.StructField("unverified_fields", T.ArrayType(T.StringType())),
        T.StructField("field_results", T.ArrayType(FIELD_RESULT)),
    ]
)
CHECKPOINT = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("source_text_len", T.LongType()),
        T.StructField("estimated_prompt_tokens", T.LongType()),
        T.StructField("fallback_level", T.IntegerType()),
        T.StructField("timing", T.StructType([T.StructField(n, T.DoubleType()) for n in ("grobid_s", "extraction_a_s", "extraction_b_s", "arbiter_s", "total_s")])),
        T.StructField("empty_table_labels", T.ArrayType(T.StringType())),
        T.StructField("extraction_a", EXTRACTION),
        T.StructField("extraction_b", EXTRACTION),
        T.StructField("extraction_reconciled", EXTRACTION),
        T.StructField("arbiter_resolutions", T.ArrayType(RESOLUTION)),
        T.StructField("record_count_mismatch", T.BooleanType()),
        T.StructField("comparisons", T.ArrayType(COMPARISON)),
        T.StructField("verifications", T.ArrayType(VERIFICATION)),
    ]
)
PARTIAL_CHECKPOINT = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("source_text", T.StringType()),
        T.StructField("extraction_a", EXTRACTION),
        T.StructField("fallback_level", T.IntegerType()),
    ]
)
REGISTRY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("record_id", "doi", "fulltext_status", "extraction_status", "updated_at")]
    + [
        T.StructField("fulltext", T.StructType([T.StructField("pdf_path", T.StringType())])),
        T.StructField("metadata", T.StructType([T.StructField(n, T.StringType()) for n in ("year", "author", "journal", "country", "latitude", "longitude")])),
        T.StructField(
            "extraction",
            T.StructType(
                [
                    T.StructField("checkpoint_path", T.StringType()),
                    T.StructField("n_models_extracted", T.IntegerType()),
                    T.StructField("needs_review", T.BooleanType()),
                    T.StructField("extracted_at", T.StringType()),
                ]
            ),
        ),
    ]
)
PARSED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "abstract")]
    + [
        T.StructField("sections", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("header", "text")]))),
        T.StructField("tables", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("label", "caption", "text")]))),
        T.StructField("empty_table_labels", T.ArrayType(T.StringType())),
    ]
)
#: What an arbiter answers.
ARBITRATION = T.StructType([T.StructField("decisions", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("field_name", "choice")])))])


#: The words that fields of answers may hold.
WORDS = {
    "model_class": MODEL_CLASSES, "type_data_used": DATA_TYPES, "agricultural_context": CONTEXTS, "decision": DECISIONS, "choice": ("a", "b", "neither"),
} | {f: YES_NO for f in ("baseline", "financial", "productive", "climatic", "hybrid")}


def json_schema(kind: T.DataType, words: dict[str, tuple[str, ...]] | None = WORDS) -> dict:
    """``kind`` as JSON Schema: structs are objects without other properties, all of their fields required, anything but a struct or an
    array may be null; the strings of a field named in ``words`` are of that vocabulary."""

    def of(kind: T.DataType, name: str = "") -> dict:
        if isinstance(kind, T.StructType):
            fields = {f.name: of(f.dataType, f.name) for f in kind}
            return {"type": "object", "properties": fields, "required": list(fields), "additionalProperties": False}
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": of(kind.elementType, name)}
        plain = "boolean" if isinstance(kind, T.BooleanType) else "integer" if isinstance(kind, T.IntegralType) else "number" if isinstance(kind, T.NumericType) else "string"
        known = (words or {}).get(name)
        return {"type": [plain, "null"]} | ({"enum": [*known, None]} if known else {})

    return of(kind)
