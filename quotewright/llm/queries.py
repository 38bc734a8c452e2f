"""The queries of this subpackage: each applies one operator to its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm.common import table
from quotewright.llm.divergence import source_divergence
from quotewright.llm.line_dedup import drop_spread_lines
from quotewright.llm.lm_interpolation import interpolated_scores
from quotewright.llm.mixing import mix_sources
from quotewright.llm.packing import pack_documents
from quotewright.llm.quality_model import classify
from quotewright.llm.quality_rules import BOILERPLATE, clean_lines
from quotewright.llm.resampling import importance_resample
from quotewright.llm.revisit import TRACKING, resolve_revisits
from quotewright.llm.simhash import simhash_groups
from quotewright.llm.suffix_dedup import remove_repeats
from quotewright.llm.topk import exact_top_k
from quotewright.llm.word_bpe import decode_ids, encode_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"), length=100)
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return clean_lines(table(spark, sf_dir, "documents")).select("doc_id", *counts)


ORACLE_SQL["op3_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM w) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest(range(0, 5)) AS o) GROUP BY doc_id),
l AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS f,
         array_to_string(list_filter(ls, lambda x: NOT (
             len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) > 0
             AND (5 * len(regexp_extract_all(x, '[#*$%&|<>!{{}}~^=]')) > len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))
                  OR NOT regexp_matches(x, '\p{{L}}')
                  OR len(regexp_extract_all(x, ' [|»›·•] ')) >= 2
                  OR regexp_matches(lower(x), '{"|".join(BOILERPLATE)}')))), chr(10)) AS clean
  FROM d),
b AS (
  SELECT l.doc_id, n_words, word_chars, n_symbols, len(f) - len(list_distinct(f)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, length(regexp_replace(clean, '[\x20\x09-\x0D]+', '', 'g')) AS left_chars
  FROM l LEFT JOIN rep ON l.doc_id = rep.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND left_chars >= 0.5 * word_chars AS kept
FROM b
"""


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "block", "release", "deadline", "slot")


ORACLE_SQL["op4_mixing"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, ((doc_id % 2147483648) * 2654435761) % 4294967296 AS m FROM documents),
b AS (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY m, doc_id) - 1) // 4 AS block FROM d),
w AS (SELECT source, sqrt(count(*)) AS weight FROM d GROUP BY source),
s AS (SELECT source, CAST(sum(share) OVER () AS BIGINT) AS period, share
      FROM (SELECT source, greatest(1, CAST(floor(weight * greatest(1000, 4 * count(*) OVER ()) / sum(weight) OVER () + 0.5) AS BIGINT)) AS share FROM w)),
i AS (SELECT source, period, CAST(share AS BIGINT) AS share, row_number() OVER (ORDER BY source) AS idx FROM s),
a AS (SELECT list(share ORDER BY idx) AS a, CAST(max(period) AS BIGINT) AS period FROM i),
sim(t, done, pick, k) AS (
  SELECT CAST(0 AS BIGINT), list_transform(a, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM a
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(done) + 1), lambda j: done[j] + CASE WHEN j = p THEN 1 ELSE 0 END), p, done[p]
  FROM (SELECT t, done, list_min(list_transform(range(1, len(a) + 1), lambda j:
                 CASE WHEN done[j] < a[j] AND (done[j] * period) // a[j] <= t
                      THEN (((done[j] + 1) * period + a[j] - 1) // a[j]) * 1000000 + j END)) % 1000000 AS p
        FROM sim, a WHERE t < period)),
slots AS (SELECT i.source, i.share, i.period, sim.k, sim.t - 1 AS place FROM sim JOIN i ON i.idx = sim.pick WHERE sim.t > 0)
SELECT b.doc_id, b.source, b.block,
       b.block // share * period + (k * period) // share AS release,
       b.block // share * period + ((k + 1) * period + share - 1) // share AS deadline,
       b.block // share * period + place AS slot
FROM b JOIN slots ON slots.source = b.source AND slots.k = b.block % slots.share
"""


@query
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


ORACLE_SQL["op5_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, p.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_spread_lines(table(spark, sf_dir, "documents"), least_sites=8)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


ORACLE_SQL["op6_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, source, i, ls[i] AS raw, regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
  FROM (SELECT doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents))),
spread AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 8),
k AS (
  SELECT doc_id, count(*) AS n_lines, count(spread.line) AS hits,
         coalesce(string_agg(CASE WHEN spread.line IS NULL THEN raw END, chr(10) ORDER BY i), '') AS kept
  FROM l LEFT JOIN spread ON spread.line = l.line GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(hits, 0) AS n_removed,
       length(CASE WHEN hits > 0 THEN kept ELSE text END) AS kept_chars, md5(CASE WHEN hits > 0 THEN kept ELSE text END) AS kept_md5
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
"""


def captures(pages: DataFrame) -> DataFrame:
    """WARC records made from the pages: of each page a response and three revisits, two of them by another spelling
    of its URL, one of these with another validator, one before the response."""
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    rows = pages.select("page_id", "url", tag.alias("tag"), day.alias("day"), F.md5("html").alias("payload"), F.explode(F.array(*map(F.lit, range(4)))).alias("n"))
    late = F.expr("page_id * 10 + CASE n WHEN 0 THEN 0 WHEN 1 THEN 15 WHEN 2 THEN 25 ELSE -5 END")
    return rows.withColumn("ts", late).select(
        (F.col("page_id") * 4 + F.col("n")).alias("record_id"),
        F.expr("CASE n WHEN 1 THEN concat(url, '#again') WHEN 2 THEN replace(url, 'http:', 'https:') ELSE url END").alias("url"),
        "ts",
        F.expr("IF(n = 0, 'response', 'revisit')").alias("kind"),
        F.expr("CASE n WHEN 0 THEN tag WHEN 1 THEN concat('W/', tag) WHEN 3 THEN '\"none\"' END").alias("etag"),
        F.when(F.col("n") != 1, F.col("day")).alias("last_modified"),
        F.expr(
            """IF(n = 0, map('Content-Type', 'text/html', 'ETag', tag, 'Date', concat('t', ts)),
                  map('Date', concat('t', ts), 'Content-Length', '0', 'Vary', 'Accept'))"""
        ).alias("headers"),
        F.when(F.col("n") == 0, F.col("payload")).alias("payload"),
    )


@query
def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    headers = F.array_join(F.transform("headers", lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return resolved.select("record_id", "canonical_url", "ts", "resolved_id", "verdict", headers.alias("headers"), "payload")


_HOST = r"regexp_replace(lower(regexp_extract(rest, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g')"
_PATH = r"regexp_replace(regexp_extract(rest, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?]*([^?]*)', 1), '/+$', '')"
_PARAMS = rf"""list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
               lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}')))"""
ORACLE_SQL["op7_revisits"] = rf"""
WITH n AS (SELECT unnest([0, 1, 2, 3]) AS n),
p AS (
  SELECT page_id, n, '"' || substr(md5(html), 1, 16) || '"' AS tag, 'day ' || CAST(page_id % 28 AS VARCHAR) AS day, md5(html) AS body,
         page_id * 10 + CASE n WHEN 0 THEN 0 WHEN 1 THEN 15 WHEN 2 THEN 25 ELSE -5 END AS ts,
         regexp_replace(trim(CASE n WHEN 1 THEN url || '#again' WHEN 2 THEN replace(url, 'http:', 'https:') ELSE url END), '#.*$', '') AS rest
  FROM pages, n),
c AS (
  SELECT page_id * 4 + n AS record_id, n, tag, day, body, ts,
         {_HOST} || {_PATH} || CASE WHEN len({_PARAMS}) > 0 THEN '?' || array_to_string({_PARAMS}, '&') ELSE '' END AS canonical_url
  FROM p),
r AS (
  SELECT v.record_id, v.n, v.canonical_url, v.ts, v.tag AS own_tag, v.day AS own_day,
         a.record_id AS found, a.tag, a.day, a.body, a.ts AS found_ts,
         row_number() OVER (PARTITION BY v.record_id ORDER BY a.ts DESC NULLS LAST, a.record_id DESC) AS nth
  FROM c v LEFT JOIN c a ON a.n = 0 AND a.canonical_url = v.canonical_url AND a.ts < v.ts
  WHERE v.n > 0),
j AS (
  SELECT *, CASE WHEN found IS NULL THEN 'no-response'
                 WHEN n = 1 THEN CASE WHEN own_tag = tag THEN 'etag' ELSE 'mismatch' END
                 WHEN n = 3 THEN 'mismatch'
                 WHEN own_day = day THEN 'last-modified' ELSE 'mismatch' END AS verdict
  FROM r WHERE nth = 1)
SELECT record_id, canonical_url, ts, CASE WHEN verdict IN ('etag', 'last-modified') THEN found END AS resolved_id, verdict,
       CASE WHEN verdict IN ('etag', 'last-modified') THEN 'content-type=text/html;date=t' || ts || ';etag=' || tag || ';vary=Accept'
            ELSE 'content-length=0;date=t' || ts || ';vary=Accept' END AS headers,
       CASE WHEN verdict IN ('etag', 'last-modified') THEN body END AS payload
FROM j
"""


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = interpolated_scores(table(spark, sf_dir, "documents"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), words=3, distance=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    judged = classify(table(spark, sf_dir, "documents"), trusted)
    return judged.select("doc_id", "lang", "n_tokens", "log10_prob", "perplexity", "threshold", "kept")


@query
def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    encoded = encode_texts(table(spark, sf_dir, "documents"), tokenizer)
    kept = encoded.select(F.struct("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256")).alias("row"), "ids")
    decoded = decode_ids(kept, tokenizer, id_col="row")
    return decoded.select("row.*", F.sha2("text", 256).alias("decoded_sha256"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 of a word: the remainders of all bytes, by their rule, then the word's bytes folded.
_CRC_STEP = "xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL["op11_importance_resampling"] = rf"""
WITH RECURSIVE c(i, k, r) AS (
  SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, {_CRC_STEP} FROM c WHERE k < 8),
crc AS (SELECT list(r ORDER BY i) AS tab FROM c WHERE k = 8),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
h AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM d UNION SELECT w FROM b)),
k AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(x), 2), lambda p: CAST('0x' || x[p : p + 1] AS BIGINT))),
                lambda a, y: xor(a >> 8, tab[(xor(a, y) % 256) + 1])), 4294967295) % 10000 AS bucket
  FROM h, crc),
s AS (SELECT bucket, count(*) AS s FROM d JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN k USING (w) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM d) AS s_all, (SELECT count(*) FROM b) AS t_all),
g AS (
  SELECT s.bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) AS DOUBLE) * (s_all + 10000) / (CAST((s + 1) AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t ON t.bucket = s.bucket, n),
f AS (
  SELECT doc_id, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM d JOIN k USING (w) JOIN g USING (bucket) GROUP BY doc_id),
r AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM documents LEFT JOIN f USING (doc_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, sum((n_features >= 20)::INT) OVER () AS n FROM r)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN n_features >= 20 AND place <= (10 * n) // 100 THEN place END AS BIGINT) AS rank FROM o
"""


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE_SQL["op13_source_divergence"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
w AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
ls AS (SELECT d.lang, CAST(count(k.term) AS HUGEINT) AS v, CAST(coalesce(sum(k.n), 0) AS HUGEINT) AS total
       FROM (SELECT DISTINCT lang FROM d) d LEFT JOIN kept k ON k.lang = d.lang GROUP BY d.lang),
c AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN kept ON kept.lang = w.lang AND kept.term = w.term GROUP BY ALL),
g AS (SELECT x.lang, x.source, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS total
      FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN c ON c.lang = x.lang AND c.source = x.source GROUP BY x.lang, x.source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + ls.v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 1)) // (ls.total + ls.v) AS q
  FROM g JOIN ls ON ls.lang = g.lang JOIN kept ON kept.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
             FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
