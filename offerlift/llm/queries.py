"""One query per corpus operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlift.llm import (
    fingerprints,
    negatives,
    packing,
    pieces,
    pii,
    quality,
    secrets,
    simhash,
    suffixes,
    tokens,
    topk,
    toxicity,
    variants,
)
from offerlift.llm.texts import documents, text_or_empty
from offerlift.sources.workspace import new_path

QUERIES = {}
#: DuckDB twins, where SQL can say the same.
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, index)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )


@query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_bytes(documents(spark, sf_dir))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its pseudonyms, and how many values of each kind it had."""
    made = pii.pseudonymise(documents(spark, sf_dir), counts="found")
    return made.select("doc_id", "text", *[F.col(f"found.{k}").alias(f"n_{k}") for k in pii.KINDS])


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first scan of the table, with a ledger of its own."""
    found = secrets.scan(documents(spark, sf_dir), new_path(spark, "ledger"))
    counts = [
        F.expr(f"cast(size(filter(findings, f -> f.kind = '{r.kind}')) as long)").alias(f"n_{r.kind}")
        for r in secrets.BASE
    ]
    spans = F.expr(
        "array_join(transform(findings, f -> concat_ws(':', f.kind, cast(f.start as string),"
        " cast(f.end as string))), ',')"
    )
    return found.select(
        "doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )


def _secret_kind(kind: str, pattern: str, group: int, least: int, rank: int) -> str:
    return f"""
  SELECT doc_id, '{kind}' kind, {rank} rank, m.s s, m.s + m.n e FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(f) + 1), lambda i: {{
        's': list_sum(list_transform(p[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0),
        'n': length(f[i]), 'g': length(g[i])}})) m
    FROM (SELECT doc_id, string_split_regex(t, '{pattern}') p,
        regexp_extract_all(t, '{pattern}') f, regexp_extract_all(t, '{pattern}', {group}) g
      FROM (SELECT doc_id, coalesce(text, '') t FROM documents)))
  WHERE m.g >= {least}"""


ORACLES["op3_secret_scans"] = f"""
WITH found AS ({" UNION ALL ".join(
    _secret_kind(r.kind, r.pattern.replace("'", "''"), r.group, r.least, i)
    for i, r in enumerate(secrets.BASE))}),
texts AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') n_assign,
    count(*) FILTER (kind = 'access') n_access, count(*) FILTER (kind = 'hex') n_hex,
    string_agg(concat_ws(':', kind, s::BIGINT, e::BIGINT), ',' ORDER BY s, rank) spans
  FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access,
  coalesce(n_hex, 0) n_hex, sha256(coalesce(spans, '')) base_sha256, coalesce(spans, '') spans
FROM documents LEFT JOIN texts USING (doc_id)"""


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(documents(spark, sf_dir))


_WORD = r"[^\x20\x09-\x0D]+"
ORACLES["op5_quality_rules"] = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{_WORD}') w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '{_WORD}')) lines
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) n
  FROM (SELECT doc_id, unnest(range(len(w) - 7)) i,
      unnest(list_transform(range(len(w) - 7), lambda i: array_to_string(w[i + 1:i + 8], ' '))) v
    FROM texts WHERE len(w) >= 8)),
again AS (
  SELECT doc_id, count(DISTINCT i + o) n FROM windows, range(8) r(o) WHERE n > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w) n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols, len(lines) n_lines,
    len(lines) - len(list_distinct(lines)) n_dup_lines, coalesce(n, 0) n_repeat_words,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) n_stutter,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) n_letters
  FROM texts LEFT JOIN again USING (doc_id)),
verdicts AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words base_failed,
    10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR 10 * n_stutter > 3 * n_words
      OR 2 * n_letters < n_words OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words rejected
  FROM counts)
SELECT doc_id, n_words::BIGINT n_words, word_chars::BIGINT word_chars, n_symbols::BIGINT n_symbols,
  n_dup_lines::BIGINT n_dup_lines, n_repeat_words::BIGINT n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected kept
FROM verdicts"""


@query
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(documents(spark, sf_dir))


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and XXH64 of each text's piece ids, and whether they decode to the text."""
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    path = vocabulary("piece_bpe_32k.model")
    made = pieces.decode(pieces.encode(docs, path, keep=["text"]), path)
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_xxh64"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def _whole_vectors_sql(scale: int, columns: str = "vec_id") -> str:
    return f"""
  SELECT {columns}, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row has a wrong label, as a classifier's mistakes would."""
    moved = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return negatives.hard_negatives(embeddings(spark, sf_dir), label)


_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
ORACLES["op12_hard_negatives"] = f"""
WITH vectors AS ({_whole_vectors_sql(256, f"vec_id, {_LABEL} l")} AND label IS NOT NULL),
scores AS (
  SELECT a.vec_id anchor_id, b.vec_id other, a.l = b.l same,
    list_dot_product(a.v, b.v)::BIGINT score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other positive_id, score positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, other negative_id, positive_score, score negative_score,
  row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER "rank"
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 5"""


@query
def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(embeddings(spark, sf_dir))


ORACLES["op13_exact_top_k"] = f"""
WITH vectors AS ({_whole_vectors_sql(1024)}),
scores AS (
  SELECT a.vec_id query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, vec_id, score,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER "rank"
FROM scores
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10"""
