"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellgrid.llm import (
    infill,
    licenses,
    neardup,
    nndescent,
    packing,
    pieces,
    pii,
    quality,
    resampling,
    sitestyle,
    tokencounts,
    toxicity,
    urlfilter,
)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; ``TOKENIZER_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_toxicity(spark, sf):
    """Score of every document; folds 1 to 4 of the labels are learnt from."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.rated(docs, model).select(
        "doc_id",
        F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
        F.size("passages").alias("n_passages"),
        "evidence",
    )


@query
def op2_minhash_near_dedup(spark, sf):
    """Set size, component and keep decision of every document."""
    return neardup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op3_approximate_neighbours(spark, sf):
    """The 20 nearest found of every vector whose vec_id is divisible by 20."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return nndescent.search(vectors, F.col("vec_id") % 20 == 0)


@query
def op4_license_scan(spark, sf):
    """Licences whose notices occur in a document, with the best Dice coefficient."""
    return licenses.scan(table(spark, sf, "documents"))


def _joined(spans: str) -> str:
    """SQL: kind:start:end of each span, comma-joined."""
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"


@query
def op5_pii(spark, sf):
    """Numbers of base spans, their digest and all spans, of every document."""
    found = pii.found(table(spark, sf, "documents").select("doc_id", "text"))
    base = "filter(spans, x -> x.base)"
    counts = [
        f"CAST(size(filter(spans, x -> x.base AND x.kind = '{k}')) AS BIGINT) AS n_{k}"
        for k in pii.KINDS
    ]
    return found.selectExpr(
        "doc_id",
        *counts,
        f"sha2({_joined(base)}, 256) AS base_sha256",
        f"{_joined('spans')} AS spans",
        f"CAST(size(spans) - size({base}) AS BIGINT) AS n_added",
    )


@query
def op6_quality_rules(spark, sf):
    """Statistics, fixed rules and robust outlier verdict of every document."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return quality.rules(docs).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "distance"
    )


@query
def op7_sentencepiece(spark, sf):
    """Number and checksum of every document's pieces, and whether they decode to the text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pieces.digest(docs, tokenizer_file("piece_bpe_32k.model"))


@query
def op8_html_extraction(spark, sf):
    """Main text of every page."""
    return sitestyle.extract(table(spark, sf, "pages"))


@query
def op9_url_filters(spark, sf):
    """Rule and verdict of every page address."""
    return urlfilter.judge(table(spark, sf, "pages"), URL_RULES)


@query
def op10_best_fit_packing(spark, sf):
    """Every document's token pieces, placed into sequences of 2048 tokens."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"))


@query
def op11_importance_resampling(spark, sf):
    """Features, weight, score and rank of every document, with ``benchmark`` as the target."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return resampling.resampled(docs, table(spark, sf, "benchmark").select("text"))


@query
def op12_token_counts(spark, sf):
    """Bytes and tokens of every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tokencounts.counted(docs, tokenizer_file("byte_bpe_50k.json"))


@query
def op13_fill_in_middle(spark, sf):
    """Form, cuts and digests of every document's transformed and restored text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return infill.transformed(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _notices() -> str:
    """The templates as rows of a VALUES list."""
    texts = [(name, text.replace("'", "''")) for name, text in licenses.templates()]
    return ",\n  ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(texts))


_SQL = {
    "op4_license_scan": rf"""
WITH templates(id, license, notice) AS (VALUES
  {_notices()}),
lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts,
    list_filter(string_split_regex(text, '\n[ \t\r]*\n'), lambda x: regexp_matches(x, '[A-Za-z0-9]')) AS paras
  FROM documents WHERE text IS NOT NULL),
found AS (
  SELECT doc_id, parts, CASE WHEN len(parts) > 1 THEN [text] ELSE [] END AS whole,
    CASE WHEN len(paras) > 1 THEN list_filter(paras, lambda x: contains(x, chr(10))) ELSE [] END AS wraps,
    flatten(list_transform(range(2, least({licenses.RUN}, len(paras) - 1) + 1), lambda k:
      list_transform(range(1, len(paras) - k + 2), lambda i: array_to_string(paras[i:i + k - 1], ' ')))) AS runs
  FROM lines),
raw AS (SELECT doc_id, unnest(list_concat(list_concat(parts, whole), list_concat(wraps, runs))) AS t FROM found),
folded AS (
  SELECT doc_id, trim(regexp_replace(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) AS unit FROM raw),
units AS (
  SELECT doc_id, unit, count(*) AS times FROM folded WHERE unit <> '' GROUP BY ALL),
texts AS (
  SELECT DISTINCT unit AS t FROM units
  UNION SELECT trim(regexp_replace(translate(notice, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) FROM templates),
words AS (SELECT t, string_split(t, ' ') AS w FROM texts),
grams AS (
  SELECT t, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(
    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g
  FROM words),
known AS (
  SELECT id, license, g FROM templates JOIN grams ON t = trim(regexp_replace(translate(notice,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))),
flat AS (SELECT t, len(g) AS n, unnest(g) AS b FROM grams WHERE len(g) <= 400),
target AS (SELECT id, license, len(g) AS m, unnest(g) AS b FROM known),
dice AS (
  SELECT t, license, id, 2.0::DOUBLE * count(*) / (n + m) AS dice
  FROM flat JOIN target USING (b) GROUP BY t, n, license, id, m),
best AS (
  SELECT t, max({{'dice': dice, 'license': license}}) AS x FROM dice WHERE dice >= 0.9 GROUP BY t)
SELECT doc_id, x.license AS license, max(x.dice) AS dice, CAST(sum(times) AS BIGINT) AS n_units
FROM units JOIN best ON unit = t GROUP BY doc_id, x.license
""",
    "op9_url_filters": """
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT n, page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
address AS (
  SELECT n, page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split),
best AS (
  SELECT n, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM address JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM address LEFT JOIN best USING (n)
""",
    "op13_fill_in_middle": """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n,
    ('0x' || substr(x, 1, 8))::BIGINT % (len(units) + 1) AS c1,
    ('0x' || substr(x, 9, 8))::BIGINT % (len(units) + 1) AS c2,
    ('0x' || substr(x, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS h4
  FROM hashed),
parts AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(c1, c2)], '') AS p,
    array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
    array_to_string(units[greatest(c1, c2) + 1:n], '') AS s
  FROM drawn)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM parts
""",
}
