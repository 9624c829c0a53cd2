"""The queries of this package over the benchmark tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.llm import conversation, decontaminate, embed_dedup, html_text, langid, licenses, linededup, mixing, quality, simhash, spelling, suffix_dedup, url_filter
from reportstar.llm.common import with_row_key
from reportstar.llm.oracle import ORACLE as MORE_SQL
from reportstar.llm.oracle import RULES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = ["repeats.n_bytes", "repeats.n_removed", "repeats.n_spans"]
    return suffix_dedup.remove_repeats(docs).select("doc_id", *counts, F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.fit_labeller(pages), "text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "row")
    groups = simhash.group_documents(docs, "row")
    return groups.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return mixing.mix_sources(docs, copy_name="copy_no", key_name="order_key")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and passage found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"), "found")
    return found.select("doc_id", F.inline("found"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit_languages(docs), "found")
    return found.select(
        "doc_id",
        langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model, "score")
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def line_report(kept: DataFrame) -> DataFrame:
    return kept.select(
        "doc_id",
        F.col("report.lines").cast("long").alias("n_lines"),
        F.col("report.removed").cast("long").alias("n_removed"),
        F.col("report.runs").cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and runs removed from each document, and the digest of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_report(linededup.dedup_lines(docs, report="report"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.group_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"), damage=199)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation.damage(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversation.repair(damaged, live="live", place="place").reports


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_html_text": op2_html_text,
    "op3_simhash": op3_simhash,
    "op4_mix_sources": op4_mix_sources,
    "op5_license_scan": op5_license_scan,
    "op6_decontaminate": op6_decontaminate,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_line_dedup": op9_line_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_url_filter": op13_url_filter,
}

_QUOTE = "'"
_NOTICES = ", ".join(
    "(" + ", ".join(_QUOTE + x.replace(_QUOTE, 2 * _QUOTE) + _QUOTE for x in pair) + ")" for pair in licenses.TEMPLATES.items()
)

ORACLE = MORE_SQL | {
    "op4_mix_sources": f"""
WITH sizes AS (
  SELECT source, count(*) AS n, CASE source WHEN 'src0' THEN 0.1 ELSE {mixing.DEFAULT} END::DOUBLE AS w
  FROM documents GROUP BY source),
rates AS (
  SELECT source, w / sum(w) OVER () * sum(n) OVER () / n AS rate FROM sizes),
steps AS (
  SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p, rate
  FROM (SELECT *, unnest(generate_series(0, floor(rate + 12 * sqrt(rate) + 30)::BIGINT)) AS k FROM rates)),
cdf AS (
  SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM steps),
drawn AS (
  SELECT d.doc_id, d.source, d.n_chars,
         ('0x' || substr(md5('{mixing.SEED}|' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents d),
counts AS (
  SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.source = d.source AND cdf.c <= d.u) AS n FROM drawn d)
SELECT doc_id, source, n_chars, copy_no::INT AS copy_no,
       md5('{mixing.SEED}|' || doc_id || '|' || copy_no) AS order_key
FROM (SELECT *, unnest(generate_series(1, n)) AS copy_no FROM counts WHERE n > 0)
""",
    "op5_license_scan": f"""
WITH templates(license, notice) AS (VALUES {_NOTICES}),
words AS (
  SELECT NULL AS doc_id, license, regexp_extract_all(lower(notice), '[\\p{{L}}\\p{{N}}]+') AS w FROM templates
  UNION ALL
  SELECT doc_id, NULL, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') FROM documents),
shingles AS (
  SELECT doc_id, license, i - 1 AS i, array_to_string(w[i : i + {licenses.WORDS - 1}], ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, len(w) - {licenses.WORDS - 1})) AS i FROM words WHERE len(w) >= {licenses.WORDS})),
sizes AS (
  SELECT license, greatest({licenses.LEAST}, pow(2, ceil(log2(count(*))))::BIGINT) AS size, count(DISTINCT s) AS n
  FROM shingles WHERE license IS NOT NULL GROUP BY license),
hits AS (
  SELECT d.doc_id, t.license, z.size, z.n, d.i, d.s
  FROM shingles d JOIN (SELECT DISTINCT license, s FROM shingles WHERE license IS NOT NULL) t ON d.s = t.s
  JOIN sizes z ON z.license = t.license WHERE d.doc_id IS NOT NULL),
windows AS (SELECT *, unnest([i // size, i // size - 1]) AS k FROM hits),
padded AS (SELECT doc_id, license, len(w) AS n, ' ' || array_to_string(w, ' ') || ' ' AS s FROM words),
short AS (
  SELECT d.doc_id, t.license, instr(d.s, t.s) AS place, d.s FROM padded d JOIN padded t ON instr(d.s, t.s) > 0
  WHERE d.license IS NULL AND t.license IS NOT NULL AND t.n < {licenses.WORDS}),
shares AS (
  SELECT doc_id, license, k * size AS first_word, count(DISTINCT s) / n::DOUBLE AS containment
  FROM windows WHERE k >= 0 GROUP BY doc_id, license, k, size, n)
SELECT doc_id, license, max(containment) AS containment, arg_max(first_word, containment * 1e12 - first_word)::BIGINT AS first_word
FROM shares WHERE containment >= {licenses.CONTAINMENT} GROUP BY doc_id, license
UNION ALL SELECT doc_id, license, 1.0::DOUBLE, len(string_split(substr(s, 1, place), ' '))::BIGINT - 2 FROM short
""",
    "op9_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL),
counted AS (
  SELECT *, len(regexp_extract_all(line, '[^ \\t\\n\\x0B\\f\\r]+')) AS w FROM lines),
seq AS (
  SELECT doc_id, pos, line, w, row_number() OVER d AS i, coalesce(lead(pos) OVER d, max_pos + 1) AS following
  FROM (SELECT *, max(pos) OVER (PARTITION BY doc_id) AS max_pos FROM counted) WHERE w > 0
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY doc_id NULLS LAST) AS r FROM seq),
pairs AS (
  SELECT a.r AS e, b.doc_id, b.r, b.i, b.i - a.i AS shift, b.w
  FROM ranked a JOIN ranked b ON a.line = b.line AND (a.r < b.r OR (a.r = b.r AND a.i < b.i))),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY e, r, shift ORDER BY i) AS island FROM pairs),
later AS (SELECT doc_id, min(i) AS i, max(i) AS j FROM islands GROUP BY e, doc_id, r, shift, island HAVING sum(w) >= {linededup.MIN_WORDS}),
gone AS (
  SELECT DISTINCT c.doc_id, c.pos
  FROM later l JOIN seq s ON s.doc_id = l.doc_id AND s.i BETWEEN l.i AND l.j
  JOIN counted c ON c.doc_id = s.doc_id AND c.pos >= s.pos AND c.pos < s.following),
marked AS (
  SELECT c.doc_id, c.pos, c.line, g.pos IS NOT NULL AS removed,
         lag(g.pos IS NOT NULL, 1, false) OVER (PARTITION BY c.doc_id ORDER BY c.pos) AS before
  FROM counted c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.pos = c.pos)
SELECT d.doc_id, coalesce(m.n_lines, 0) AS n_lines, coalesce(m.n_removed, 0) AS n_removed, coalesce(m.n_runs, 0) AS n_runs,
       sha256(coalesce(m.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
         count(*) FILTER (removed AND NOT before) AS n_runs,
         string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed) AS kept
  FROM marked GROUP BY doc_id) m ON m.doc_id = d.doc_id
""",
}
