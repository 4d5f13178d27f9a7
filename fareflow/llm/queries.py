"""One registered query per operator, over its whole table, and the DuckDB counterpart where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import (collocations, decontaminate, fingerprints, html_text, line_dedup, minhash, ngram_join, packing,
                          secrets, suffix_tree, token_alignment, toxicity, url_rules)
from fareflow.llm.store import table, written

UPPER, LOWER = url_rules.UPPER, url_rules.LOWER


def fold(doc: str, parts: int) -> Column:
    return F.crc32(F.col(doc).cast("string")) % parts


def sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


# --- 1 line dedup

def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(spark, docs, min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", sha256(F.col("kept")).alias("kept_sha256"))


OP1_SQL = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              '{UPPER}', '{LOWER}') AS key FROM lines),
counted AS (SELECT key, count(DISTINCT doc_id) AS n_docs, max(doc_id) AS top_doc FROM keyed
            WHERE length(key) >= 20 GROUP BY key),
judged AS (SELECT k.*, c.n_docs IS NOT NULL AND c.n_docs >= 3 AND c.top_doc <> k.doc_id AS dropped
           FROM keyed k LEFT JOIN counted c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


# --- 2 url rules

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


OP2_SQL = f"""
WITH urls AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
rules(rhost, rpath, verdict) AS (VALUES {', '.join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
fits AS (SELECT u.page_id, r.rhost || r.rpath AS rule, r.verdict,
    row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC) AS k
  FROM urls u JOIN rules r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fits f ON u.page_id = f.page_id AND f.k = 1
"""


# --- 3 benchmark decontamination

def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))


# --- 4 toxicity

def toxicity_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learnt from labelled rows outside the held-out fifth."""
    return toxicity.fit(docs.select("doc_id", "text"), labels.filter(fold("doc_id", 5) != 0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity_weights(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


# --- 5 n-gram Jaccard join

def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


# --- 6 HTML extraction

def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# --- 7 language-model scores

def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_tree.scores(table(spark, sf_dir, "documents").select("doc_id", "text"), fold("doc_id", 7) != 2)
    return out.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                      "score")


# --- 8 document fingerprints

def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.edited_by_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    own, changed, after = F.col("own"), F.col("changed"), F.col("next_own")
    return out.select(
        "doc_id", "n_chars", sha256(F.col("edited")).alias("edited_sha256"), fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(changed).alias("edited_fingerprint"), fingerprints.likeness(own, changed).alias("near_edited"),
        fingerprints.likeness(own, after).alias("near_next"), fingerprints.containment(own, changed).alias("held_edited"),
        fingerprints.containment(own, after).alias("held_next"))


# --- 9 secret scan

def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    known = F.col("known")
    return out.select(
        "doc_id", secrets.count_of(known, 0).alias("n_assign"), secrets.count_of(known, 1).alias("n_access"),
        secrets.count_of(known, 2).alias("n_hex"), sha256(secrets.as_text(known)).alias("base_sha256"),
        secrets.as_text(F.concat("known", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


# --- 10 packing

def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), capacity=2048)


# --- 11 phrase collocations

def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"), least=100, longest=5, top=2000)


def _runs(size: int) -> str:
    """Phrases of ``size`` words of all pieces."""
    words = " || ' ' || ".join(f"words[i + {k}]" if k else "words[i]" for k in range(size))
    return (f"SELECT lang, {size} AS k, {words} AS phrase FROM (SELECT lang, words, unnest(range(1, len(words) - {size - 2})) AS i "
            f"FROM pieces WHERE len(words) >= {size})")


def _part(low: int, high: int) -> str:
    return f"array_to_string(list_slice(words, {low}, {high}), ' ')"


OP11_SQL = f"""
WITH cut AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM cut),
found AS ({' UNION ALL '.join(_runs(k) for k in range(1, 6))}),
totals AS (SELECT lang, count(*) AS n FROM found WHERE k = 1 GROUP BY lang),
freq AS (SELECT lang, k, phrase, count(*) AS a FROM found GROUP BY lang, k, phrase HAVING count(*) >= 100),
cand AS (SELECT *, string_split(phrase, ' ') AS words FROM freq WHERE k >= 2),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM cand),
parts AS (SELECT c.lang, c.k, c.phrase, c.a, c.words, cut, l.a AS l, r.a AS r, t.n,
    CAST((1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN freq l ON l.lang = c.lang AND l.phrase = {_part(1, 'cut')} AND l.k = cut
  JOIN freq r ON r.lang = c.lang AND r.phrase = {_part('cut + 1', 'c.k')} AND r.k = c.k - cut),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS pick FROM parts),
longer AS (SELECT lang, part, max(a) AS longer FROM (SELECT lang, a,
    unnest([{_part(1, 'k - 1')}, {_part(2, 'k')}]) AS part FROM cand WHERE k > 2) GROUP BY lang, part),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.part = b.phrase
  WHERE pick = 1 AND (o.longer IS NULL OR 100 * o.longer < 100 * b.a))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000
"""


# --- 12 cross-tokenizer alignment

def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    stored = written(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    counts = written(token_alignment.pair_counts(stored, token_alignment.b_size()), "counted-pairs")
    return token_alignment.with_counts(stored, counts).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


# --- 13 MinHash near-dedup

def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {q.__name__: q for q in (op1_line_dedup, op2_url_rules, op3_benchmark_decontamination, op4_toxicity,
                                    op5_ngram_jaccard_join, op6_html_extraction, op7_lm_scoring, op8_document_fingerprints, op9_secret_scan,
                                    op10_packing, op11_phrase_collocations, op12_token_alignment, op13_minhash_dedup)}
ORACLES = {"op1_line_dedup": OP1_SQL, "op2_url_rules": OP2_SQL, "op11_phrase_collocations": OP11_SQL}
