"""The queries of this package and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldergrid.llm import bpe, centroids, chat, decontaminate, licenses, maxent, quality, repair, rules, simhash, topk, toxicity, url_filter
from foldergrid.session import use_defaults

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_defaults(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree source/lang/thousand/hundred; every tenth is the licence file
    of its directory, of its language or of its source."""
    number, hundred = F.col("doc_id"), F.floor(F.col("doc_id") / 100).cast("string")
    folder = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), hundred)
    path = (
        F.when(number % 1000 == 0, F.concat_ws("/", "source", "lang", F.lit("LICENSE")))
        .when(number % 10 == 0, F.concat_ws("/", folder, F.lit("LICENSE.txt")))
        .otherwise(F.concat_ws("/", folder, F.concat(F.lit("doc-"), "doc_id")))
    )
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return licenses.scan(files)


def chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return views.select("conv_id", "perspective", "part", "n_turns", "n_own", "rendered", spans.alias("spans"))


CHAT_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS x, length(coalesce(text, '')) + {chat.TURN_ALLOWANCE} AS size
  FROM conversations),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, x
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM said),
people AS (SELECT DISTINCT conv_id, role AS perspective FROM said WHERE role IS NOT NULL AND role <> 'system'),
views AS (
  SELECT p.conv_id, perspective, CAST(floor(before / {chat.PART_CHARS}) AS INTEGER) AS part, before, x,
         coalesce(role = perspective, false) AS own,
         '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
           WHEN role IS NULL THEN 'user' ELSE 'user name=' || role END || chr(10) AS head
  FROM placed p JOIN people q ON p.conv_id IS NOT DISTINCT FROM q.conv_id),
segments AS (SELECT *, head || x || '<|im_end|>' || chr(10) AS segment FROM views),
ordered AS (
  SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective, part ORDER BY before
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start FROM segments)
SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
       string_agg(segment, '' ORDER BY start) AS rendered,
       coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(start + length(x) + 10 AS BIGINT) AS VARCHAR), ',' ORDER BY start)
         FILTER (WHERE own), '') AS spans
FROM ordered GROUP BY conv_id, perspective, part
"""


def toxicity_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


TOP_K_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
  FROM whole q JOIN whole x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


URL_RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
    ("com/fr/", "allow"), ("com/de/", "block"),
]


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "entry string, verdict string")
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), "url", rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{entry}', '{verdict}')" for entry, verdict in URL_RULES)
URL_SQL = f"""
WITH rules(entry, verdict) AS (VALUES {_RULE_ROWS}),
parts AS (
  SELECT entry, verdict, split_part(entry, '/', 1) AS rule_host,
         substr(entry, strpos(entry, '/')) AS rule_path FROM rules),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
sites AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS raw_host,
         regexp_extract(regexp_replace(r, '^[^/?#]*', ''), '^[^?#]*') AS path FROM rest),
hosts AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM sites),
hits AS (
  SELECT page_id, entry, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS place
  FROM hosts, parts
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT h.page_id, host, path, entry AS rule, coalesce(verdict, 'allow') AS verdict
FROM hosts h LEFT JOIN hits ON h.page_id = hits.page_id AND place = 1
"""


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def _code_sql(value: str) -> str:
    shift = f"greatest(length(bin({value})) - {rules.EXACT_BITS}, 0)"
    return f"{shift} * {1 << rules.EXACT_BITS - 1} + ({value} >> {shift})"


def _least_sql(code: str) -> str:
    half = 1 << rules.EXACT_BITS - 1
    shift = f"greatest({code} // {half} - 1, 0)"
    return f"(({code} - {shift} * {half}) << {shift})"


def _rules_sql() -> str:
    """Words, windows and sketches in plain SQL: windows by their words, quantiles by running sums."""
    values = " UNION ALL ".join(
        f"SELECT doc_id, g1, g2, '{m}' AS measure, 1000 * {a} // {b} AS v, {flat} AS flat, {percent} AS percent, {str(both).lower()} AS both_sides"
        f" FROM counts WHERE NOT base_failed"
        for m, (a, b, flat, percent, both) in rules.MEASURES.items()
    )
    levels = "".join(
        f"""
q{depth} AS (
  SELECT {keys} measure, max(total) AS total, min(code) FILTER (WHERE 10 * upto >= total) AS low, min(code) FILTER (WHERE 2 * upto >= total) AS mid
  FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} measure ORDER BY code) AS upto, sum(n) OVER (PARTITION BY {keys} measure) AS total
        FROM (SELECT {keys} measure, code, sum(n) AS n FROM sketch GROUP BY ALL))
  GROUP BY {keys} measure),"""
        for depth, keys in enumerate(("", "g1,", "g1, g2,"))
    )
    return rf"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w FROM documents),
said AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
windows AS (
  SELECT doc_id, i, word AS a, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS b, lead(word, 2) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM said),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM twice, range(3) AS t(d) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^ 	-]') GROUP BY doc_id),
counts AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g1, coalesce('=' || source, '') AS g2, len(w) AS n_words,
         length(array_to_string(w, '')) AS word_chars, length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(w) < {rules.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {rules.MAX_REPEATED} * len(w) AS base_failed
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
vals AS ({values}),
sketch AS (SELECT g1, g2, measure, {_code_sql('v')} AS code, count(*) AS n FROM vals GROUP BY ALL),{levels}
chosen AS (
  SELECT q2.g1, q2.g2, q2.measure,
         CASE WHEN q2.total >= {rules.MIN_ROWS} THEN q2.low WHEN q1.total >= {rules.MIN_ROWS} THEN q1.low ELSE q0.low END AS low,
         CASE WHEN q2.total >= {rules.MIN_ROWS} THEN q2.mid WHEN q1.total >= {rules.MIN_ROWS} THEN q1.mid ELSE q0.mid END AS mid
  FROM q2 JOIN q1 ON q2.g1 = q1.g1 AND q2.measure = q1.measure JOIN q0 ON q2.measure = q0.measure),
bounds AS (SELECT g1, g2, measure, {_least_sql('low')} AS low, {_least_sql('mid')} AS mid FROM chosen),
beyond AS (
  SELECT doc_id FROM (
    SELECT doc_id, v, mid, both_sides, greatest({rules.SPREADS} * (mid - low), flat, percent * mid // 100) AS reach
    FROM vals JOIN bounds USING (g1, g2, measure))
  WHERE v > mid + reach OR (both_sides AND v < mid - reach))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM beyond) AS kept
FROM counts
"""


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with damage that depends on the turn alone: some turns dropped, emptied, without
    marks, said twice, or given to the user. Dropped ones stay as rows that are not `present`."""
    told = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))  # noqa: E731
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(told("role")).alias("role"), text.alias("text"),
        (kind != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audits(damaged(table(spark, sf_dir, "conversations")), present="present")


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_digests(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def _centroids_sql(rounds: int = 10) -> str:
    """Every round is two common tables: distances to all centroids, and floors of the means."""
    mean = "(sum(p.v) - ((sum(p.v) % count(*)) + count(*)) % count(*)) // count(*)"
    steps = ["c0 AS (SELECT CAST(place - 1 AS INTEGER) AS cluster, dim, v FROM points JOIN first USING (vec_id))"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS place FROM (
      SELECT p.vec_id, c.cluster, sum((p.v - c.v) * (p.v - c.v)) AS distance FROM points p JOIN c{r} c USING (dim) GROUP BY p.vec_id, c.cluster))
  WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, c.dim, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT a.cluster, p.dim, CAST({mean} AS BIGINT) AS v FROM a{r} a JOIN points p USING (vec_id) GROUP BY a.cluster, p.dim) m
  ON c.cluster = m.cluster AND c.dim = m.dim)""")
    return f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points AS MATERIALIZED (SELECT vec_id, unnest(v) AS v, generate_subscripts(v, 1) AS dim FROM whole),
first AS (
  SELECT vec_id, place FROM (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) AS place FROM whole) WHERE place <= 8),
{", ".join(steps)},
named AS (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN named USING (cluster)
"""


QUERIES = {
    "op1_quality_classifier": (quality_classifier, None),
    "op2_benchmark_decontamination": (benchmark_decontamination, None),
    "op3_license_scans": (license_scans, None),
    "op4_chat_rotation": (chat_rotation, CHAT_SQL),
    "op5_toxicity_segments": (toxicity_segments, None),
    "op6_pivot_top_k": (pivot_top_k, TOP_K_SQL),
    "op7_byte_bpe": (byte_bpe, None),
    "op8_simhash_near_dedup": (simhash_near_dedup, None),
    "op9_lm_scores": (lm_scores, None),
    "op10_url_filters": (url_filters, URL_SQL),
    "op11_quality_rules": (quality_rules, _rules_sql()),
    "op12_conversation_repair": (conversation_repair, None),
    "op13_centroid_clustering": (centroid_clustering, _centroids_sql()),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


def queries() -> dict:
    return {name: run for name, (run, _) in QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
