"""The registered queries of the operators, and DuckDB SQL for those that it can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (lexical_tree, line_rules, mixing, multiset_hash, norm_topk, packing, periodic_runs, quality_rqda, secret_links,
               sharding, simhash_golay, toxic_crf, warc_zstd)
from .common import id_crc32, table

SHARDS = 24
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def on_workers(spark: SparkSession) -> None:
    """Python workers find the package where the driver does (a cluster ships it with --py-files)."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, path) if x)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return table(spark, sf_dir, "documents")


def _scored(scores: DataFrame, held_out, threshold: float, *more) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"), *more)


def op1_quality_rqda(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_crc32() % 4 == 2
    scores = quality_rqda.quality(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), ~held_out)
    return _scored(scores, held_out, quality_rqda.THRESHOLD)


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(_documents(spark, sf_dir), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.scanned(_documents(spark, sf_dir))


def op4_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), tokenizer_path())


def op5_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return warc_zstd.archive_round_trip(table(spark, sf_dir, "pages"))


def op6_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_crc32() % 5 == 0
    scores = toxic_crf.toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), ~held_out)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans")
    return _scored(scores, held_out, toxic_crf.THRESHOLD, spans)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.rule_report(_documents(spark, sf_dir))


def op9_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return norm_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_golay.near_duplicates(_documents(spark, sf_dir))


def op11_lexical_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_tree.ranked(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edited_report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", periodic_runs.planted().alias("text"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_rqda, op2_minimax_shards, op3_secret_links, op4_cutting_stock, op5_warc_zstd, op6_toxic_crf,
    op7_source_mix, op8_line_rules, op9_norm_topk, op10_golay_simhash,
    op11_lexical_tree, op12_multiset_hash, op13_periodic_runs, pipeline)}

_WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT *, CASE WHEN n >= {warc_zstd.DEDUP_BYTES} THEN max(page_id) OVER (PARTITION BY html) END AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN last IS NOT NULL AND (page_id IS NULL OR page_id < last) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last IS NOT NULL AND (page_id IS NULL OR page_id < last) THEN last END AS refers_to
FROM g"""

_MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(str(x) for x in mixing.WEIGHTS)}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
             ({mixing.LIMIT} * source_size)::DOUBLE AS most FROM s),
r AS (SELECT *, most / weight AS ratio, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place FROM w),
b AS (SELECT *, ({mixing.SHARE} * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS rate
      FROM r WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rate, place) AS level FROM b WHERE rate <= ratio),
t AS (SELECT b.source, source_size, least(most, coalesce(level, ratio) * weight) AS target FROM b, (SELECT max(level) AS level FROM l)),
x AS (SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS whole,
             (sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS fin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (whole // source_size) * size
             + greatest(0, least(size, whole % source_size - (fin - size))) ELSE 0 END)::BIGINT AS taken
FROM x"""

_RULES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w, string_split(t, chr(10)) AS l FROM d),
g AS (SELECT rid, i, w[i:i + 4] AS g FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
h AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM
      (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM h) GROUP BY rid),
q AS (SELECT rid, line_no, x, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n,
             len(regexp_extract_all(x, '{line_rules.SEPARATOR}')) AS separators,
             len(regexp_extract_all(x, '{line_rules.NOISY}')) AS noisy
      FROM (SELECT rid, unnest(l) AS x, generate_subscripts(l, 1) AS line_no FROM w)),
f AS (SELECT rid, line_no, x FROM q WHERE NOT (noisy > {line_rules.NOISY_WORDS}::DOUBLE * n
             OR (n >= {line_rules.PLAIN_WORDS} AND NOT regexp_matches(x, '{line_rules.SENTENCE_MARK}'))
             OR (separators >= 3 AND separators * 5 >= n)
             OR (n <= {line_rules.BOILERPLATE_WORDS} AND regexp_matches(x, '{line_rules.BOILERPLATE}')))),
k AS (SELECT rid, sum(length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g')))::BIGINT AS left_chars FROM f GROUP BY rid),
s AS (SELECT w.rid, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(translate(t, '{line_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
             [x FOR x IN l IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             coalesce(left_chars, 0) AS left_chars
      FROM w LEFT JOIN c USING (rid) LEFT JOIN k USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
       (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEAT_PERCENT} * n_words)
           AND word_chars - left_chars <= {line_rules.MAX_LOSS}::DOUBLE * word_chars AS kept,
       (word_chars - left_chars)::BIGINT AS lost_chars
FROM s"""

_TOPK_SQL = f"""
WITH v AS (SELECT vec_id, [floor({norm_topk.SCALE} * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {norm_topk.K}"""

_LEXICAL_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
n AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d),
i AS (SELECT item_no, item_id, unnest(list_distinct(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term
      FROM (SELECT *, row_number() OVER () AS item_no FROM benchmark)),
f AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d)
      WHERE term IN (SELECT term FROM i) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, n GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 100 - 90 + (90 * len(t)::BIGINT * n_docs) // n_terms AS m FROM d, n WHERE len(t) > 0),
s AS (SELECT item_no, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM i JOIN f USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY item_no, item_id, rid, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""

ORACLE_SQL = {"op5_warc_zstd": _WARC_SQL, "op7_source_mix": _MIX_SQL, "op8_line_rules": _RULES_SQL, "op9_norm_topk": _TOPK_SQL,
              "op11_lexical_tree": _LEXICAL_SQL}
