"""Registered queries of the training-data operators: each applies its
operator, with production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (
    collocations, decontaminate, jaccard_join, lexical_search, licenses, line_dedup, mixing, secret_scan, sharding,
    spotsigs, substring_dedup, topk_search, toxicity,
)

# Shares of the expected tokens by domain: language and quality label.
TARGETS = {"en_1": 0.52, "de_1": 0.15, "fr_1": 0.15, "es_1": 0.10,
           "en_0": 0.05, "de_0": 0.01, "fr_0": 0.01, "es_0": 0.01}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labelled documents: language and quality label."""
    known = labels.where("quality in (0, 1)").select("doc_id", "quality")
    return (docs.select("doc_id", "lang").join(known, "doc_id")
                .select("doc_id", F.concat(F.col("lang"), F.lit("_"), F.col("quality").cast("string")).alias("domain")))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(_table(spark, sf_dir, "documents"),
                                        jaccard_join.Params(k=4, num=85, den=100), links=True)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"), line_dedup.Params(exact_chars=1))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.document_rates(docs, labelled_domains(docs, _table(spark, sf_dir, "labels")), TARGETS)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"),
                                    repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_benchmark_passages(_table(spark, sf_dir, "documents"),
                                                 _table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in [
    op1_jaccard_join, op2_license_scan, op3_line_dedup, op4_fingerprints, op5_sharding, op6_mixing, op7_secret_scan,
    op8_decontamination, op9_substring_dedup, op10_toxicity, op11_topk_search, op12_collocations, op13_lexical_search,
]}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op11_topk_search": """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([x[1] * x[2] FOR x IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 5
""",
    "op12_collocations": rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
f AS (
  SELECT lang, size, gram, count(*) AS f FROM (
    SELECT lang, 1 AS size, w[i] AS gram FROM i
    UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM i WHERE i + 1 <= len(w)
    UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM i WHERE i + 2 <= len(w))
  GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, gram, f AS a, string_split(gram, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT lang, size, gram, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
scored AS (
  SELECT x.lang, x.size, x.gram, x.a, k, lf.f AS l, rf.f AS r,
         CAST((1000000::HUGEINT * x.a * x.a) // (lf.f::HUGEINT * rf.f) AS BIGINT) AS score
  FROM cuts x JOIN f lf ON lf.lang = x.lang AND lf.gram = head JOIN f rf ON rf.lang = x.lang AND rf.gram = tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
longer AS (
  SELECT lang, gram, max(a) AS a FROM (
    SELECT lang, a, w[1] || ' ' || w[2] AS gram FROM c WHERE size = 3
    UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE size = 3)
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.gram = b.gram
  WHERE x.a IS NULL OR 100 * x.a < 50 * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, gram) AS rank,
       gram AS phrase, a, l, r, n.n AS n, score
FROM kept k JOIN n ON n.lang = k.lang QUALIFY rank <= 2000
""",
    "op13_lexical_search": rf"""
WITH t AS (
  SELECT row_id, doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents)),
tf AS (SELECT row_id, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT row_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row_id),
g AS (SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS l FROM d),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * g.n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, g),
m AS (SELECT row_id, 100 - 25 + ((25 * d.n * g.n) // g.l) AS m FROM d, g),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
s AS (
  SELECT item_id, row_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
""",
}
