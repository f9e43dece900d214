"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tenura.llm.ann import every_twentieth, nearest
from tenura.llm.audit import filter_audit
from tenura.llm.bitpack import token_index
from tenura.llm.gam import quality_scores
from tenura.llm.impacts import every_hundredth, top_products
from tenura.llm.jaccard import linked_documents
from tenura.llm.mix import words_taken
from tenura.llm.naming import exact_copies
from tenura.llm.orchard import CENTROIDS, ROUNDS, cluster
from tenura.llm.pack import pack
from tenura.llm.spans import section_tokens
from tenura.llm.suffix import removed_passages
from tenura.llm.warc import page_captures

Query = Callable[[SparkSession, str], DataFrame]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the package to the executors, once per application, wherever the driver has it."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="tenura-code-")) / "tenura_code.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent).as_posix())
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens at most."""
    pieces = pack(table(spark, sf_dir, "documents"), with_ids=False)
    first = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*first, *[c for c in pieces.columns if c not in first])


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as request, response or revisit, and metadata records, written, read and assembled."""
    return page_captures(table(spark, sf_dir, "pages"))


def op3_bitpacked_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in bit-packed files, read back."""
    return token_index(spark, table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix of all sources takes from each document."""
    return words_taken(table(spark, sf_dir, "documents"))


def op5_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that start earlier."""
    return removed_passages(table(spark, sf_dir, "documents"))


def op6_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for each twentieth vector, with bounds of four deviations."""
    return nearest(table(spark, sf_dir, "embeddings"), every_twentieth(), spread=4.0)


def op7_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every document, from one encoding of the whole text."""
    return section_tokens(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shingle count and link component of every document."""
    return linked_documents(table(spark, sf_dir, "documents"))


def op9_impact_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest integer products with all vectors for each hundredth vector."""
    return top_products(table(spark, sf_dir, "embeddings"), every_hundredth())


def op10_additive_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_orchard_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in eight clusters after ten rounds."""
    return cluster(table(spark, sf_dir, "embeddings")).drop("tried")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, in each of their 120 orders."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equals that stays."""
    return exact_copies(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    ship(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_pack_vectors": op1_pack_vectors,
    "op2_warc_transactions": op2_warc_transactions,
    "op3_bitpacked_ids": op3_bitpacked_ids,
    "op4_mix_sources": op4_mix_sources,
    "op5_suffix_arrays": op5_suffix_arrays,
    "op6_rotated_codes": op6_rotated_codes,
    "op7_section_tokens": op7_section_tokens,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_impact_ordered": op9_impact_ordered,
    "op10_additive_model": op10_additive_model,
    "op11_orchard_search": op11_orchard_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_block_naming": op13_block_naming,
    "pipeline": pipeline,
}

_BASE32 = """
array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
  ((16 * (strpos('0123456789abcdef', substr(hex, 1 + (5 * i) // 4, 1)) - 1)
    + strpos('0123456789abcdef', substr(hex, 2 + (5 * i) // 4, 1)) - 1) >> (3 - i % 4)) & 31 AS BIGINT), 1)
  for i in range(32)], '')"""



def _lloyd_sql(k: int, rounds: int) -> str:
    """Plain rounds over all pairs of vectors and centroids."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS (SELECT i, vec_id, e, arg_min(c, (d, c)) AS cluster, MIN(d) AS distance FROM (
  SELECT v.i, v.vec_id, v.e, m.c, CAST(list_sum([(v.e[j] - m.e[j]) * (v.e[j] - m.e[j]) for j in range(1, 65)]) AS BIGINT) AS d FROM v, m{r} m) GROUP BY i, vec_id, e)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (SELECT cluster, j, CAST(SUM(x) AS BIGINT) AS s, COUNT(*) AS n FROM (
  SELECT cluster, UNNEST(e) AS x, UNNEST(range(64)) AS j FROM near{r}) GROUP BY cluster, j),
means{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS e FROM sums{r} GROUP BY cluster),
m{r + 1} AS (SELECT m.c, COALESCE(t.e, m.e) AS e FROM m{r} m LEFT JOIN means{r} t ON t.cluster = m.c)""")
    return f"""
WITH v AS (SELECT ROW_NUMBER() OVER () AS i, vec_id, [CAST(FLOOR(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
m0 AS (SELECT ROW_NUMBER() OVER (ORDER BY h) - 1 AS c, e FROM (SELECT sha256('3:' || vec_id) AS h, e FROM v ORDER BY h LIMIT {k})),
{",".join(steps)}
SELECT vec_id, CAST(cluster AS INT) AS cluster, distance, CAST(SUM(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(SUM(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.e, ',')) AS centroid_sha256
FROM near{rounds} JOIN m{rounds} m ON m.c = cluster"""


ORACLE: dict[str, str] = {
    "op11_orchard_search": _lloyd_sql(CENTROIDS, ROUNDS),
    "op12_filter_audit": r"""
WITH RECURSIVE t AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS x,
    regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT x, MIN(doc_id) AS least FROM t GROUP BY x),
fails AS (SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * len(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * len(x), regexp_matches(x, '[#$%&*|]'), COALESCE(doc_id > least, FALSE)] AS f,
    COALESCE(l.quality = 1, FALSE) AS good, COALESCE(l.toxic = 1, FALSE) AS toxic
  FROM t JOIN first USING (x) LEFT JOIN labels l USING (doc_id)),
masks AS (SELECT part, f, COUNT(*) AS n, COUNT(*) FILTER (good) AS good, COUNT(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL),
orders AS (SELECT '' AS o UNION ALL SELECT o || c FROM orders, (SELECT UNNEST(['A', 'B', 'C', 'D', 'E']) AS c) WHERE strpos(o, c) = 0),
steps AS (SELECT o, UNNEST(range(1, 6)) AS s FROM orders WHERE len(o) = 5),
hit AS (SELECT part, o, s, o[s] AS c, n, good, toxic, f[ascii(o[s]) - 64] AS fails,
    len([k for k in range(1, s) if f[ascii(o[k]) - 64]]) > 0 AS gone, len([y for y in f if y]) = 1 AS only_one FROM masks, steps),
sums AS (SELECT part, o, s, c, COALESCE(SUM(n) FILTER (NOT gone AND NOT fails), 0) AS kept, COALESCE(SUM(n) FILTER (NOT gone AND fails), 0) AS removed,
    COALESCE(SUM(n) FILTER (gone AND fails), 0) AS redundant, COALESCE(SUM(n) FILTER (fails AND only_one), 0) AS unique_fails,
    COALESCE(SUM(good) FILTER (NOT gone AND fails), 0) AS good_lost, COALESCE(SUM(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM hit GROUP BY part, o, s, c)
SELECT part, o AS filter_order, CAST(s AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(SUM(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley FROM sums""",
    "op13_block_naming": r"""
WITH t AS (SELECT doc_id, length(COALESCE(text, '')) AS points, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS x FROM documents)
SELECT doc_id, FIRST_VALUE(doc_id) OVER best AS keep_id, COUNT(*) OVER (PARTITION BY x) AS group_size,
  ROW_NUMBER() OVER best = 1 AS kept, sha256(x) AS text_sha256
FROM t WINDOW best AS (PARTITION BY x ORDER BY points DESC, doc_id)""",
    "op2_warc_transactions": f"""
WITH p AS (SELECT page_id, url, COALESCE(html, '') AS body, sha1(COALESCE(html, '')) AS hex FROM pages),
held AS (SELECT body, MAX(page_id) AS holder FROM p GROUP BY body)
SELECT page_id, strlen(p.body) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> holder THEN holder END AS refers_to,
  regexp_replace(trim(url), '\\s+', ' ', 'g') AS target_uri, TRUE AS has_request
FROM p JOIN held ON held.body = p.body""",
    "op8_jaccard_join": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
each AS (SELECT doc_id, len(s) AS n, UNNEST(s) AS s FROM sets),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.s = b.s AND a.doc_id <> b.doc_id
    AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90
  GROUP BY 1, 2, a.n, b.n HAVING 100 * COUNT(*) >= 90 * (a.n + b.n - COUNT(*))),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
FROM sets s JOIN (SELECT doc_id, MIN(other) AS component_id FROM reach GROUP BY 1) c USING (doc_id)""",
    "op9_impact_ordered": """
WITH v AS (SELECT vec_id, [FLOOR(1024 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 10""",
}
