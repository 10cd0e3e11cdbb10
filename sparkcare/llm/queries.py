"""Proof queries of the operators in this subpackage and their DuckDB twins.

Each query applies its operator with production parameters to the whole table.  The ones
without a twin are tested against brute force, an exact round trip or held-out accuracy
in ``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontam, langid, line_dedup, minhash, mixing, packing, pii, pivots, repetition, substring,
               tokens, warc)

VOCABULARY = tokens.VOCABULARY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sha(column: str):
    return F.sha2(F.col(column).cast("binary"), 256).alias("kept_sha256")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept once over all documents."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", _sha("text"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicates by 4-word shingles at 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside of repeated runs of 35 words."""
    return substring.dedup_substrings(table(spark, sf_dir, "documents"), window=35).select(
        "doc_id", "n_words", "n_removed", _sha("text"), "n_factors")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in length buckets and batches."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by pattern and by context."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return repetition.quality_table(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document as the library counts them."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY, limit=2048).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    return langid.identify_by_fold(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score")


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed by source to target weights."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned by byte offsets, links counted over all documents."""
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors in 40 clusters after five rounds, in whole numbers."""
    return pivots.cluster_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_line_dedup, op2_minhash, op3_substring_dedup, op4_warc, op5_packing, op6_decontamination,
    op7_personal_data, op8_quality_rules, op9_token_counts, op10_language_id, op11_source_mix,
    op12_token_alignment, op13_centroids)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _apportioned(name: str, parties: str, claim: str, seats: str, group: str, order: str, out: str) -> str:
    """CTEs ``name``: the rows of ``parties`` with Sainte-Lague seats ``out``, by quotients."""
    over = f"PARTITION BY {group}" if group else ""
    same = f"{group}, {order}" if group else order
    return f"""
{name}_b AS (
  SELECT *, {seats} - sum(b) OVER ({over}) AS o FROM (
    SELECT *, count(*) OVER ({over}) AS pn, (sum({claim}) OVER ({over}))::DOUBLE AS ps,
           CASE WHEN {claim} > 0 AND sum({claim}) OVER ({over}) > 0
                THEN floor({claim} * {seats} / (sum({claim}) OVER ({over}))::DOUBLE + 0.5) ELSE 0 END::BIGINT AS b
    FROM {parties})),
{name}_m AS (
  SELECT {same}, sum(sign(o))::BIGINT AS moved FROM (
    SELECT *, row_number() OVER ({over} ORDER BY CASE WHEN o > 0 THEN -q ELSE q END,
             CASE WHEN o > 0 THEN {order} ELSE -{order} END, CASE WHEN o > 0 THEN k ELSE -k END) AS place
    FROM (SELECT *, {claim} / (2 * k + 1)::DOUBLE AS q FROM (
      SELECT *, unnest(CASE WHEN o > 0 THEN generate_series(b, b + ceil(pn * {claim} / ps / 2)::BIGINT + 2)
                            ELSE generate_series(b - ceil(pn * {claim} / ps / 2)::BIGINT - 2, b - 1) END) AS k
      FROM {name}_b WHERE o <> 0 AND {claim} > 0) WHERE k >= 0))
  WHERE place <= abs(o) GROUP BY {same}),
{name} AS (
  SELECT p.*, b + coalesce(moved, 0) AS {out} FROM {name}_b p LEFT JOIN {name}_m m USING ({same}))"""


def _nearest(points: str, centres: str) -> str:
    """Each vector with its nearest centre and the squared distance."""
    return f"""
  SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT p.rowid_, p.vec_id, p.v, z.c,
           list_sum(list_transform(list_zip(p.v, z.v), lambda e: (e[1] - e[2]) * (e[1] - e[2])))::BIGINT AS d
    FROM {points} p CROSS JOIN {centres} z) GROUP BY rowid_, vec_id, v"""


_ROUNDS = "".join(f"""
a{i} AS ({_nearest("kept", f"c{i}")}),
m{i} AS (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
    SELECT c, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM a{i} CROSS JOIN generate_series(1, 64) g(i) GROUP BY c, i)
  GROUP BY c),
c{i + 1} AS (SELECT z.c, coalesce(m.v, z.v) AS v FROM c{i} z LEFT JOIN m{i} m USING (c)),""" for i in range(5))

ORACLE: dict[str, str] = {
    "op11_source_mix": f"""
WITH r AS (
  SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")}) AS size,
         md5('11:' || CASE WHEN doc_id IS NULL THEN 'n' ELSE 'v' || doc_id END || ':'
             || CASE WHEN text IS NULL THEN '-' ELSE md5(text) END) AS k0 FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY source, doc_id, k0, size) - 1 AS place FROM r),
u AS (SELECT *, place // 4096 AS part, md5(k0 || ':' || (place // 4096)) AS key FROM n),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM s0),
s2 AS (SELECT *, ([5, 2, 1])[number % 3 + 1] AS weight, sum(source_size) OVER () AS total FROM s1),
s3 AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
                 / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level FROM s2
  WINDOW before AS (ORDER BY 3 * source_size / weight::DOUBLE, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, least(max(level) OVER () * weight, (3 * source_size)::DOUBLE) AS target FROM s3),
s5 AS (SELECT *, greatest(16, least(1024, floor(coalesce(min(CASE WHEN target > 0 THEN target END) OVER (), 0) / 256)))::BIGINT AS block
       FROM s4),
s6 AS (SELECT *, floor(total / block::DOUBLE + 0.5)::BIGINT AS every,
              ceil(source_size / greatest(65536, ceil(total / 1048576.0)))::BIGINT AS shards FROM s5),
{_apportioned("s7", "s6", "target", "every", "", "number", "blocks")},
v AS (
  SELECT u.*, number, source_size, target, block,
         ('0x' || substr(key, 1, 8))::BIGINT % greatest(shards, 1) AS shard
  FROM u JOIN s7 ON u.source IS NOT DISTINCT FROM s7.source),
h0 AS (SELECT number, shard, sum(size)::BIGINT AS words, any_value(block) AS block FROM v GROUP BY number, shard),
h1 AS (SELECT *, ceil(words / block::DOUBLE)::BIGINT AS n FROM h0),
o AS (
  SELECT number, CASE WHEN source_size > 0 THEN least(3 * hn, floor(blocks * s7.block * (hn / source_size::DOUBLE) + 0.5)) ELSE 0 END::BIGINT AS quota
  FROM (SELECT number, sum(n) AS hn FROM h1 GROUP BY number) JOIN s7 USING (number)),
h2 AS (SELECT * FROM h1 JOIN o USING (number)),
{_apportioned("h3", "h2", "n", "quota", "number", "shard", "q")},
p AS (
  SELECT v.*, q, n AS nb, ('0x' || substr(md5('11:' || number || ':' || shard), 1, 8))::BIGINT % greatest(n, 1) AS c,
         (sum(size) OVER (PARTITION BY number, shard ORDER BY key, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS hi
  FROM v JOIN h3 USING (number, shard)),
e AS (
  SELECT *, unnest([hi - size, hi]) AS pos, unnest([-1, 1]) AS way FROM p),
g AS (SELECT *, pos // block AS i, ((pos // block) * q + c) // greatest(nb, 1) AS g0,
             ((pos // block + 1) * q + c) // greatest(nb, 1) AS g1 FROM e)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN sum(way * (g0 * block + (pos - i * block) * (g1 - g0))) ELSE 0 END::BIGINT AS taken
FROM g GROUP BY source, doc_id, k0, size, place, source_size, target""",
    "op13_centroids": f"""
WITH kept AS (
  SELECT row_number() OVER () AS rowid_, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM kept
  QUALIFY c < 40),{_ROUNDS}
f AS ({_nearest("kept", "c5")})
SELECT vec_id, f.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY f.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM f JOIN c5 z ON z.c = f.c""",
    "op1_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS least FROM keyed WHERE length(key) >= 10 GROUP BY key
  HAVING count(DISTINCT doc_id) > 1)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (r.least IS NOT NULL AND k.doc_id <> r.least) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                       FILTER (r.least IS NULL OR k.doc_id = r.least), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r USING (key) GROUP BY k.doc_id""",
    "op4_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)""",
    "op6_decontamination": f"""
WITH dw AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
bw AS (SELECT item_id, {_WORDS.format(_LOWER)} AS ws FROM benchmark),
k AS (SELECT DISTINCT least(5, len(ws)) AS k FROM bw WHERE len(ws) > 0),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, len(ws) - k + 1),
             lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS s FROM dw, k WHERE len(ws) >= k),
b AS (SELECT DISTINCT item_id, unnest(list_transform(generate_series(1, len(ws) - least(5, len(ws)) + 1),
             lambda i: array_to_string(ws[i:i + least(5, len(ws)) - 1], ' '))) AS s FROM bw WHERE len(ws) > 0),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles,
       count(*)::DOUBLE / any_value(n_shingles) AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) * 1000 >= any_value(n_shingles) * 800""",
}
