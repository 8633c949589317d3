"""The registered queries of this subpackage and the SQL that must agree with them."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.centroids import cluster_vectors, digest_of
from salesflow.llm.decontaminate import decontaminate
from salesflow.llm.embeddings import link_vectors
from salesflow.llm.hilbert import shards
from salesflow.llm.interaction import audit_filters
from salesflow.llm.licenses import scan_licenses
from salesflow.llm.minhash import near_duplicates
from salesflow.llm.mixing import mix
from salesflow.llm.quality import score_quality
from salesflow.llm.repeats import cut_repeats
from salesflow.llm.secrets import scan_secrets
from salesflow.llm.token_ids import tokenised
from salesflow.llm.toxicity import score_toxicity

ROWS_A_BATCH = 1000
ROOT = str(Path(__file__).resolve().parents[2])
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_package(spark: SparkSession) -> None:
    """Readies a session: its Python workers find this package even where it is not installed, and
    get rows in batches that stay small when every row is a whole document."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_A_BATCH)
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, path]))


def query(name: str, sql: str | None = None):
    """Registers a query, with the SQL it must agree with."""

    def add(run):
        def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
            with_package(spark)
            return run(spark, sf_dir)

        QUERIES[name] = ready
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP9_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
windows AS (
  SELECT DISTINCT id AS item_id, least(len(w), 13) AS k, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS phrase
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM words WHERE kind = 'b' AND len(w) > 0)
),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT id, k, i, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes WHERE kind = 'd' AND len(w) >= k)
),
found AS (SELECT p.id, p.k, p.i, q.item_id FROM places p JOIN windows q ON p.k = q.k AND p.phrase = q.phrase),
hits AS (SELECT id, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT id, i, unnest(range(k)) AS j FROM found) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY id)
SELECT d.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words d LEFT JOIN hits h ON d.id = h.id LEFT JOIN items i ON d.id = i.id WHERE kind = 'd'
"""


@query("op9_benchmark_decontamination", OP9_SQL)
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM words w JOIN lowest USING (doc_id) LEFT JOIN sizes s ON s.doc_id = w.doc_id
"""


@query("op2_minhash_near_dedup", OP2_SQL)
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)


@query("op10_hilbert_sharding")
def op10_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


@query("op7_source_mixing")
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT r, unnest(range(0, len(h) // 2 - 199)) AS i FROM texts WHERE len(h) >= 400),
strings AS (SELECT p.r, i, md5_number(substr(h, 2 * i + 1, 400)) AS s FROM places p JOIN texts t ON t.r = p.r),
again AS (SELECT s FROM strings GROUP BY s HAVING count(*) > 1),
hits AS (SELECT r, i FROM strings JOIN again USING (s)),
runs AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM hits),
spans AS (SELECT r, n, min(i) AS a, max(i) + 200 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY i) AS n FROM runs) GROUP BY r, n),
gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS from_, lead(a) OVER (PARTITION BY r ORDER BY a) AS next FROM spans),
kept AS (
  SELECT g.r, count(*) AS n_spans, sum(b - a) AS n_removed,
    string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
  FROM gaps g JOIN texts t ON t.r = g.r GROUP BY g.r
)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""


@query("op6_suffix_array_dedup", OP6_SQL)
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents")).drop("spans")


OP4_SQL = """
WITH RECURSIVE rows AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT vec_id, e FROM rows
  WHERE e IS NOT NULL AND len(e) > 0 AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in e if x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
),
reach AS (SELECT vec_id AS a, vec_id AS b FROM rows UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, r.vec_id = component_id AS kept
FROM rows r JOIN lowest USING (vec_id) LEFT JOIN degree d ON d.vec_id = r.vec_id
"""


@query("op4_embedding_near_dedup", OP4_SQL)
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


OP11_ROUND = """
near{r} AS MATERIALIZED (
  SELECT row_no, min(struct_pack(d := d, cluster := cluster)) AS best
  FROM (
    SELECT v.row_no, c.cluster, list_sum([(v.q[i] - c.q[i]) * (v.q[i] - c.q[i]) for i in range(1, 65)]) AS d
    FROM vectors v, centroids{r} c
  ) GROUP BY row_no
),"""
OP11_MOVE = """
means{n} AS (
  SELECT cluster, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY i) AS q
  FROM (SELECT best.cluster AS cluster, i, sum(q[i])::BIGINT AS s, count(*)::BIGINT AS n FROM near{r} JOIN vectors USING (row_no), range(1, 65) t(i) GROUP BY ALL)
  GROUP BY cluster
),
centroids{n} AS MATERIALIZED (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM centroids{r} c LEFT JOIN means{n} m USING (cluster)),"""
OP11_SQL = """
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
vectors AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row_no, [floor(256 * x)::BIGINT for x in e] AS q FROM usable),
centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS cluster, q
  FROM (SELECT * FROM vectors ORDER BY sha256('2:' || vec_id), q LIMIT 40)
),""" + "".join(OP11_ROUND.format(r=r) + OP11_MOVE.format(r=r, n=r + 1) for r in range(5)) + OP11_ROUND.format(r=5) + """
spread AS (SELECT best.cluster AS cluster, sum(best.d)::BIGINT AS inertia FROM near5 GROUP BY 1)
SELECT v.vec_id, n.best.cluster::INTEGER AS cluster, n.best.d::BIGINT AS distance, s.inertia AS cluster_inertia,
  (SELECT sum(inertia)::BIGINT FROM spread) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM near5 n JOIN vectors v USING (row_no) JOIN spread s ON s.cluster = n.best.cluster JOIN centroids5 c ON c.cluster = n.best.cluster
"""


@query("op11_centroid_clustering", OP11_SQL)
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cluster_vectors(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("centroid_sha256", digest_of(F.col("centroid"))).drop("centroid")


OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT doc_id, part,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM texts
),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM masks LEFT JOIN flags USING (doc_id) GROUP BY part, mask
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (
  SELECT filter_order, step, filter_order[step] AS f, 1 << (ascii(filter_order[step]) - 65) AS bit,
    list_sum([1 << (ascii(filter_order[i]) - 65) for i in range(1, step + 1)])::INT AS upto
  FROM orders, range(1, 6) s(step)
),
counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN mask & upto = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & upto = bit THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & upto <> bit THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & upto = bit THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & upto = bit THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""


@query("op13_filter_interaction", OP13_SQL)
def op13_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_text(name: str) -> str:
    """A public tokenizer's file as it lies outside this repository."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


@query("op12_token_ids")
def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"), tokenizer_text("word_bpe_49k.json"))


# The columns of further operators that SQL can express, beside the full queries.

ALNUM_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "license_base_places",
    f"""
    WITH phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES
        ('gnu general public license', 'gpl'), ('apache license', 'apache'), ('cc by', 'cc-by'), ('mit license', 'mit')) t(p, label)),
    words AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM_SQL} AS w FROM documents),
    spots AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM words),
    found AS (SELECT r, i - 1 AS spot, label FROM spots, phrases WHERE w[i] = p[1] AND w[i : i + len(p) - 1] = p),
    places AS (SELECT r, count(*) AS n, min(spot) AS low, max(spot) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(low AS BIGINT) AS first_word,
      CAST(high AS BIGINT) AS last_word, coalesce(labels, '') AS base_labels
    FROM words LEFT JOIN places USING (r)
    """,
)
def license_base_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base places of the license scan."""
    return scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


@query(
    "secret_base_counts",
    r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id,
      CAST(len([v for v in regexp_extract_all(text, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) if len(v) >= 8]) AS BIGINT) AS n_assign,
      CAST(len([v for v in regexp_extract_all(text, 'AKIA[A-Z0-9]+') if len(v) >= 16]) AS BIGINT) AS n_access,
      CAST(len([v for v in regexp_extract_all(text, '[0-9a-f]+') if len(v) >= 32]) AS BIGINT) AS n_hex
    FROM t
    """,
)
def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many base spans of each kind the secret scan finds."""
    return scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex")


@query(
    "mix_targets",
    r"""
    WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
    sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS most FROM sources),
    stops AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS k FROM weighed),
    levels AS (
      SELECT a.k, ((SELECT sum(source_size) FROM stops) - coalesce(sum(b.most), 0))::DOUBLE / ((SELECT sum(weight) FROM stops) - coalesce(sum(b.weight), 0)) AS level
      FROM stops a LEFT JOIN stops b ON b.k < a.k GROUP BY a.k
    ),
    final AS (SELECT arg_min(level, k) AS level FROM stops JOIN levels USING (k) WHERE level * weight <= most)
    SELECT doc_id, size, source_size, least(most::DOUBLE, (SELECT level FROM final) * weight) AS target
    FROM sized JOIN stops ON sized.source IS NOT DISTINCT FROM stops.source
    """,
)
def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of the source mix."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target")


@query(
    "shard_balance",
    """
    WITH n AS (SELECT count(*) AS n FROM documents),
    s AS (SELECT shard::INTEGER AS shard, CAST((n * (shard + 1) + 7) // 8 - (n * shard + 7) // 8 AS BIGINT) AS rows FROM n, range(0, 8) t(shard))
    SELECT shard, rows, 'rows' AS law, rows - 1 AS last_slot FROM s
    """,
)
def shard_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and last slot of every shard along the curve."""
    rows = shards(table(spark, sf_dir, "documents"))
    return rows.groupBy("shard", "law").agg(F.count("*").alias("rows"), F.max("slot").alias("last_slot"))
