"""The queries of the core and the SQL they are compared with.

``embeddings`` has no pair at the usual thresholds, so its queries use 0.45 for
duplicates and 0.40 for clusters.  Queries over ``documents`` use token counts
as vectors, at 0.97.  Similarities are rounded to 6 decimals before they
are ranked and compared, on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import runtime
from .functions import names, vectors
from .operators import centroids, clusters, count_search, encode, knn, labels, listing, removal, shards
from .plans import pipelines
from .sinks import writers
from .sources import readers
from .streaming import compactor

Query = Callable[[SparkSession, str], DataFrame]

DUPLICATE, CLUSTER, K = 0.45, 0.40, 20
SHARDS = 2

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings")


def _nodes(df: DataFrame, key: str = "vec_id") -> DataFrame:
    return df.select(F.col(key).alias("id"))


def _hits(spark: SparkSession, sf_dir: str, k: int = K) -> DataFrame:
    return runtime.written(knn.exact_topk(_embeddings(spark, sf_dir), k), "hits")


# --- consolidation of small files, results per folder

_RECORDS = """
WITH e AS (
  SELECT file_id, k - 1 AS pos, trim(fpaths[k], E' \\t\\r\\n') AS path
  FROM fpath_files, unnest(range(1, len(fpaths) + 1)) AS t(k)),
r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY file_id, pos) AS o FROM e WHERE path <> '')
"""


def _compacted(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    folder = f"{runtime.scratch(spark)}/compactor-{uuid.uuid4().hex}"
    return folder, compactor.compact_files(spark, f"{sf_dir}/fpath_files.parquet", folder)


@_query(_RECORDS + "SELECT file_id, pos FROM r WHERE o > 1")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = _compacted(spark, sf_dir)
    return compactor.dropped(spark, folder)


@_query(_RECORDS + "SELECT path, file_id, pos FROM r WHERE o = 1")
def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir)[1]


@_query(_RECORDS + "SELECT path, file_id, pos FROM r WHERE o = 1")
def p2_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as forty small files in two deliveries, in batches of seven files; the last batch is replayed."""
    rows = _table(spark, sf_dir, "fpath_files")
    folder = f"{runtime.scratch(spark)}/compactor-{uuid.uuid4().hex}"
    for part in (0, 1):
        some = rows.filter(F.pmod(F.xxhash64("file_id"), F.lit(2)) == part)
        some.repartition(20, "file_id").write.mode("append").parquet(f"{folder}-in")
        compactor.ingest(spark, f"{folder}-in", folder, files_per_batch=7)
        compactor.settle(spark, folder)
        # the stream lost its note of the last batch: it comes again, under its number
        last = compactor.batches(spark, folder)[-1]
        runtime.remove(spark, f"{folder}/checkpoint/commits/{last}")
    compactor.ingest(spark, f"{folder}-in", folder, files_per_batch=7)
    compactor.settle(spark, folder)
    return compactor.records(spark, folder)


_LISTING = """
WITH raw AS (
  SELECT lower(regexp_replace(trim(folder, E' \\t\\r\\n'), '/+$', '')) AS folder,
    lower(regexp_replace(replace(trim(file_path, E' \\t\\r\\n'), '\\', '/'), '/+', '/', 'g')) AS path
  FROM data_list WHERE folder IS NOT NULL AND file_path IS NOT NULL),
listing AS (
  SELECT DISTINCT folder, path,
    CASE WHEN len(string_split(path, '/')) > 1 AND string_split(path, '/')[-2] = 'portraits'
      THEN string_split(string_split(string_split(path, '/')[-1], '.')[1], '_')[1]
      WHEN len(string_split(path, '/')) > 1 THEN string_split(path, '/')[-2] ELSE '' END AS subject
  FROM raw),
folders AS (
  SELECT folder, count(*) AS listings, count(DISTINCT subject) AS subjects, min(path) AS first_path
  FROM listing GROUP BY folder)
"""


@_query(_LISTING + "SELECT folder FROM folders WHERE listings >= 0.02 * (SELECT sum(listings) FROM folders)")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.large_folders(listing.folder_results(_table(spark, sf_dir, "data_list")))


@_query(_LISTING + "SELECT folder, listings, subjects, first_path FROM folders")
def p5_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.folder_results(_table(spark, sf_dir, "data_list"))


# --- vector expressions

_UNIT = """
n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (SELECT vec_id, list_transform(v, lambda x: x / (sqrt(list_inner_product(v, v)) + 1e-12)) AS v FROM n)
"""


@_query(
    f"WITH {_UNIT} SELECT vec_id, round(sqrt(list_inner_product(v, v)), 6) AS norm, round(v[1], 6) + 0.0 AS first, "
    "round(v[-1], 6) + 0.0 AS last FROM u"
)
def vec_l2_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = _embeddings(spark, sf_dir).select("vec_id", vectors.l2_normalize("embedding").alias("v"))
    at = lambda i: F.round(F.element_at("v", i), 6) + F.lit(0.0)
    return unit.select("vec_id", F.round(vectors.norm("v"), 6).alias("norm"), at(1).alias("first"), at(-1).alias("last"))


@_query(
    "SELECT vec_id, len(embedding[:16] || embedding[-16:]) AS size, embedding[:16] || embedding[-16:] AS joined, "
    "round(embedding[-16]::DOUBLE, 6) + 0.0 AS cut FROM embeddings"
)
def vec_slice_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = vectors.vector_concat(vectors.vector_slice("embedding", 0, 16), vectors.tail("embedding", 16))
    df = _embeddings(spark, sf_dir).select("vec_id", joined.alias("joined"))
    cut = F.round(F.element_at("joined", 17).cast("double"), 6) + F.lit(0.0)
    return df.select("vec_id", F.size("joined").cast("long").alias("size"), "joined", cut.alias("cut"))


# --- search

_SIM = f"""
{_UNIT},
s AS (SELECT a.vec_id AS q, b.vec_id AS n, round(list_inner_product(a.v, b.v), 6) + 0.0 AS sim FROM u a, u b)
"""


def _knn_sql(k: int) -> str:
    return (
        f"{_SIM}, knn AS (SELECT * FROM (SELECT q, CAST(row_number() OVER (PARTITION BY q "
        f"ORDER BY CASE WHEN q = n THEN 0 ELSE 1 END, sim DESC, n) AS INTEGER) AS rk, n, sim FROM s) WHERE rk <= {k})"
    )


_KNN = _knn_sql(K)


@_query(f"WITH {_knn_sql(5)} SELECT q, rk, n, sim FROM knn")
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.exact_topk(_embeddings(spark, sf_dir), 5)


@_query(f"WITH {_KNN} SELECT q, rk, n, sim FROM knn")
def knn_topk_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.exact_topk(_embeddings(spark, sf_dir), K)


@_query(f"WITH {_knn_sql(2)} SELECT q, rk, n, sim FROM knn")
def knn_topk_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two neighbours only: lists that truncate, in blocks of 200."""
    return knn.exact_topk(_embeddings(spark, sf_dir), 2, block=200)


def _sharded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    df = _embeddings(spark, sf_dir)
    size = -(-df.count() // SHARDS)
    return runtime.written(knn.sharded_topk(df, K, SHARDS, size), "sharded"), size


@_query(f"WITH {_KNN} SELECT q, rk, n, sim FROM knn")
def knn_topk_sharded_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.merge_shards(_sharded(spark, sf_dir)[0], K)


# --- links and removal

_CC = """
e AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
cc AS (SELECT x AS id, least(x, min(y)) AS label, greatest(x, max(y)) AS top FROM r GROUP BY x)
"""


def _links_sql(threshold: float, op: str = ">=", name: str = "links") -> str:
    return f"{name} AS (SELECT DISTINCT least(q, n) AS a, greatest(q, n) AS b FROM knn WHERE sim {op} {threshold} AND q <> n)"


@_query(f"WITH {_KNN}, {_links_sql(DUPLICATE)} SELECT a, b FROM links")
def dup_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.links(knn.exact_topk(_embeddings(spark, sf_dir), K), DUPLICATE)


@_query(f"WITH {_KNN}, {_links_sql(DUPLICATE, '>')} SELECT a, b FROM links")
def dup_edges_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.links(knn.exact_topk(_embeddings(spark, sf_dir), K), DUPLICATE, strict=True)


_COMPONENT = f"WITH RECURSIVE {_KNN}, {_links_sql(DUPLICATE)}, {_CC} "


@_query(_COMPONENT + "SELECT id, label AS kept FROM cc WHERE id <> label")
def dedup_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.component_removed(_hits(spark, sf_dir), DUPLICATE)


@_query(_COMPONENT + "SELECT id, top AS kept FROM cc WHERE id <> top")
def dedup_component_keep_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.component_removed(_hits(spark, sf_dir), DUPLICATE, keep="max")


@_query(f"WITH RECURSIVE {_KNN}, {_links_sql(DUPLICATE, '>')}, {_CC} SELECT id, label AS kept FROM cc WHERE id <> label")
def dedup_component_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.component_removed(_hits(spark, sf_dir), DUPLICATE, strict=True)


@_query(f"WITH {_KNN} SELECT DISTINCT n AS id FROM knn WHERE sim > {DUPLICATE} AND n > q")
def dedup_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.greedy_removed(knn.exact_topk(_embeddings(spark, sf_dir), K), DUPLICATE)


@_query(
    f"""WITH {_SIM},
z AS (SELECT CAST(ceil(count(*) / {SHARDS}.0) AS BIGINT) AS width FROM embeddings),
h AS (SELECT q, n, sim, n // width AS sn, q // width AS sq FROM s, z),
c AS (SELECT q, n, sn, sq FROM (SELECT *, row_number() OVER (PARTITION BY q, sn
  ORDER BY CASE WHEN q = n THEN 0 ELSE 1 END, sim DESC, n) AS rk FROM h) WHERE rk <= {K} AND sim > {DUPLICATE} AND q <> n),
r0 AS (SELECT DISTINCT n AS id FROM c WHERE sn = 0 AND q < n),
r1 AS (SELECT n AS id FROM c WHERE sn = 1 AND q < n
  UNION SELECT q FROM c WHERE sn = 0 AND sq = 1 AND n NOT IN (SELECT id FROM r0))
SELECT id FROM r0 UNION SELECT id FROM r1"""
)
def dedup_greedy_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, size = _sharded(spark, sf_dir)
    return removal.sharded_removed(hits, DUPLICATE, SHARDS, size)


# --- groups

_GROUPS = """
g AS (SELECT id AS member, coalesce((SELECT label FROM cc WHERE cc.id = s.id), s.id) AS label FROM stay s),
groups AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS group_id, member FROM g)
"""

_WALL = f"""WITH RECURSIVE {_KNN}, {_links_sql(DUPLICATE)}, {_CC},
removed AS (SELECT id FROM cc WHERE id <> label),
stay AS (SELECT vec_id AS id FROM embeddings WHERE vec_id NOT IN (SELECT id FROM removed)),
links2 AS (SELECT DISTINCT least(q, n) AS a, greatest(q, n) AS b FROM knn WHERE sim >= {CLUSTER} AND q <> n
  AND q IN (SELECT id FROM stay) AND n IN (SELECT id FROM stay)),
e2 AS (SELECT a AS x, b AS y FROM links2 UNION SELECT b, a FROM links2),
r2 AS (SELECT x, y FROM e2 UNION SELECT r2.x, e2.y FROM r2 JOIN e2 ON r2.y = e2.x),
cc2 AS (SELECT x AS id, least(x, min(y)) AS label FROM r2 GROUP BY x),
g AS (SELECT s.id AS member, coalesce(cc2.label, s.id) AS label FROM stay s LEFT JOIN cc2 ON cc2.id = s.id),
groups AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS group_id, member FROM g)
"""


def _wall(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, removed, groups) by the component policy, removed ids as walls."""
    hits, nodes = _hits(spark, sf_dir), _nodes(_embeddings(spark, sf_dir))
    removed = runtime.written(removal.component_removed(hits, DUPLICATE).select("id"), "removed")
    return nodes, removed, clusters.wall_groups(hits, nodes, removed, CLUSTER)


@_query(_WALL + "SELECT group_id, member FROM groups")
def cluster_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wall(spark, sf_dir)[2]


@_query(
    f"""WITH RECURSIVE {_KNN}, {_links_sql(CLUSTER)}, {_CC},
g AS (SELECT s.vec_id AS member, coalesce(cc.label, s.vec_id) AS label FROM embeddings s LEFT JOIN cc ON cc.id = s.vec_id)
SELECT dense_rank() OVER (ORDER BY label) - 1 AS group_id, member FROM g"""
)
def cluster_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.plain_groups(_hits(spark, sf_dir), _nodes(_embeddings(spark, sf_dir)), CLUSTER)


_BRIDGE = f"""WITH RECURSIVE {_KNN},
removed AS (SELECT DISTINCT n AS id FROM knn WHERE sim > {DUPLICATE} AND n > q),
h AS (SELECT q, n FROM knn WHERE sim > {CLUSTER} AND n NOT IN (SELECT id FROM removed)),
rows AS (SELECT q, n AS member FROM h UNION SELECT q, q FROM h WHERE q NOT IN (SELECT id FROM removed)),
links AS (SELECT DISTINCT x.member AS a, y.member AS b FROM rows x JOIN rows y ON x.q = y.q AND x.member < y.member),
{_CC},
m AS (SELECT DISTINCT member FROM rows),
g AS (SELECT m.member, coalesce(cc.label, m.member) AS label FROM m LEFT JOIN cc ON cc.id = m.member),
groups AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS group_id, member FROM g)
"""


@_query(_BRIDGE + "SELECT group_id, member FROM groups")
def cluster_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _hits(spark, sf_dir)
    return clusters.bridge_groups(hits, runtime.written(removal.greedy_removed(hits, DUPLICATE), "removed"), CLUSTER)


@_query(
    _BRIDGE.replace(f"removed AS (SELECT DISTINCT n AS id FROM knn WHERE sim > {DUPLICATE} AND n > q)", "removed AS (SELECT NULL::BIGINT AS id WHERE false)")
    + "SELECT group_id, member FROM groups"
)
def cluster_bridge_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists merged without a removal."""
    hits = _hits(spark, sf_dir)
    return clusters.bridge_groups(hits, spark.createDataFrame([], "id long"), CLUSTER)


# --- token-count vectors of documents, hashed to a fixed number of dimensions

BUCKETS = 512

_TOKENS = f"""
t AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 6) AS BIGINT) % {BUCKETS} AS k FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\n\\r]+')) AS w FROM documents WHERE text IS NOT NULL) WHERE w <> ''),
f AS (SELECT doc_id, k, count(*) AS c FROM t GROUP BY ALL),
l AS (SELECT doc_id, sqrt(sum(c * c)) + 1e-12 AS len FROM f GROUP BY doc_id),
s AS (SELECT x.doc_id AS q, y.doc_id AS n, sum(x.c * y.c) AS dot FROM f x JOIN f y USING (k) GROUP BY ALL),
v AS (SELECT q, n, round(dot / (a.len * b.len), 6) AS sim FROM s JOIN l a ON a.doc_id = q JOIN l b ON b.doc_id = n),
knn AS (SELECT * FROM (SELECT q, row_number() OVER (PARTITION BY q
  ORDER BY CASE WHEN q = n THEN 0 ELSE 1 END, sim DESC, n) AS rk, n, sim FROM v) WHERE rk <= 100)
"""


def _document_hits(spark: SparkSession, sf_dir: str, least: float, k: int = 100) -> DataFrame:
    """Hit lists of documents by the cosine of their token counts, without hits below ``least``."""
    words = F.filter(F.split(F.lower("text"), "[ \\t\\n\\r]+"), lambda w: w != "")
    texts = _table(spark, sf_dir, "documents").filter("text IS NOT NULL AND doc_id IS NOT NULL")
    counts = runtime.written(count_search.word_counts(texts, "doc_id", words, BUCKETS), "tokens")
    return runtime.written(count_search.counted_topk(counts, k, least, BUCKETS), "document-hits")


@_query(f"WITH RECURSIVE {_TOKENS}, {_links_sql(0.97)}, {_CC} SELECT id, label AS kept FROM cc WHERE id <> label")
def dedup_component_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.component_removed(_document_hits(spark, sf_dir, 0.97), 0.97)


@_query(f"WITH {_TOKENS} SELECT DISTINCT n AS id FROM knn WHERE sim > 0.97 AND n > q")
def dedup_greedy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal.greedy_removed(_document_hits(spark, sf_dir, 0.97), 0.97)


# --- reports

@_query(_WALL + "SELECT size, count(*) AS groups FROM (SELECT group_id, count(*) AS size FROM groups GROUP BY ALL) GROUP BY size")
def size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.size_histogram(_wall(spark, sf_dir)[2])


@_query(
    _WALL
    + """SELECT (SELECT count(*) FROM embeddings) AS original, (SELECT count(*) FROM removed) AS removed,
count(*) AS groups, CAST(sum(size) AS BIGINT) AS members, max(size) AS largest
FROM (SELECT group_id, count(*) AS size FROM groups GROUP BY group_id)"""
)
def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.summary(*_wall(spark, sf_dir))


@_query(
    _WALL
    + """, sz AS (SELECT group_id, count(*) AS size FROM groups GROUP BY group_id),
lines AS (SELECT 0 AS line_no, 'Group sizes:' AS value
UNION ALL SELECT size + 1, ' Size ' || size || ': ' || count(*) || ' group(s)' FROM sz GROUP BY size
UNION ALL SELECT 4611686018427387904, 'Removed ' || (SELECT count(*) FROM removed) || ' duplicate images')
SELECT line_no, value FROM lines"""
)
def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, removed, groups = _wall(spark, sf_dir)
    return writers.report_lines(groups, removed.count())


_LABELS = """
SELECT 'group_' || CASE WHEN group_id < 10000 THEN lpad(CAST(group_id AS VARCHAR), 4, '0') ELSE CAST(group_id AS VARCHAR) END AS folder,
  'class ' || label || '/' || vec_id || '.jpg' AS file_path
FROM groups JOIN embeddings ON vec_id = member
"""


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("class "), F.col("label").cast("string"), F.lit("/"), F.col("vec_id").cast("string"), F.lit(".jpg"))
    items = _embeddings(spark, sf_dir).select("vec_id", path.alias("path"))
    return labels.label_rows(_wall(spark, sf_dir)[2], items, key="vec_id")


@_query(_WALL + _LABELS)
def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir)


def _short(c: str) -> str:
    return f"CASE WHEN {c} >= 1000 THEN CAST({c} // 1000 AS VARCHAR) || 'K' ELSE CAST({c} AS VARCHAR) END"


@_query(
    f"""WITH n AS (SELECT count(DISTINCT folder) AS c, count(*) AS d FROM data_list)
SELECT 'train_' || {_short('c')} || '_class_' || {_short('d')} || '_data_classes' AS classes_name,
  'train_' || {_short('c')} || '_class_' || {_short('d')} || '_data_data_list' AS data_name FROM n"""
)
def label_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_file_names(_table(spark, sf_dir, "data_list"))


@_query(
    """WITH n AS (SELECT count(DISTINCT folder) // 1000 AS c, count(*) // 1000000 AS d, count(*) // 1000 AS k FROM data_list)
SELECT 'remap' AS policy, 'fr-train_' || c || 'k_' || d || 'M-classes' AS classes_name, 'fr-train_' || c || 'k_' || d || 'M-data_list' AS data_name FROM n
UNION ALL SELECT 'annotation', 'gen_x_' || c || 'k-c_' || k || 'k-d_classes', 'gen_x_' || c || 'k-c_' || k || 'k-d_data_list' FROM n"""
)
def label_names_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "data_list")
    one = labels.remap_file_names(rows).withColumn("policy", F.lit("remap"))
    return one.unionByName(labels.annotation_file_names(rows, "gen", "x").withColumn("policy", F.lit("annotation")))


@_query(
    _WALL
    + """, sz AS (SELECT group_id, count(*) AS size FROM groups GROUP BY group_id),
top AS (SELECT group_id, CAST(row_number() OVER (ORDER BY size DESC, group_id) - 1 AS INTEGER) AS rank FROM sz)
SELECT rank, group_id, pos, member FROM (
  SELECT rank, g.group_id, CAST(row_number() OVER (PARTITION BY g.group_id ORDER BY member) - 1 AS INTEGER) AS pos, member
  FROM groups g JOIN top USING (group_id) WHERE rank < 50) WHERE pos < 10"""
)
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.preview(_wall(spark, sf_dir)[2])


@_query(_WALL + "SELECT group_id, min(member) AS member FROM groups GROUP BY group_id")
def group_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.representatives(_wall(spark, sf_dir)[2])


@_query(
    _WALL
    + "SELECT group_id, member FROM groups WHERE group_id IN (SELECT group_id FROM groups GROUP BY group_id HAVING count(*) BETWEEN 2 AND 4)"
)
def size_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.size_band(_wall(spark, sf_dir)[2], 2, 4)


@_query(_WALL + "SELECT group_id, string_agg(CAST(member AS VARCHAR), ', ' ORDER BY member) AS value FROM groups GROUP BY group_id")
def group_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.group_lines(_wall(spark, sf_dir)[2])


@_query(_WALL + "SELECT group_id, row_number() OVER (PARTITION BY group_id ORDER BY member) - 1 AS pos, member FROM groups")
def group_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups written as text lines and read again; the line number is the group."""
    folder = f"{runtime.scratch(spark)}/group-text-{uuid.uuid4().hex}"
    writers.group_lines(_wall(spark, sf_dir)[2]).orderBy("group_id").select("value").coalesce(1).write.text(folder)
    return readers.parse_group_text(readers.line_list(spark, folder)).select(
        "group_id", F.col("pos").cast("long").alias("pos"), "member"
    )


# --- centroids

_CENTROID = """
p AS (SELECT label, vec_id, k, embedding[k]::DOUBLE AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(k)),
c AS (SELECT label, k, avg(x) AS m FROM p GROUP BY label, k)
"""


@_query(
    f"WITH {_CENTROID} SELECT label AS class, k - 1 AS pos, round(m, 6) + 0.0 AS mean, "
    "(SELECT count(*) FROM embeddings e WHERE e.label = c.label) AS n FROM c"
)
def centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = centroids.centroids(_embeddings(spark, sf_dir))
    return rows.select("class", "n", F.posexplode("centroid").alias("pos", "m")).select(
        "class", "n", F.col("pos").cast("long").alias("pos"), (F.round("m", 6) + F.lit(0.0)).alias("mean")
    )


@_query(
    f"""WITH {_CENTROID},
d AS (SELECT p.label, vec_id, sum(x * m) AS dot, sqrt(sum(x * x)) AS lx, sqrt(sum(m * m)) AS lm
  FROM p JOIN c USING (label, k) GROUP BY p.label, vec_id)
SELECT label AS class, vec_id AS id, round(dot / (lx * lm), 6) + 0.0 AS score FROM d"""
)
def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.divergence(_embeddings(spark, sf_dir))


@_query(
    """WITH p AS (SELECT label, vec_id, k, embedding[k]::DOUBLE AS x FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(k)),
z AS (SELECT vec_id, sqrt(sum(x * x)) AS len FROM p WHERE k > 32 GROUP BY vec_id),
y AS (SELECT label, k, CASE WHEN k > 32 THEN x / len ELSE x END AS x FROM p JOIN z USING (vec_id))
SELECT label AS class, k - 1 AS pos, round(avg(x), 6) + 0.0 AS mean FROM y GROUP BY label, k"""
)
def condition_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of leading features followed by the normalised embedding."""
    joint = encode.split_joint(_embeddings(spark, sf_dir), final=32)
    rows = centroids.condition_centroids(joint, "label", "mid", "final")
    return rows.select("class", F.posexplode("centroid").alias("pos", "m")).select(
        "class", F.col("pos").cast("long").alias("pos"), (F.round("m", 6) + F.lit(0.0)).alias("mean")
    )


# --- paths, classes, catalogs

_PATHS = """
SELECT list_pos,
  CASE WHEN len(s) > 2 THEN s[-3] || '/' || s[-2] WHEN len(s) = 2 THEN s[-2] ELSE '' END AS parents,
  substr(s[-1], 1, greatest(len(s[-1]) - 4, 0)) AS file_class,
  CASE WHEN contains(file_path, 'portraits') THEN substr(s[-1], 1, greatest(len(s[-1]) - 4, 0))
    WHEN len(s) > 2 THEN s[-3] || '/' || s[-2] WHEN len(s) = 2 THEN s[-2] ELSE '' END AS dispatched,
  CASE WHEN coalesce(s[-3], '') = 'kiosk' THEN coalesce(s[-2], '') ELSE coalesce(s[-3], '') || '/' || coalesce(s[-2], '') END AS below,
  string_split(s[-1], '_pid')[1] AS scene,
  coalesce(TRY_CAST(nullif(regexp_extract(s[-1], 'cnt([0-9]+)(\\.|$)', 1), '') AS INTEGER), -1) AS frame,
  string_split(s[-1], '.')[1] AS stem,
  replace(folder, '/', '_') AS flat
FROM (SELECT *, string_split(file_path, '/') AS s FROM data_list WHERE file_path IS NOT NULL)
"""


@_query(_PATHS)
def path_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = names.base_name("file_path")
    return _table(spark, sf_dir, "data_list").filter("file_path IS NOT NULL").select(
        "list_pos",
        names.class_from_parents("file_path").alias("parents"),
        names.class_from_file("file_path").alias("file_class"),
        names.class_of("file_path", "portraits").alias("dispatched"),
        names.class_below("file_path", "kiosk").alias("below"),
        names.scene_of(base).alias("scene"),
        F.coalesce(names.frame_of(base), F.lit(-1)).alias("frame"),
        names.stem_of(base).alias("stem"),
        names.flat_folder("folder").alias("flat"),
    )


@_query(
    """SELECT o_orderkey AS n, 'group_' || CASE WHEN o_orderkey < 10000 THEN lpad(CAST(o_orderkey AS VARCHAR), 4, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS padded,
CASE WHEN o_orderkey >= 1000 THEN CAST(o_orderkey // 1000 AS VARCHAR) || 'K' ELSE CAST(o_orderkey AS VARCHAR) END AS short,
least(o_orderkey, o_custkey) AS a, greatest(o_orderkey, o_custkey) AS b FROM orders"""
)
def number_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = names.undirected("o_orderkey", "o_custkey")
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("n"),
        names.group_name("o_orderkey").alias("padded"),
        names.thousands("o_orderkey").alias("short"),
        a.alias("a"),
        b.alias("b"),
    )


@_query(
    """SELECT file_id, file_name, list_transform(CASE WHEN len(regexp_extract_all(file_name, '\\d+')) > 0 THEN regexp_extract_all(file_name, '\\d+') ELSE ['0'] END, lambda x: CAST(x AS BIGINT)) AS key
FROM fpath_files WHERE file_name IS NOT NULL"""
)
def natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.transform(names.natural_key("file_name"), lambda x: x.cast("long"))
    return _table(spark, sf_dir, "fpath_files").filter("file_name IS NOT NULL").select("file_id", "file_name", key.alias("key"))


def _class_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Groups of duplicate documents, and each document's class (its source)."""
    hits = _hits(spark, sf_dir)
    groups = clusters.plain_groups(hits, _nodes(_embeddings(spark, sf_dir)), CLUSTER)
    classes = _table(spark, sf_dir, "documents").filter("source IS NOT NULL").select(F.col("doc_id").alias("member"), F.col("source").alias("class"))
    return groups, classes


_MAP = f"""WITH RECURSIVE {_KNN}, {_links_sql(CLUSTER)}, {_CC},
g AS (SELECT s.vec_id AS member, coalesce(cc.label, s.vec_id) AS label FROM embeddings s LEFT JOIN cc ON cc.id = s.vec_id),
groups AS (SELECT dense_rank() OVER (ORDER BY label) - 1 AS group_id, member, label FROM g),
w AS (SELECT group_id, member, d.source AS class, f.source AS target FROM groups
  JOIN documents d ON d.doc_id = member JOIN documents f ON f.doc_id = label WHERE d.source IS NOT NULL AND f.source IS NOT NULL),
map AS (SELECT class, arg_max(target, group_id * 1000000000 + member) AS target FROM w GROUP BY class)
"""


@_query(_MAP + "SELECT class, target FROM map")
def class_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.class_map(*_class_sides(spark, sf_dir))


@_query(_MAP + "SELECT DISTINCT target AS class FROM map")
def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.class_list(labels.class_map(*_class_sides(spark, sf_dir)))


@_query(_MAP + "SELECT target AS folder, source || '/' || doc_id AS file_path FROM documents JOIN map ON source = class")
def catalog_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = labels.class_map(*_class_sides(spark, sf_dir))
    catalog = _table(spark, sf_dir, "documents").select("source", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    return labels.relabel(catalog, mapping, "path", F.col("source"))


@_query(
    _MAP
    + """SELECT count(*) FILTER (WHERE source IN (SELECT class FROM map)) AS hits,
count(*) FILTER (WHERE source IS NULL OR source NOT IN (SELECT class FROM map)) AS misses FROM documents"""
)
def catalog_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = labels.class_map(*_class_sides(spark, sf_dir))
    return labels.relabel_counts(_table(spark, sf_dir, "documents"), mapping, F.col("source"))


@_query(
    """WITH o AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS last FROM documents WHERE source IS NOT NULL),
p AS (SELECT source, CASE WHEN last = 1 THEN source || '/origin.jpg' ELSE source || '/' || doc_id END AS path, doc_id, last = 1 AS is_origin FROM o)
SELECT source AS folder, path AS file_path, 0 AS pos FROM p WHERE is_origin
UNION ALL SELECT source, path, k FROM (SELECT source, path, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS k FROM p WHERE NOT is_origin) WHERE k < 9"""
)
def capped_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").filter("source IS NOT NULL").select("source", "doc_id")
    last = rows.groupBy("source").agg(F.max("doc_id").alias("last"))
    name = F.when(F.col("doc_id") == F.col("last"), "origin.jpg").otherwise(F.col("doc_id").cast("string"))
    items = rows.join(last, "source").select(
        F.col("source").alias("folder"), F.concat("source", F.lit("/"), name).alias("file_path"), "doc_id"
    )
    return labels.capped(items, 9, "doc_id")


@_query(
    """SELECT event_id, CAST(json_merge_patch(props, json_object('img_path', 'img/' || event_id, 'frame_cnt', user_id, 'scene_str', event_type)) AS VARCHAR) AS document
FROM events"""
)
def json_augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with fields added, as text: numbers stay numbers."""
    events = _table(spark, sf_dir, "events")
    fields = {
        "img_path": F.concat(F.lit("img/"), F.col("event_id").cast("string")),
        "frame_cnt": F.col("user_id"),
        "scene_str": F.col("event_type"),
    }
    return events.select("event_id", labels.augment_json(events, "props", fields).alias("document"))


# --- shards, splits, encoder

@_query(
    """WITH r(rows) AS (SELECT count(*) FROM lineitem),
q AS (SELECT rows, least(rows // 3 + rows % 3, 7000) AS size FROM r),
j AS (SELECT rows, size, CAST(ceil(rows / size::DOUBLE) AS BIGINT) AS jobs FROM q),
e AS (SELECT *, jobs // 3 AS each FROM j)
SELECT CASE WHEN each = 0 THEN 2 ELSE least(job // each, 2) END AS rank, job, job * size AS start, least(rows, (job + 1) * size) AS "end"
FROM e, unnest(range(0, jobs)) AS t(job)"""
)
def shard_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").count()
    jobs = [(j.rank, j.job, j.start, j.end) for j in shards.plan_jobs(rows, 3, 7000)]
    return spark.createDataFrame(jobs, "rank long, job long, start long, end long")


@_query("SELECT o_orderkey // 4000 AS part, count(*) AS rows, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1")
def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in contiguous parts by index and read again."""
    folder = f"{runtime.scratch(spark)}/parts-{uuid.uuid4().hex}"
    writers.write_split(_table(spark, sf_dir, "orders").select("o_orderkey"), folder, "o_orderkey", 4000)
    rows = spark.read.parquet(folder)
    return rows.groupBy(F.col("part").cast("long").alias("part")).agg(
        F.count("*").alias("rows"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")
    )


@_query(
    """SELECT row_number() OVER (ORDER BY file_id, k) - 1 AS data_index, trim(fpaths[k], E' \\t\\r\\n') AS path
FROM fpath_files, unnest(range(1, len(fpaths) + 1)) AS t(k) WHERE trim(fpaths[k], E' \\t\\r\\n') <> ''"""
)
def path_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of paths, one file after the other, as a catalog with a dense index."""
    rows = compactor.entries(_table(spark, sf_dir, "fpath_files"))
    return readers.with_index(rows, "file_id", "pos").select("data_index", "path")


@_query()
def encode_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("data_index"), F.coalesce("text", F.lit("")).alias("content"))
    return encode.encode(items, encode.hashed_features, dim=encode.FINAL)


# --- sources and sinks: what is written comes back


def _folder(spark: SparkSession, name: str) -> str:
    return f"{runtime.scratch(spark)}/{name}-{uuid.uuid4().hex}"


_EMBEDDED_PATH = "'class ' || label || '/' || vec_id || '.jpg'"


@_query(
    f"SELECT vec_id AS data_index, k - 1 AS pos, CAST(embedding[k] AS DOUBLE) AS x, {_EMBEDDED_PATH} AS path "
    "FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(k)"
)
def npy_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors and paths as array shards of 150 rows, read in ranges of 64 rows and paired by position."""
    folder = _folder(spark, "npy")
    rows = _embeddings(spark, sf_dir).select(F.col("vec_id").alias("data_index"), "embedding", F.expr(_EMBEDDED_PATH).alias("path"))
    writers.write_npy(rows, folder, rows_per_file=150)
    writers.write_npy(rows, folder, "fpaths_", value="path", rows_per_file=150)
    back = readers.npy_table(spark, folder)
    return back.select("data_index", "path", F.posexplode(vectors.as_double("embedding")).alias("pos", "x")).select(
        "data_index", F.col("pos").cast("long").alias("pos"), "x", "path"
    )


@_query(
    """SELECT row_number() OVER (ORDER BY list_pos) - 1 AS data_index, trim(file_path, E' \\t\\r\\n') AS path
FROM data_list WHERE trim(file_path, E' \\t\\r\\n') <> ''"""
)
def path_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths as one text file, numbered by line when read again in byte ranges."""
    folder = _folder(spark, "paths")
    rows = _table(spark, sf_dir, "data_list").select("list_pos", "file_path")
    rows.repartition(1).sortWithinPartitions("list_pos").select(F.coalesce("file_path", F.lit("")).alias("value")).write.text(folder)
    return readers.path_list(spark, folder).select("data_index", "path")


_NAMED = "SELECT n_nationkey, n_regionkey, 'region ' || n_regionkey || '/' || n_nationkey || ['.jpg', '.PNG', '.txt', '.webp'][n_nationkey % 4 + 1] AS name, n_name AS content FROM nation"


def _named_files(spark: SparkSession, sf_dir: str) -> str:
    """A file for each nation, in an output folder made anew."""
    folder = writers.fresh_folder(spark, writers.fresh_folder(spark, _folder(spark, "images")), replace=True)
    suffix = F.element_at(F.array(*map(F.lit, (".jpg", ".PNG", ".txt", ".webp"))), (F.col("n_nationkey") % 4 + 1).cast("int"))
    name = F.concat(F.lit("region "), F.col("n_regionkey").cast("string"), F.lit("/"), F.col("n_nationkey").cast("string"), suffix)
    writers.write_files(_table(spark, sf_dir, "nation").select(name.alias("name"), F.col("n_name").alias("content")), folder)
    return folder


def _below(column: str, parts: int = 2) -> F.Column:
    return F.substring_index(column, "/", -parts)


@_query(
    f"WITH f AS ({_NAMED}) SELECT name, row_number() OVER (ORDER BY name) - 1 AS data_index FROM f "
    "WHERE lower(string_split(name, '.')[-1]) IN ('jpg', 'png', 'webp')"
)
def image_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = readers.image_folder(spark, _named_files(spark, sf_dir))
    return listed.select(_below("path").alias("name"), "data_index")


@_query(f"WITH f AS ({_NAMED}) SELECT name, content FROM f WHERE name LIKE '%.jpg'")
def image_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readers.image_bytes(spark, _named_files(spark, sf_dir))
    return found.select(_below("path").alias("name"), F.decode("content", "UTF-8").alias("content"))


@_query(f"WITH f AS ({_NAMED}) SELECT name, length(content) AS size FROM f WHERE name LIKE '%.webp'")
def listed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of listed files, read by path."""
    folder = _named_files(spark, sf_dir)
    listed = readers.image_folder(spark, folder, suffixes=("webp",))
    return encode.read_files(listed).select(_below("path").alias("name"), F.length("content").cast("long").alias("size"))


@_query("SELECT n_regionkey AS rank, n_nationkey AS idx, CAST(row_number() OVER (ORDER BY n_regionkey, n_nationkey) - 1 AS INTEGER) AS shard FROM nation")
def ranked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "ranked")
    name = F.format_string("temp-%d_%d_embs.npy", "n_regionkey", "n_nationkey")
    writers.write_files(_table(spark, sf_dir, "nation").select(name.alias("name"), F.col("n_name").alias("content")), folder)
    return readers.ranked_files(spark, folder).select("rank", "idx", "shard")


@_query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON file per row, read again."""
    folder = _folder(spark, "json")
    rows = _table(spark, sf_dir, "supplier").select(
        F.to_json(F.struct("s_suppkey", "s_name", "s_nationkey")).alias("json"),
        F.concat(F.col("s_suppkey").cast("string"), F.lit(".json")).alias("name"),
    )
    writers.write_json_documents(rows, folder, name="name")
    held = F.from_json("json", "s_suppkey long, s_name string, s_nationkey int")
    return readers.json_documents(spark, folder).select(held.alias("d")).select("d.*")


@_query(
    """SELECT c_custkey, json_object('img_path', '/root/s' || c_custkey || '_pid1_cnt' || c_nationkey || '.jpg', 'frame_cnt', c_nationkey,
'scene_str', 's' || c_custkey, 'face_id', c_nationkey) AS fields FROM customer
WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY c_nationkey HAVING count(*) BETWEEN 4 AND 1000)"""
)
def annotated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the members of groups of a size band, with the image's and the group's fields."""
    rows = _table(spark, sf_dir, "customer")
    groups = rows.select(F.col("c_nationkey").cast("long").alias("group_id"), F.col("c_custkey").alias("member"))
    path = F.format_string("s%d_pid1_cnt%d.jpg", "c_custkey", "c_nationkey")
    items = rows.select(F.col("c_custkey").alias("member"), path.alias("path"))
    documents = rows.select(F.regexp_replace(path, "jpg$", "json").alias("path"), F.to_json(F.struct("c_custkey")).alias("json"))
    done = labels.annotated(clusters.size_band(groups, 4, 1000), items, documents, "/root/")
    held = done.select(F.from_json("json", "c_custkey long, img_path string, frame_cnt string, scene_str string, face_id string").alias("d"), "json")
    text = F.concat(F.lit("{"), F.substring_index(F.col("json"), ",", -4))
    return held.select("d.c_custkey", text.alias("fields"))


@_query("SELECT o_orderkey // 1000 AS batch, count(*) AS rows, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders GROUP BY 1")
def batch_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "batches")
    rows = _table(spark, sf_dir, "orders").withColumn("batch", F.floor(F.col("o_orderkey") / 1000)).select("batch", "o_custkey")
    writers.write_batches(rows, folder)
    back = spark.read.parquet(folder).groupBy(F.col("batch").cast("long").alias("batch"))
    return back.agg(F.count("*").alias("rows"), F.sum("o_custkey").alias("total"))


@_query(
    f"""WITH {_CENTROID},
d AS (SELECT p.label, vec_id, sum(x * m) AS dot, sqrt(sum(x * x)) AS lx, sqrt(sum(m * m)) AS lm
  FROM p JOIN c USING (label, k) GROUP BY p.label, vec_id)
SELECT 'a_' || label AS folder, 'x, "' || vec_id || '"' AS file_path, round(dot / (lx * lm), 6) + 0.0 AS score FROM d"""
)
def divergence_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores as comma-separated lines, with names that need quotes."""
    folder = _folder(spark, "scores")
    rows = centroids.divergence(_embeddings(spark, sf_dir)).select(
        F.concat(F.lit("a/"), F.col("class").cast("string")).alias("folder"),
        F.concat(F.lit('x, "'), F.col("id").cast("string"), F.lit('"')).alias("file_path"),
        "score",
    )
    writers.write_divergence(rows, folder)
    return spark.read.schema("folder string, file_path string, score double").csv(folder)


@_query(f"WITH {_CENTROID} SELECT 'k_' || label AS class, k - 1 AS pos, round(m, 6) + 0.0 AS mean FROM c")
def centroid_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for every class; joint vectors, averaged as they are."""
    folder = _folder(spark, "centroids")
    rows = _embeddings(spark, sf_dir).select(F.concat(F.lit("k/"), F.col("label").cast("string")).alias("label"), "embedding")
    writers.write_centroids(centroids.condition_centroids(rows, "label", joint="embedding"), folder, per_class=True)
    return spark.read.parquet(folder).select("class", F.posexplode("centroid").alias("pos", "m")).select(
        "class", F.col("pos").cast("long").alias("pos"), (F.round("m", 6) + F.lit(0.0)).alias("mean")
    )


_SHARD_HITS = f"""{_SIM},
z AS (SELECT CAST(ceil(count(*) / {SHARDS}.0) AS BIGINT) AS width FROM embeddings),
hits AS (SELECT * FROM (SELECT CAST(n // width AS INTEGER) AS shard, q, CAST(row_number() OVER (PARTITION BY q, n // width
  ORDER BY CASE WHEN q = n THEN 0 ELSE 1 END, sim DESC, n) AS INTEGER) AS rk, n, sim FROM s, z) WHERE rk <= {K})
"""


@_query(f"WITH {_SHARD_HITS} SELECT shard, q, rk, n, sim FROM hits")
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rank searches its own shards and writes them beside the others'."""
    df, folder = _embeddings(spark, sf_dir), _folder(spark, "shards")
    rows = df.count()
    for rank in range(SHARDS):
        mine = [j for j in shards.plan_jobs(rows, SHARDS, -(-rows // SHARDS)) if j.rank == rank]
        found = knn.sharded_topk(df, K, mine[-1].job + 1, mine[0].end - mine[0].start, first=mine[0].job)
        writers.write_knn(found, folder, beside=True)
    return spark.read.parquet(folder).select("shard", "q", "rk", "n", "sim")


@_query(
    f"""WITH RECURSIVE {_SHARD_HITS},
c AS (SELECT q, n, n // width AS sn, q // width AS sq FROM hits, z WHERE sim > {DUPLICATE} AND q <> n),
r0 AS (SELECT DISTINCT n AS id FROM c WHERE sn = 0 AND q < n),
r1 AS (SELECT n AS id FROM c WHERE sn = 1 AND q < n
  UNION SELECT q FROM c WHERE sn = 0 AND sq = 1 AND n NOT IN (SELECT id FROM r0)),
removed AS (SELECT id FROM r0 UNION SELECT id FROM r1),
h AS (SELECT q, n FROM hits WHERE sim > {CLUSTER} AND n NOT IN (SELECT id FROM removed)),
rows AS (SELECT q, n AS member FROM h UNION SELECT q, q FROM h WHERE q NOT IN (SELECT id FROM removed)),
links AS (SELECT DISTINCT x.member AS a, y.member AS b FROM rows x JOIN rows y ON x.q = y.q AND x.member < y.member),
{_CC},
m AS (SELECT DISTINCT member FROM rows),
g AS (SELECT m.member, coalesce(cc.label, m.member) AS label FROM m LEFT JOIN cc ON cc.id = m.member)
SELECT dense_rank() OVER (ORDER BY label) - 1 AS group_id, member FROM g"""
)
def process_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal and groups out of stored lists of shards."""
    hits, size = _sharded(spark, sf_dir)
    config = pipelines.Config(policy="bridge", duplicate=DUPLICATE, cluster=CLUSTER, k=K, max_shard=size)
    return pipelines.process_hits(hits, config, SHARDS).groups


@_query(
    """SELECT vec_id AS q, CAST(k AS INTEGER) AS rk, CAST([7, -1, 0, 3][k] + 100 AS BIGINT) AS n, CAST(embedding[k] AS DOUBLE) AS sim
FROM embeddings, unnest([1, 3, 4]) AS t(k)"""
)
def wide_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide lists of a shard as rows: padding left out, the shard's offset added."""
    wide = _embeddings(spark, sf_dir).select("vec_id", F.slice("embedding", 1, 4).alias("scores"), F.array(*map(F.lit, (7, -1, 0, 3))).alias("indices"))
    return knn.to_long(wide, "vec_id", "scores", "indices", offset=100)


@_query(
    "SELECT vec_id, k - 1 AS pos, CAST(CAST(CAST(embedding[k] AS DOUBLE) * 3 AS FLOAT) AS DOUBLE) AS x "
    "FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(k)"
)
def float_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    tripled = F.transform(vectors.as_double("embedding"), lambda x: x * 3)
    cast = _embeddings(spark, sf_dir).select("vec_id", F.posexplode(vectors.as_float(tripled)).alias("pos", "x"))
    return cast.select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("x").cast("double").alias("x"))


@_query("SELECT CAST(o_orderkey % 3 AS INTEGER) AS shard, o_orderkey, o_custkey, o_orderstatus FROM orders")
def union_and_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three shards on top of each other, and two columns side by side by index."""
    rows = _table(spark, sf_dir, "orders")
    left = readers.union_shards([rows.filter(F.col("o_orderkey") % 3 == n).select("o_orderkey", "o_custkey") for n in range(3)])
    return readers.zip_by_index(left, rows.select("o_orderkey", "o_orderstatus"), "o_orderkey")


@_query(
    """WITH r AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IS NOT DISTINCT FROM lag(o_orderstatus) OVER w
  AND lag(o_orderkey) OVER w IS NOT NULL THEN 0 ELSE 1 END AS fresh FROM orders WINDOW w AS (ORDER BY o_orderkey))
SELECT o_orderkey, CAST(sum(fresh) OVER (ORDER BY o_orderkey) AS BIGINT) AS run FROM r"""
)
def folder_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of equal values along an order: what a scan of sorted shards closes one by one."""
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return centroids.flush_groups(rows, "o_orderstatus", "o_orderkey").select("o_orderkey", "run")


@_query(
    """WITH m AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM embeddings),
r AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY pos) AS k FROM m WHERE vec_id % 3 <> 0)
SELECT 'group_' || lpad(CAST(label AS VARCHAR), 4, '0') AS folder, vec_id || '.ppm' AS name FROM r WHERE k <= 10"""
)
def preview_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten readable images of each class; every third is unreadable."""
    place = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    image = F.concat(F.encode(F.lit("P6 1 1 255\n"), "UTF-8"), F.unhex(F.lit("102030")))
    members = _embeddings(spark, sf_dir).select(
        F.col("label").alias("rank"),
        place.alias("pos"),
        F.concat(F.lit("x/"), F.col("vec_id").cast("string"), F.lit(".ppm")).alias("path"),
        F.when(F.col("vec_id") % 3 != 0, image).otherwise(F.unhex(F.lit("00"))).alias("content"),
    )
    return writers.sheet_images(members, encode.decode_image, band=True).select("folder", "name")


@_query(
    """WITH p AS (SELECT n_nationkey, (n_nationkey * 10 / 255.0 - 0.5) / 0.5 AS v FROM nation)
SELECT CAST(n_nationkey AS BIGINT) AS data_index, CAST(k AS BIGINT) AS pos, round(v * k, 5) + 0.0 AS value FROM p, unnest([0, 1, 2]) AS t(k)"""
)
def image_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of one colour through decoding, scaling, normalising and an encoder that weighs the channels."""
    level = F.lpad(F.hex(F.col("n_nationkey") * 10), 2, "0")
    image = F.concat(F.encode(F.lit("P6 1 1 255\n"), "UTF-8"), F.unhex(F.concat(level, level, level)))
    items = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("data_index"), image.alias("content"))
    made = encode.encode(items, _channel_means, dim=3, normalise=False, batch=7)
    return made.select("data_index", F.posexplode("embedding").alias("pos", "value")).select(
        "data_index", F.col("pos").cast("long").alias("pos"), (F.round(F.col("value").cast("double"), 5) + F.lit(0.0)).alias("value")
    )


def _channel_means() -> Callable[[list], np.ndarray]:
    def run(items: list) -> np.ndarray:
        pixels = np.stack([encode.preprocess(encode.decode_image(item)) for item in items])
        return pixels.mean((2, 3), dtype=np.float64) * np.arange(3)

    return run


@_query(
    """SELECT doc_id AS data_index, round(length(coalesce(text, '')) / sqrt(length(coalesce(text, '')) ** 2 + 1), 5) AS long,
round(1 / sqrt(length(coalesce(text, '')) ** 2 + 1), 5) AS one FROM documents"""
)
def encoded_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoder seam with unit vectors of (length, 1)."""
    items = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("data_index"), F.coalesce("text", F.lit("")).alias("content"))
    made = encode.encode(items, _lengths, dim=2)
    at = lambda k: F.round(F.element_at("embedding", k).cast("double"), 5)
    return made.select("data_index", at(1).alias("long"), at(2).alias("one"))


def _lengths() -> Callable[[list], np.ndarray]:
    return lambda items: np.array([[len(t), 1] for t in items], np.float32)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
