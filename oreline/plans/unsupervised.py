"""Clustering and component queries on the embeddings and a few numeric tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as C
from ..operators import hierarchy as H
from ..operators import neighbors as N
from ..operators import reduce as P
from ..operators import scale as S
from ..sources.tables import table
from .profiles import rounded
from .registry import query
from .supervised import vectors


def start_centres(spark, sf, k=3):
    """The vectors with the smallest ids as fixed start centres."""
    return [r["x"] for r in vectors(spark, sf).where(F.col("row_id") < k).orderBy("row_id").collect()]


@query("uns1_scaled_columns", "SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal, "
       "round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER (), 6) AS c_nationkey FROM customer")
def scaled_columns(spark, sf):
    return rounded(S.standardize(table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), ["c_acctbal", "c_nationkey"]))


_Z = ("WITH z AS (SELECT p_partkey, (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS a, "
      "(p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER () AS b FROM part), r AS (SELECT corr(a, b) AS r FROM z)")
_PC = ("pc AS (SELECT p_partkey, a, b, CASE WHEN r >= 0 THEN (a + b) / sqrt(2) ELSE (a - b) / sqrt(2) END AS p1, "
       "CASE WHEN r >= 0 THEN (a - b) / sqrt(2) ELSE (a + b) / sqrt(2) END AS p2 FROM z, r)")


def _components(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return df, P.principal_components(df, ["p_size", "p_retailprice"], 2)


@query("uns2_pca_coordinates", f'{_Z}, {_PC} SELECT p_partkey, round(p1, 5) AS "PC1", round(p2, 5) AS "PC2" FROM pc')
def pca_coordinates(spark, sf):
    df, pcs = _components(spark, sf)
    return rounded(pcs.coordinates(df, ["p_partkey"]), 5)


@query("uns2_pca_variance", f"{_Z} SELECT 'PC1' AS component, round((1 + abs(r)) * 50, 5) AS share FROM r UNION ALL SELECT 'PC2', round((1 - abs(r)) * 50, 5) FROM r")
def pca_variance(spark, sf):
    _, pcs = _components(spark, sf)
    return rounded(pcs.variance(spark), 5)


_CORR = (" SELECT 'p_size' AS variable, 'PC1' AS component, round(corr(a, p1), 5) AS corr FROM pc UNION ALL SELECT 'p_size', 'PC2', round(corr(a, p2), 5) FROM pc "
         "UNION ALL SELECT 'p_retailprice', 'PC1', round(corr(b, p1), 5) FROM pc UNION ALL SELECT 'p_retailprice', 'PC2', round(corr(b, p2), 5) FROM pc")


@query("agg23_component_correlations", f"{_Z}, {_PC}{_CORR}")
def component_correlations(spark, sf):
    df, pcs = _components(spark, sf)
    return rounded(pcs.correlations(df), 5)


@query("plt12_correlation_circle", f"{_Z}, {_PC}, c AS ({_CORR}) SELECT variable, max(corr) FILTER (component = 'PC1') AS x, max(corr) FILTER (component = 'PC2') AS y FROM c GROUP BY variable")
def correlation_circle(spark, sf):
    df, pcs = _components(spark, sf)
    return rounded(pcs.correlations(df), 5).groupBy("variable").pivot("component", ["PC1", "PC2"]).agg(F.max("corr")).toDF("variable", "x", "y")


@query("plt12_principal_plane", f'{_Z}, {_PC} SELECT p_partkey, round(p1, 5) AS x, round(p2, 5) AS y FROM pc')
def principal_plane(spark, sf):
    df, pcs = _components(spark, sf)
    return rounded(pcs.coordinates(df, ["p_partkey"]), 5).toDF("p_partkey", "x", "y")


@query("uns2_pca_embeddings")
def pca_embeddings(spark, sf):
    rows = vectors(spark, sf)
    return rounded(P.array_components(rows, "x").coordinates(rows, "x", ["row_id"]), 5)


def _dist(a, b):
    return f"list_reduce(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) ** 2), lambda s, v: s + v)"


_E = "e AS (SELECT vec_id AS row_id, [x :: DOUBLE for x in embedding] AS x FROM embeddings), c0 AS (SELECT row_id AS c, x FROM e WHERE row_id < 3)"


def _lloyd(i):
    return (f"a{i} AS (SELECT e.row_id, e.x, min_by(c, d) AS c, min(d) AS d FROM (SELECT e.row_id, e.x, c{i}.c, {_dist('e.x', f'c{i}.x')} AS d FROM e, c{i}) e GROUP BY 1, 2), "
            f"u{i} AS (SELECT c, i, avg(v) AS v FROM (SELECT c, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{i}) GROUP BY 1, 2), "
            f"c{i + 1} AS (SELECT c, list(v ORDER BY i) AS x FROM u{i} GROUP BY c)")


_NEAR = f"WITH {_E}, {_lloyd(0)}"


@query("jn5_nearest_centre", f"{_NEAR} SELECT row_id, CAST(c AS INTEGER) AS cluster, round(sqrt(d), 6) AS distance FROM a0")
def nearest_centre(spark, sf):
    return rounded(N.nearest_centre(vectors(spark, sf), "x", start_centres(spark, sf)).select("row_id", "cluster", "distance"))


def _assigned(spark, sf):
    return N.nearest_centre(vectors(spark, sf), "x", start_centres(spark, sf))


@query("agg18_cluster_sizes", f"{_NEAR} SELECT CAST(c AS INTEGER) AS cluster, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM a0 GROUP BY c")
def cluster_sizes(spark, sf):
    return rounded(C.distribution(_assigned(spark, sf)))


@query("agg19_centroids", f"{_NEAR} SELECT CAST(c AS INTEGER) AS cluster, round(avg(x[1]), 6) AS f0, round(avg(x[2]), 6) AS f1 FROM a0 GROUP BY c")
def centroids(spark, sf):
    a = _assigned(spark, sf).select("cluster", F.col("x")[0].alias("f0"), F.col("x")[1].alias("f1"))
    return rounded(C.centroids(a, ["f0", "f1"]))


@query("plt7_centroid_bars", f"{_NEAR}, m AS (SELECT c, avg(x[1]) AS f0, avg(x[2]) AS f1 FROM a0 GROUP BY c) "
       "SELECT CAST(c AS INTEGER) AS cluster, round(f0 / max(abs(f0)) OVER (), 5) AS f0, round(f1 / max(abs(f1)) OVER (), 5) AS f1 FROM m")
def centroid_bars(spark, sf):
    a = _assigned(spark, sf).select("cluster", F.col("x")[0].alias("f0"), F.col("x")[1].alias("f1"))
    return rounded(S.max_abs(C.centroids(a, ["f0", "f1"]), ["f0", "f1"]), 5)


@query("uns3_kmeans_fixed_start", f"{_NEAR}, {_lloyd(1)}, {_lloyd(2)} SELECT row_id, CAST(c AS INTEGER) AS cluster, round(sqrt(d), 6) AS distance FROM a2")
def kmeans_fixed_start(spark, sf):
    rows, _ = C.kmeans_from(vectors(spark, sf), start_centres(spark, sf), 2)
    return rounded(rows.select("row_id", "cluster", "distance"))


@query("uns3_kmeans")
def kmeans(spark, sf):
    rows, _, _ = C.kmeans(C.standardized(vectors(spark, sf)), 3)
    return rounded(rows.select("row_id", "cluster", "distance"))


@query("uns4_kmedoids")
def kmedoids(spark, sf):
    rows, _, _ = C.kmedoids(C.standardized(vectors(spark, sf)), 3)
    return rounded(rows.select("row_id", "cluster", "distance"))

def _l1(x, y):
    return f"list_sum(list_transform(list_zip({x}, {y}), lambda t: abs(t[1] - t[2])))"


_MEDOIDS = (f"WITH {_E}, m0 AS (SELECT e.row_id, any_value(e.x) AS x, min_by(c0.c, {_l1('e.x', 'c0.x')}) AS c FROM e, c0 GROUP BY 1), "
            "u AS (SELECT c, i, quantile_disc(v, 0.5) AS v FROM (SELECT c, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM m0) GROUP BY 1, 2), "
            "w AS (SELECT c, list(v ORDER BY i) AS x FROM u GROUP BY c), "
            f"n1 AS (SELECT m0.c, arg_min(m0.x, {_l1('m0.x', 'w.x')}) AS x FROM m0 JOIN w ON m0.c = w.c GROUP BY 1) "
            f"SELECT e.row_id, CAST(min_by(n1.c, {_l1('e.x', 'n1.x')}) AS INTEGER) AS cluster, round(min({_l1('e.x', 'n1.x')}), 6) AS distance FROM e, n1 GROUP BY 1")


@query("uns4_kmedoids_fixed_start", _MEDOIDS)
def kmedoids_fixed_start(spark, sf):
    """One round from the vectors with the smallest ids."""
    rows, _, _ = C.kmedoids_from(vectors(spark, sf), start_centres(spark, sf), 1)
    return rounded(rows.select("row_id", "cluster", "distance"))


@query("uns5_hierarchical")
def hierarchical(spark, sf):
    rows, _ = H.hierarchical(C.standardized(vectors(spark, sf)), 3, "ward")
    return rows.select("row_id", "cluster")


_LINKED = ("WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id AS row_id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings), "
           "l AS MATERIALIZED (SELECT a.row_id AS p, b.row_id AS q FROM e a JOIN e b ON list_distance(a.x, b.x) <= 1.0), "
           "r AS (SELECT p, q FROM l UNION SELECT r.p, l.q FROM r JOIN l ON r.q = l.p) SELECT p AS row_id, min(q) AS first FROM r GROUP BY p")


@query("uns5_single_linkage_cut", _LINKED)
def single_linkage_cut(spark, sf):
    """Clusters of single linkage at height 1: chains of steps of at most that length."""
    return H.clusters_below(vectors(spark, sf), 1.0)


@query("plt11_dendrogram")
def dendrogram(spark, sf):
    _, merges = H.hierarchical(vectors(spark, sf), 3, "average")
    return rounded(merges)


@query("uns6_cluster_table", f"{_NEAR}, {_lloyd(1)} SELECT CAST(c AS INTEGER) AS cluster, count(*) AS n, round(avg(x[1]), 6) AS f0 FROM a1 GROUP BY c")
def cluster_table(spark, sf):
    rows, _ = C.kmeans_from(vectors(spark, sf), start_centres(spark, sf), 1)
    return rounded(rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("x")[0]).alias("f0")))


@query("uns7_projected_clusters")
def projected_clusters(spark, sf):
    """Rows and centres in the plane of the first two components."""
    rows, centres = C.kmeans_from(vectors(spark, sf), start_centres(spark, sf), 2)
    pcs = P.array_components(rows, "x")
    middle = spark.createDataFrame([(None, i, [float(v) for v in c]) for i, c in enumerate(centres)], "row_id bigint, cluster int, x array<double>")
    both = rows.select("row_id", "cluster", "x").unionByName(middle)
    return rounded(pcs.coordinates(both, "x", ["row_id", "cluster"]), 5)
