"""Registered queries: clustering and cluster validity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import cluster as K
from tidemill.operators import kmeans as KM
from tidemill.plans.catalog import query
from tidemill.plans.common import EMB_COLS, duck_h, duck_u, emb, emb_sql, r6, rk
from tidemill.session import cut_lineage

ES = EMB_COLS


def _seeds_sql(k: int) -> str:
    return (f"(SELECT row_number() OVER (ORDER BY {duck_h('vec_id')}, vec_id) - 1 AS cluster, {', '.join(ES)} "
            f"FROM {emb_sql()} ORDER BY {duck_h('vec_id')}, vec_id LIMIT {k})")


def _assign_sql(k: int) -> str:
    dist = " + ".join(f"(p.{c} - s.{c}) * (p.{c} - s.{c})" for c in ES)
    return f"""(SELECT * FROM (SELECT p.*, s.cluster, {dist} AS sqd,
  row_number() OVER (PARTITION BY p.vec_id ORDER BY {dist}, s.cluster) AS r
  FROM {emb_sql()} p CROSS JOIN {_seeds_sql(k)} s) WHERE r = 1)"""


def _assigned(spark, sf, k=3):
    d = emb(spark, sf)
    return K.assign(d, ES, K.seed_centroids(d, "vec_id", ES, k))


@query("k1_lloyd_step", sql=f"""
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, {', '.join(f'round(avg({c}), 6) AS {c}' for c in ES)}
FROM {_assign_sql(3)} GROUP BY cluster""")
def k1_lloyd_step(spark, sf):
    d = emb(spark, sf)
    step = K.lloyd_step(d, ES, K.seed_centroids(d, "vec_id", ES, 3))
    return step.select("cluster", "n", *[r6(c).alias(c) for c in ES])


@query("k2_wcss_by_k", sql=" UNION ALL ".join(
    f"SELECT {k} AS k, round(sum(sqd), 6) AS wcss FROM {_assign_sql(k)}" for k in range(2, 11)))
def k2_wcss_by_k(spark, sf):
    return _wcss_curve(spark, sf).select("k", r6("wcss").alias("wcss"))


def _wcss_curve(spark, sf):
    d = emb(spark, sf)
    seeds = K.seed_centroids(d, "vec_id", ES, 10)
    return K.wcss_by_prefix(d, ES, seeds, range(2, 11))


@query("k3_silhouette_exact", sql=f"""
WITH a AS {_assign_sql(3)},
d AS (SELECT x.vec_id, x.cluster AS own, y.cluster AS cl,
        sqrt({' + '.join(f'(x.{c} - y.{c}) * (x.{c} - y.{c})' for c in ES)}) AS dist FROM a x CROSS JOIN a y),
pc AS (SELECT vec_id, own, cl, sum(dist) AS sd, count(*) AS cnt FROM d GROUP BY ALL),
s AS (SELECT vec_id, max(cnt) FILTER (WHERE cl = own) AS n_own, max(sd / (cnt - 1)) FILTER (WHERE cl = own) AS a,
        min(sd / cnt) FILTER (WHERE cl <> own) AS b FROM pc GROUP BY vec_id)
SELECT round(avg(CASE WHEN n_own <= 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""")
def k3_silhouette_exact(spark, sf):
    s = K.silhouette_exact(_assigned(spark, sf), "vec_id", ES, "cluster")
    return s.select(r6("silhouette").alias("silhouette"))


@query("k3_silhouette_squared", sql=f"""
WITH a AS {_assign_sql(3)},
d AS (SELECT x.vec_id, x.cluster AS own, y.cluster AS cl,
        {' + '.join(f'(x.{c} - y.{c}) * (x.{c} - y.{c})' for c in ES)} AS dist FROM a x CROSS JOIN a y),
pc AS (SELECT vec_id, own, cl, sum(dist) AS sd, count(*) AS cnt FROM d GROUP BY ALL),
s AS (SELECT vec_id, max(cnt) FILTER (WHERE cl = own) AS n_own, max(sd / (cnt - 1)) FILTER (WHERE cl = own) AS a,
        min(sd / cnt) FILTER (WHERE cl <> own) AS b FROM pc GROUP BY vec_id)
SELECT round(avg(CASE WHEN n_own <= 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_squared FROM s""")
def k3_silhouette_squared(spark, sf):
    a = _assigned(spark, sf)
    from pyspark.ml.feature import VectorAssembler

    v = VectorAssembler(inputCols=ES, outputCol="features").transform(a)
    return spark.range(1).select(r6(F.lit(K.silhouette_squared(v, "features", "cluster"))).alias("silhouette_squared"))


@query("k4_choose_k", sql=f"""
WITH c AS ({' UNION ALL '.join(f"SELECT {k} AS k, sum(sqd) AS wcss FROM {_assign_sql(k)}" for k in range(2, 11))}),
r AS (SELECT k, lead(wcss, 2) OVER (ORDER BY k) - 2 * lead(wcss, 1) OVER (ORDER BY k) + wcss AS d2,
        row_number() OVER (ORDER BY k) AS i FROM c)
SELECT CAST((SELECT i FROM r WHERE d2 IS NOT NULL ORDER BY d2, i LIMIT 1) + 1 AS INTEGER) AS elbow_reference,
  CAST((SELECT k FROM r WHERE d2 IS NOT NULL ORDER BY d2 DESC, i LIMIT 1) + 1 AS INTEGER) AS elbow""")
def k4_choose_k(spark, sf):
    return K.choose_k(_wcss_curve(spark, sf))


@query("k5_davies_bouldin", sql=f"""
WITH a AS {_assign_sql(3)},
c AS (SELECT cluster, {', '.join(f'avg({c}) AS {c}' for c in ES)} FROM a GROUP BY cluster),
s AS (SELECT a.cluster, avg(sqrt({' + '.join(f'(a.{c} - c.{c}) * (a.{c} - c.{c})' for c in ES)})) AS s
      FROM a JOIN c USING (cluster) GROUP BY a.cluster),
m AS (SELECT i.cluster AS ci, j.cluster AS cj, sqrt({' + '.join(f'(i.{c} - j.{c}) * (i.{c} - j.{c})' for c in ES)}) AS m
      FROM c i, c j WHERE i.cluster <> j.cluster),
r AS (SELECT ci, max((si.s + sj.s) / m) AS worst FROM m JOIN s si ON si.cluster = ci JOIN s sj ON sj.cluster = cj GROUP BY ci)
SELECT round(avg(worst), 6) AS davies_bouldin FROM r""")
def k5_davies_bouldin(spark, sf):
    return K.davies_bouldin(_assigned(spark, sf), ES, "cluster").select(r6("davies_bouldin").alias("davies_bouldin"))


@query("k6_calinski_harabasz", sql=f"""
WITH a AS {_assign_sql(3)},
g AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in ES)}, count(*) AS n FROM a),
c AS (SELECT cluster, count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in ES)} FROM a GROUP BY cluster),
b AS (SELECT sum(c.n * ({' + '.join(f'(c.{c} - g.{c}) * (c.{c} - g.{c})' for c in ES)})) AS between_ss,
        count(*) AS k FROM c, g),
w AS (SELECT sum({' + '.join(f'(a.{c} - c.{c}) * (a.{c} - c.{c})' for c in ES)}) AS within_ss FROM a JOIN c USING (cluster))
SELECT round((between_ss / (k - 1)) / (within_ss / ((SELECT n FROM g) - k)), 6) AS calinski_harabasz FROM b, w""")
def k6_calinski_harabasz(spark, sf):
    return K.calinski_harabasz(_assigned(spark, sf), ES, "cluster").select(
        r6("calinski_harabasz").alias("calinski_harabasz"))


@query("k7_cluster_sizes", sql=f"""
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS size, round(count(*) / (SELECT count(*) FROM embeddings), 6) AS share
FROM {_assign_sql(3)} GROUP BY cluster""")
def k7_cluster_sizes(spark, sf):
    s = K.cluster_sizes(_assigned(spark, sf), "cluster")
    return s.select("cluster", "size", r6("share").alias("share"))


def _fitted(spark, sf, k, **kw):
    d = cut_lineage(emb(spark, sf))  # read once per centre and step
    return d, KM.fit(d, "vec_id", ES, k, **kw)


def _near_sql(k: int) -> str:
    """Squared distance of each row to the nearest of the first k start rows."""
    return "least(" + ", ".join(f"({' + '.join(f'(p.{c} - s{i}.{c}) * (p.{c} - s{i}.{c})' for c in ES)})" for i in range(k)) + ")"


def _draw_sql(k: int) -> str:
    u = duck_u("p.vec_id", 42 + 1000 * k)
    return (f"s{k} AS (SELECT * EXCLUDE (d) FROM (SELECT p.*, {_near_sql(k)} AS d FROM e p, {', '.join(f's{i}' for i in range(k))}) p WHERE d > 0 "
            f"ORDER BY ln(greatest({u}, 1.0 / 8589934592)) / d DESC, vec_id LIMIT 1)")


@query("k1_start_rows", sql=f"""
WITH e AS (SELECT * FROM {emb_sql()}),
s0 AS (SELECT * FROM e ORDER BY {duck_h('vec_id')}, vec_id LIMIT 1), {', '.join(_draw_sql(k) for k in range(1, 4))}
SELECT CAST(0 AS INTEGER) AS place, vec_id FROM s0 UNION ALL SELECT 1, vec_id FROM s1 UNION ALL SELECT 2, vec_id FROM s2 UNION ALL SELECT 3, vec_id FROM s3""")
def k1_start_rows(spark, sf):
    """D-squared sampling: the rows that the first four centres start from."""
    rows = KM._rows(cut_lineage(emb(spark, sf)), "vec_id", ES)
    _, keys = KM.plus_plus(rows, 4, [42])
    return spark.createDataFrame(list(enumerate(keys[0])), "place int, vec_id long")


@query("k1_kmeans_fit")
def k1_kmeans_fit(spark, sf):
    """K1 full fit: best of 10 D-squared starts, Lloyd steps to a fixpoint; centroids as rows."""
    _, fit = _fitted(spark, sf, 3)
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(fit.centroids)]
    return spark.createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in ES))


def _with_features(df):
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=ES, outputCol="features").transform(df)


@query("k8_compare_k")
def k8_compare_k(spark, sf):
    """K8: fit K in (2, 3, 4, 5, 6, 8); inertia and squared-Euclidean silhouette."""
    d, rows = cut_lineage(emb(spark, sf)), []
    for k, fit in KM.fit_many(d, "vec_id", ES, [2, 3, 4, 5, 6, 8]).items():
        sil = K.silhouette_squared(_with_features(KM.predict(d, ES, fit.centroids)), "features", "cluster")
        rows.append((k, fit.inertia, float(sil)))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


@query("k9_init_convergence")
def k9_init_convergence(spark, sf):
    """K9: three seeds x (k-means++, random): mean steps and inertia."""
    d = cut_lineage(emb(spark, sf))
    rows = []
    for start in KM.STARTS:
        fit = KM.fit(d, "vec_id", ES, 3, n_init=3, start=start)
        rows.append((start, sum(fit.steps) / 3.0, sum(fit.inertias) / 3.0))
    return spark.createDataFrame(rows, "init_mode string, mean_iterations double, mean_inertia double")


@query("k10_interpretation")
def k10_interpretation(spark, sf):
    """Final metrics of the chosen K and whether it matches the true class count."""
    d, fit = _fitted(spark, sf, 3)
    pred = cut_lineage(_with_features(KM.predict(d, ES, fit.centroids)))
    true_k = d.agg(F.count_distinct("y3")).first()[0]
    sil = K.silhouette_squared(pred, "features", "cluster")
    db = K.davies_bouldin(pred, ES, "cluster").first()[0]
    ch = K.calinski_harabasz(pred, ES, "cluster").first()[0]
    return spark.createDataFrame([(3, int(true_k), float(sil), float(db), float(ch), 3 == true_k)],
                                 "k int, true_k int, silhouette double, davies_bouldin double, "
                                 "calinski_harabasz double, matches_true_k boolean")


@query("k10_quality_of_fit", sql=f"""
WITH f AS (SELECT 1)
SELECT (SELECT count(*) FROM {emb_sql()}) AS n_rows, CAST(0 AS DOUBLE) AS moved, CAST(0 AS DOUBLE) AS inertia_gap, true AS not_worse_than_starts FROM f""")
def k10_quality_of_fit(spark, sf):
    """The chosen centroids are the means of the rows nearest to them, the reported inertia is the sum of squares to them, and no
    other start ended lower."""
    d, fit = _fitted(spark, sf, 3)
    a = K.assign(d, ES, fit.centroids)
    means = a.groupBy("cluster").agg(F.array(*[F.avg(c) for c in ES]).alias("m"), F.sum("_sqdist").alias("ss"), F.count(F.lit(1)).alias("n"))
    own = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in fit.centroids])[F.col("cluster")]
    far = F.aggregate(F.zip_with("m", own, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda x, y: F.greatest(x, y))
    total = means.agg(F.sum("n").alias("n"), F.max(far).alias("far"), F.sum("ss").alias("ss"))
    return total.select(F.col("n").alias("n_rows"), (rk("far", 6) + F.lit(0.0)).alias("moved"), (rk(F.abs(F.col("ss") - F.lit(fit.inertia)), 6) + F.lit(0.0)).alias("inertia_gap"),
                        F.lit(all(fit.inertia <= i for i in fit.inertias)).alias("not_worse_than_starts"))
