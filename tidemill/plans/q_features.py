"""Registered queries: feature transformers and selection."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tidemill.operators import decompose as D
from tidemill.operators import encode as E
from tidemill.operators.sampling import stratified_split
from tidemill.operators.neighbour_mi import neighbour_mutual_information
from tidemill.operators.select import mutual_information, select_by_correlation
from tidemill.plans.catalog import query
from tidemill.plans.common import EMB_COLS, CUSTOMER_NULLS_SQL, customer_with_nulls, duck_h, emb, emb_sql, r6
from tidemill.sources.tables import read_table

ES = EMB_COLS

_SPLIT_SQL = f"""(SELECT *, CASE WHEN row_number() OVER (PARTITION BY y3 ORDER BY {duck_h('vec_id')}, vec_id)
    <= round(count(*) OVER (PARTITION BY y3) * 0.2) THEN 'test' ELSE 'train' END AS split FROM {emb_sql()})"""


def _split(spark, sf):
    return stratified_split(emb(spark, sf), "vec_id", "y3", 0.2)


@query("t1_standardize", sql=f"""
WITH t AS {_SPLIT_SQL}, s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in ES)}
                             FROM t WHERE split = 'train')
SELECT vec_id, split, {', '.join(f'round(CASE WHEN s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}'
                                 for c in ES)} FROM t, s""")
def t1_standardize(spark, sf):
    d = _split(spark, sf).select("vec_id", "split", *ES)
    stats = E.fit_standardizer(d.where(F.col("split") == "train"), ES)
    z = E.apply_standardizer(d, stats)
    return z.select("vec_id", "split", *[r6(c).alias(c) for c in ES])


@query("t2_label_encode", sql="""
SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_code FROM part""")
def t2_label_encode(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_brand")
    return E.label_encode(p, "p_brand")


@query("t3_first_seen_codes", sql=f"""
WITH t AS {CUSTOMER_NULLS_SQL},
f AS (SELECT c_mktsegment, row_number() OVER (ORDER BY min(c_custkey), c_mktsegment) - 1 AS code
      FROM t WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment)
SELECT c_custkey, t.c_mktsegment, CAST(coalesce(code, -1) AS INTEGER) AS c_mktsegment_code
FROM t LEFT JOIN f USING (c_mktsegment)""")
def t3_first_seen_codes(spark, sf):
    c = customer_with_nulls(spark, sf).select("c_custkey", "c_mktsegment")
    return E.first_seen_codes(c, "c_mktsegment", "c_custkey")


@query("t4_pca_two_components")
def t4_pca_two_components(spark, sf):
    d = emb(spark, sf)
    fit = D.fit_pca(d, ES, 2)
    p = fit.transform(d, 2)
    return p.select("vec_id", r6(F.col("pca")[0]).alias("pc1"), r6(F.col("pca")[1]).alias("pc2"))


@query("t5_pca_variance_share")
def t5_pca_variance_share(spark, sf):
    d = emb(spark, sf)
    fit = D.fit_pca(d, ES)
    k = D.components_for_share(fit, 0.92)
    return D.explained_variance_rows(spark, fit, k)


@query("t5_pca_reduced_rows")
def t5_pca_reduced_rows(spark, sf):
    d = emb(spark, sf)
    fit = D.fit_pca(d, ES)
    k = D.components_for_share(fit, 0.95)
    return fit.transform(d, k).select("vec_id", "pca")


@query("t6_pc1_importance")
def t6_pc1_importance(spark, sf):
    d = emb(spark, sf)
    fit = D.fit_pca(d, ES)
    rows = D.first_component_importance(fit, 10)
    return spark.createDataFrame(rows, "feature string, abs_loading double")


def _mi_sql(cols, label, bins=10):
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    l_sql = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, {label} AS y FROM t" for c in cols)
    return f"""
WITH t AS {emb_sql()}, l AS ({l_sql}),
q AS (SELECT feature, quantile_cont(v, [{probs}]) AS cuts FROM l GROUP BY feature),
j AS (SELECT feature, len(list_filter(cuts, lambda c: c < v)) AS bin, y, count(*) AS n_by FROM l JOIN q USING (feature)
      GROUP BY ALL),
p AS (SELECT *, sum(n_by) OVER (PARTITION BY feature) AS n, sum(n_by) OVER (PARTITION BY feature, bin) AS nb,
        sum(n_by) OVER (PARTITION BY feature, y) AS ny FROM j)
SELECT feature, round(sum(n_by / n * ln(n_by * n / (nb * ny))), 6) AS mutual_info FROM p GROUP BY feature"""


@query("t7_mutual_info", sql=_mi_sql(ES, "y3"))
def t7_mutual_info(spark, sf):
    mi = mutual_information(emb(spark, sf), ES, "y3", 10)
    return mi.select("feature", r6("mutual_info").alias("mutual_info"))


@query("t7_neighbour_mi", sql=f"""
WITH l AS (SELECT vec_id AS i, y3 AS y, unnest(range(1, 65)) AS j, unnest([{', '.join(ES)}]) AS v FROM {emb_sql()}),
o AS (SELECT *, count(*) OVER (PARTITION BY j, y) AS n_class, [v - lag(v, 1) OVER w, v - lag(v, 2) OVER w, v - lag(v, 3) OVER w,
  lead(v, 1) OVER w - v, lead(v, 2) OVER w - v, lead(v, 3) OVER w - v] AS near FROM l WINDOW w AS (PARTITION BY j, y ORDER BY v, i)),
d AS (SELECT j, i, v, n_class, least(3, n_class - 1) AS kk, list_sort(list_filter(near, lambda x: x IS NOT NULL))[least(3, n_class - 1)] AS d FROM o WHERE n_class > 1),
m AS (SELECT a.j, a.i, any_value(a.n_class) AS n_class, any_value(a.kk) AS kk, count(*) AS m FROM d a JOIN d b ON a.j = b.j
  AND (b.v = a.v OR a.d > 0 AND b.v > a.v - a.d AND b.v < a.v + a.d) GROUP BY a.j, a.i),
h AS (SELECT n, coalesce(sum(CASE WHEN n > 1 THEN 1.0 / (n - 1) END) OVER (ORDER BY n), 0) AS psi FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM embeddings))) AS n))
SELECT 'e' || j AS feature, round(greatest(any_value(hn.psi) + avg(hk.psi) - avg(hc.psi) - avg(hm.psi), 0), 6) AS mutual_info
FROM (SELECT *, count(*) OVER (PARTITION BY j) AS n FROM m) m JOIN h hn ON hn.n = m.n JOIN h hk ON hk.n = m.kk JOIN h hc ON hc.n = m.n_class JOIN h hm ON hm.n = m.m
GROUP BY j""")
def t7_neighbour_mi(spark, sf):
    """Neighbour estimator, three neighbours, every value of every feature."""
    mi = neighbour_mutual_information(emb(spark, sf), ES, "y3", "vec_id")
    return mi.select("feature", r6("mutual_info").alias("mutual_info"))


_T8_TARGET = "3 * e1 - 2 * e2 + e3 * e3"


@query("t8_corr_selection", sql=f"""
WITH t AS (SELECT *, {_T8_TARGET} AS target FROM {emb_sql()}),
c AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, corr({c}, target) AS corr FROM t" for c in ES)}),
k AS (SELECT count(*) AS n FROM c WHERE abs(corr) > 0.1)
SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM c
WHERE (SELECT n FROM k) >= 3 AND abs(corr) > 0.1
UNION ALL
SELECT feature, round(corr, 6), round(abs(corr), 6) FROM (SELECT * FROM c ORDER BY abs(corr) DESC, feature LIMIT 10)
WHERE (SELECT n FROM k) < 3""")
def t8_corr_selection(spark, sf):
    d = emb(spark, sf)
    d = d.withColumn("target", 3 * F.col("e1") - 2 * F.col("e2") + F.col("e3") * F.col("e3"))
    s = select_by_correlation(d, ES, "target")
    return s.select("feature", r6("corr").alias("corr"), r6("abs_corr").alias("abs_corr"))


@query("t9_scale_reduce_fit")
def t9_scale_reduce_fit(spark, sf):
    """Scale -> PCA -> logistic regression as one MLlib Pipeline, fitted on the
    train split, applied to the test split."""
    d = _split(spark, sf).withColumn("label", F.col("y3").cast("double"))
    n = d.where(F.col("split") == "train").count()
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=ES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        PCA(k=6, inputCol="scaled", outputCol="features"),
        LogisticRegression(regParam=1.0 / n, standardization=False, maxIter=200),
    ])
    model = pipe.fit(d.where(F.col("split") == "train"))
    return model.transform(d.where(F.col("split") == "test")).select("vec_id", "label", "prediction")
