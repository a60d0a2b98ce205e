"""Evaluation, model, clustering and report queries."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.models import batch, candidates, gaussian, histogram, linear
from millrace.operators import cluster, density, features, folds, metrics, nearest, vectorize
from millrace.plans import reports, selection
from millrace.sources.tables import keep_for_reuse
from millrace.workload.base import query

# --- predictions by formula: model -> (prediction, integer score) over lineitem ------------------------------
_FORMULAS = {
    "01_DummyClassifier": ("0", "0"),
    "02_Quantity": ("CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END", "cast(l_quantity as bigint)"),
    "03_Supplier": ("CASE WHEN l_suppkey % 37 >= 30 THEN 1 ELSE 0 END", "l_suppkey % 37"),
    "04_Line": ("CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END", "cast(l_linenumber as bigint)"),
}
_LABEL = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"
_SCORED_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS modelo, {_LABEL} AS label, {p} AS prediction, {s} AS score FROM lineitem" for m, (p, s) in _FORMULAS.items()
)


def _scored(t):
    rows = t.raw("lineitem")
    each = [f"named_struct('modelo', '{m}', 'prediction', {p}, 'score', cast({s} as bigint))" for m, (p, s) in _FORMULAS.items()]
    return rows.selectExpr(f"{_LABEL} AS label", f"inline(array({', '.join(each)}))")


_COUNT_SQL = (
    "SELECT modelo, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp, "
    'count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp '
    f"FROM ({_SCORED_SQL}) GROUP BY modelo"
)
_RATE_SQL = (
    "SELECT *, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, "
    f"round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM ({_COUNT_SQL})"
)


@query("confusion", "Q5", _COUNT_SQL)
def confusion(t):
    return metrics.confusion(_scored(t), "label", "prediction", ["modelo"])


def _rates(t):
    out = metrics.with_rates(confusion(t))
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query("clf_metrics", "Q6", _RATE_SQL)
def clf_metrics(t):
    return _rates(t)


_AREA_SQL = (
    "SELECT modelo, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM (SELECT modelo, score, pos, neg, "
    "sum(neg) OVER (PARTITION BY modelo ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM (SELECT modelo, score, "
    f"count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM ({_SCORED_SQL}) GROUP BY modelo, score)) GROUP BY modelo"
)


@query("roc_auc", "Q7", _AREA_SQL)
def roc_auc(t):
    return metrics.roc_auc(_scored(t), "label", "score", ["modelo"]).withColumn("roc_auc", F.round("roc_auc", 6))


@query(
    "roc_points",
    "Q8",
    "SELECT modelo, cast(score as double) AS threshold, round(sum(neg) OVER w / sum(neg) OVER g, 6) AS fpr, round(sum(pos) OVER w / sum(pos) OVER g, 6) AS tpr FROM ("
    f"SELECT modelo, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM ({_SCORED_SQL}) GROUP BY modelo, score) "
    "WINDOW w AS (PARTITION BY modelo ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), g AS (PARTITION BY modelo) "
    f"UNION ALL SELECT DISTINCT modelo, cast('Infinity' AS DOUBLE), cast(0 AS DOUBLE), cast(0 AS DOUBLE) FROM ({_SCORED_SQL})",
)
def roc_points(t):
    out = metrics.roc_points(_scored(t), "label", "score", ["modelo"])
    return out.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


@query(
    "class_report",
    "Q9",
    f"WITH s AS (SELECT label, prediction FROM ({_SCORED_SQL}) WHERE modelo = '02_Quantity'), c AS (SELECT k, count(*) FILTER (label = k) AS support, "
    "count(*) FILTER (prediction = k) AS called, count(*) FILTER (label = k AND prediction = k) AS hit FROM s, (VALUES (0), (1)) v(k) GROUP BY k), "
    "p AS (SELECT k, hit / called AS p, hit / support AS r, 2 * hit / (called + support) AS f, support FROM c) "
    "SELECT cast(k as string) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM p "
    "UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) as bigint) FROM p "
    "UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint) FROM p",
)
def class_report(t):
    rows = _scored(t).where(F.col("modelo") == "02_Quantity")
    out = metrics.class_report(rows, "label", "prediction")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_ERRORS = {"01_DummyRegressor": "52.5", "02_Linear": "l_quantity * 2.05", "03_Rate": "l_quantity + 28 * l_discount"}
_ERRORS_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS modelo, l_extendedprice / 1000 AS label, cast({p} as double) AS prediction FROM lineitem" for m, p in _ERRORS.items()
)


def _estimated(t):
    each = [f"named_struct('modelo', '{m}', 'prediction', cast({p} as double))" for m, p in _ERRORS.items()]
    return t.raw("lineitem").selectExpr("l_extendedprice / 1000 AS label", f"inline(array({', '.join(each)}))")


_ERROR_SQL = (
    "SELECT modelo, round(avg(abs(label - prediction)), 6) AS mae, round(avg((label - prediction) ** 2), 6) AS mse, "
    "round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse, round(1 - avg((label - prediction) ** 2) / var_pop(label), 6) AS r2 "
    f"FROM ({_ERRORS_SQL}) GROUP BY modelo"
)


@query("reg_metrics", "Q10", _ERROR_SQL)
def reg_metrics(t):
    out = metrics.regression_errors(_estimated(t), "label", "prediction", ["modelo"])
    return out.withColumns({c: F.round(c, 6) for c in ("mae", "mse", "rmse", "r2")})


@query(
    "residual_histogram",
    "Q11",
    "SELECT floor((label - prediction) / 10.0) * 10.0 AS bin_start, count(*) AS n FROM "
    f"({_ERRORS_SQL}) WHERE modelo = '03_Rate' GROUP BY 1",
)
def residual_histogram(t):
    rows = metrics.residuals(_estimated(t).where(F.col("modelo") == "03_Rate"), "label", "prediction")
    return metrics.histogram(rows, "residual", 10.0)


_RANKING_SQL = f"SELECT row_number() OVER (ORDER BY f1 DESC, modelo) AS posicion, modelo, f1, recall FROM ({_RATE_SQL})"


def _ranking(t):
    return metrics.ranked(_rates(t).select("modelo", "f1", "recall"), "f1")


@query("model_ranking", "Q12", f"SELECT cast(posicion as integer) AS posicion, modelo, f1, recall FROM ({_RANKING_SQL})")
def model_ranking(t):
    return _ranking(t)


@query(
    "error_ranking",
    "Q12",
    f"SELECT cast(row_number() OVER (ORDER BY mae, modelo) as integer) AS posicion, modelo, mae, mse, rmse, r2 FROM ({_ERROR_SQL})",
)
def error_ranking(t):
    return metrics.ranked(reg_metrics(t), "mae", smaller_is_better=True)


@query(
    "finalists",
    "Q13",
    f"SELECT modelo FROM ({_RANKING_SQL}) WHERE modelo NOT LIKE '%Dummy%' ORDER BY posicion LIMIT 3",
)
def finalists(t):
    ranking = _ranking(t).withColumn("error", F.lit(None).cast("string"))
    names = selection.pick_finalists(ranking, list(_FORMULAS), "f1", False)
    return t.spark.createDataFrame([(n,) for n in names], "modelo string")


@query(
    "baseline_against_best",
    "N4 N6",
    f"WITH r AS ({_RANKING_SQL}) SELECT 'late' AS problema, concat('Baseline: ', regexp_replace(modelo, '^[^_]*_', '')) AS modelo, 'f1' AS metrica, f1 AS valor FROM r WHERE modelo LIKE '%Dummy%' "
    "UNION ALL SELECT 'late', concat('Mejor candidato: ', regexp_replace(modelo, '^[^_]*_', '')), 'f1', f1 FROM r WHERE posicion = 1",
)
def baseline_against_best(t):
    return reports.baseline_against_best(_ranking(t), "f1", "late")


_STACK_SQL = (
    f"SELECT 'clasificacion' AS tipo_problema, regexp_replace(modelo, '^[^_]*_', '') AS modelo, f1 AS best_score_cv, 'rates' AS metodo FROM ({_RATE_SQL}) "
    f"UNION ALL SELECT 'regresion', regexp_replace(modelo, '^[^_]*_', ''), -mae, 'errors' FROM ({_ERROR_SQL})"
)


@query(
    "stacked_scores",
    "N2 N3 N6",
    "SELECT *, CASE tipo_problema WHEN 'regresion' THEN -best_score_cv ELSE best_score_cv END AS score_interpretable, "
    f"CASE tipo_problema WHEN 'regresion' THEN 'MAE CV (menor es mejor)' ELSE 'F1 CV (mayor es mejor)' END AS metrica FROM ({_STACK_SQL})",
)
def stacked_scores(t):
    a = _rates(t).select(F.lit("clasificacion").alias("tipo_problema"), "modelo", F.col("f1").alias("best_score_cv"))
    b = reg_metrics(t).select(F.lit("regresion").alias("tipo_problema"), "modelo", (-F.col("mae")).alias("best_score_cv"))
    stacked = reports.tag_and_stack({"rates": a, "errors": b}, "metodo", ["tipo_problema", "modelo", "best_score_cv"])
    return reports.clean_names(reports.readable_scores(stacked))


@query(
    "kpi_table",
    "N5",
    f"SELECT 'F1' AS kpi, f1 AS valor FROM ({_RATE_SQL}) WHERE modelo = '02_Quantity' UNION ALL "
    f"SELECT 'Recall', recall FROM ({_RATE_SQL}) WHERE modelo = '02_Quantity' UNION ALL SELECT 'MAE', mae FROM ({_ERROR_SQL}) WHERE modelo = '02_Linear'",
)
def kpi_table(t):
    a = _rates(t).where("modelo = '02_Quantity'").select(F.lit("clasificacion").alias("tipo_problema"), "f1", "recall")
    b = reg_metrics(t).where("modelo = '02_Linear'").select(F.lit("regresion").alias("tipo_problema"), "mae")
    final = a.unionByName(b, allowMissingColumns=True)
    wanted = {"F1": ("clasificacion", "f1"), "Recall": ("clasificacion", "recall"), "MAE": ("regresion", "mae")}
    return reports.kpi_table(final, wanted)


# --- feature vectors -------------------------------------------------------------------------------------------


@query(
    "standardise",
    "G1",
    "WITH t AS (SELECT shipment_id, line_no, coalesce(weight, (SELECT quantile_cont(weight, 0.5) FROM {shipments})) AS w, "
    "coalesce(volume, (SELECT quantile_cont(volume, 0.5) FROM {shipments})) AS v FROM {shipments}) "
    "SELECT shipment_id, line_no, round((w - avg(w) OVER ()) / stddev_pop(w) OVER (), 6) AS weight_z, round((v - avg(v) OVER ()) / stddev_pop(v) OVER (), 6) AS volume_z FROM t",
)
def standardise(t):
    rows = t.shipments.select("shipment_id", "line_no", "weight", "volume")
    out = vectorize.fit_vectorizer(rows, ["weight", "volume"]).transform(rows)
    z = vector_to_array("features")
    return out.select("shipment_id", "line_no", F.round(z[0], 6).alias("weight_z"), F.round(z[1], 6).alias("volume_z"))


@query(
    "onehot_vector",
    "G2 G3 G4",
    "WITH f AS (SELECT coalesce(road, (SELECT road FROM {routes} WHERE road IS NOT NULL GROUP BY road ORDER BY count(*) DESC, road LIMIT 1)) AS road FROM {routes}), "
    "l AS (SELECT road, row_number() OVER (ORDER BY road) AS slot FROM (SELECT DISTINCT road FROM f)) "
    "SELECT cast(slot - 1 as integer) AS slot, cast(count(*) as double) AS ones FROM f JOIN l USING (road) GROUP BY slot",
)
def onehot_vector(t):
    rows = t.routes.select("road")
    out = vectorize.fit_vectorizer(rows, ["not_there"], ["road"]).transform(rows)
    slots = out.select(F.posexplode(vector_to_array("features")).alias("slot", "v"))
    return slots.groupBy("slot").agg(F.sum("v").alias("ones"))


# --- models that SQL can restate -----------------------------------------------------------------------------------

_NB_COLUMNS = ["l_quantity", "l_discount", "l_extendedprice"]


def _returns(t):
    return t.raw("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_LABEL} AS late", "l_quantity", "l_discount", "l_extendedprice"
    )


_RETURNS_SQL = f"SELECT l_orderkey, l_linenumber, {_LABEL} AS late, l_quantity, l_discount, l_extendedprice FROM lineitem"


@query(
    "gaussian_nb_stats",
    "K10",
    " UNION ALL ".join(
        f"SELECT late, '{c}' AS feature, count(*) AS n, round(avg({c}), 4) AS mean, round(var_pop({c}), 4) AS variance FROM ({_RETURNS_SQL}) GROUP BY late"
        for c in _NB_COLUMNS
    ),
)
def gaussian_nb_stats(t):
    out = gaussian.class_statistics(_returns(t), "late", _NB_COLUMNS)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "variance")})


_NB_CTE = (
    f"WITH t AS ({_RETURNS_SQL}), a AS (SELECT 1e-9 * greatest("
    + ", ".join(f"var_pop({c})" for c in _NB_COLUMNS)
    + ") AS e, count(*) AS n FROM t), s AS (SELECT late AS k, count(*) AS n, "
    + ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in _NB_COLUMNS)
    + " FROM t GROUP BY late), l AS (SELECT l_orderkey, l_linenumber, late, l_quantity, l_discount, l_extendedprice, k, ln(s.n / a.n)"
    + "".join(f" - 0.5 * ln(2 * pi() * (v_{c} + e)) - ({c} - m_{c}) ** 2 / (2 * (v_{c} + e))" for c in _NB_COLUMNS)
    + " AS g FROM t, s, a) "
)


@query(
    "gaussian_nb_score",
    "K10",
    _NB_CTE + "SELECT p.l_orderkey, p.l_linenumber, p.late, CASE WHEN p.g > z.g THEN 1 ELSE 0 END AS prediction, round(1 / (1 + exp(z.g - p.g)), 6) AS score "
    "FROM l p JOIN l z ON p.k = 1 AND z.k = 0 AND p.l_orderkey = z.l_orderkey AND p.l_linenumber = z.l_linenumber AND p.l_extendedprice = z.l_extendedprice "
    "AND p.l_quantity = z.l_quantity AND p.l_discount = z.l_discount AND p.late = z.late",
)
def gaussian_nb_score(t):
    out = gaussian.score_naive_bayes(_returns(t), "late", _NB_COLUMNS)
    return out.select("l_orderkey", "l_linenumber", "late", "prediction", F.round("score", 6).alias("score"))


def _pair(t):
    """Two-feature vectors over lineitem."""
    rows = t.raw("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"cast({_LABEL} as double) AS label", "l_quantity AS a", "l_tax * 100 + l_discount * 10 AS b",
        "l_extendedprice / 1000 AS y",
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


_PAIR_SQL = f"SELECT l_orderkey, l_linenumber, cast({_LABEL} as double) AS label, l_quantity AS a, l_tax * 100 + l_discount * 10 AS b, l_extendedprice / 1000 AS y FROM lineitem"


@query(
    "ridge_2d",
    "R3",
    f"WITH t AS ({_PAIR_SQL}), m AS (SELECT count(*) * var_pop(a) + 50.0 AS aa, count(*) * var_pop(b) + 50.0 AS bb, count(*) * covar_pop(a, b) AS ab, "
    "count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS bv, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM t), "
    "w AS (SELECT (ay * bb - bv * ab) / (aa * bb - ab * ab) AS wa, (bv * aa - ay * ab) / (aa * bb - ab * ab) AS wb, ma, mb, my FROM m) "
    "SELECT round(wa, 6) AS wa, round(wb, 6) AS wb, round(my - wa * ma - wb * mb, 6) AS intercept FROM w",
)
def ridge_2d(t):
    fit = linear.solve_ridge(_pair(t), 50.0, "y")
    row = (float(fit.weights[0]), float(fit.weights[1]), float(fit.intercept))
    out = t.spark.createDataFrame([row], "wa double, wb double, intercept double")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def _coefficients(spark, model):
    row = tuple(float(v) for v in model.coefficients) + (float(model.intercept),)
    names = [f"w{i}" for i in range(len(row) - 1)] + ["intercept"]
    df = spark.createDataFrame([row], ", ".join(f"{n} double" for n in names))
    return df.select(*[F.round(n, 4).alias(n) for n in names])


@query(
    "ridge_spark_2d",
    "R3",
    f"WITH t AS ({_PAIR_SQL}), m AS (SELECT count(*) * var_pop(a) + 50.0 AS aa, count(*) * var_pop(b) + 50.0 AS bb, count(*) * covar_pop(a, b) AS ab, "
    "count(*) * covar_pop(a, y) AS ay, count(*) * covar_pop(b, y) AS bv, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM t), "
    "w AS (SELECT (ay * bb - bv * ab) / (aa * bb - ab * ab) AS wa, (bv * aa - ay * ab) / (aa * bb - ab * ab) AS wb, ma, mb, my FROM m) "
    "SELECT round(wa, 4) AS w0, round(wb, 4) AS w1, round(my - wa * ma - wb * mb, 4) AS intercept FROM w",
)
def ridge_spark_2d(t):
    return _coefficients(t.spark, linear.fit_ridge(_pair(t), 50.0, "y"))


def _single(t):
    rows = t.raw("lineitem").selectExpr("l_quantity AS a", "l_extendedprice / 1000 AS y")
    return VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)


_SINGLE_SQL = "SELECT covar_pop(l_quantity, l_extendedprice / 1000) AS c, var_pop(l_quantity) AS v, avg(l_quantity) AS ma, avg(l_extendedprice / 1000) AS my FROM lineitem"


@query(
    "least_squares",
    "R2",
    "SELECT round(regr_slope(l_extendedprice / 1000, l_quantity), 4) AS w0, round(regr_intercept(l_extendedprice / 1000, l_quantity), 4) AS intercept FROM lineitem",
)
def least_squares(t):
    return _coefficients(t.spark, linear.ordinary("y").fit(_single(t)))


@query(
    "lasso_1d",
    "R4",
    f"SELECT round(w, 4) AS w0, round(my - w * ma, 4) AS intercept FROM (SELECT sign(c) * greatest(abs(c) - 0.05, 0) / v AS w, ma, my FROM ({_SINGLE_SQL}))",
)
def lasso_1d(t):
    return _coefficients(t.spark, linear.fit_lasso(_single(t), 0.05, "y"))


@query(
    "elastic_net_1d",
    "R5",
    f"SELECT round(w, 4) AS w0, round(my - w * ma, 4) AS intercept FROM (SELECT sign(c) * greatest(abs(c) - 0.05 * 0.5, 0) / (v + 0.05 * 0.5) AS w, ma, my FROM ({_SINGLE_SQL}))",
)
def elastic_net_1d(t):
    return _coefficients(t.spark, linear.fit_elastic_net(_single(t), 0.05, 0.5, "y"))


_CLASS_CTE = (
    f"WITH t AS ({_PAIR_SQL}), c AS (SELECT label AS k, count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab, "
    "var_samp(a) AS sa, var_samp(b) AS sb, covar_samp(a, b) AS sab FROM t GROUP BY label), n AS (SELECT cast(sum(n) as double) AS n FROM c), "
    "p AS (SELECT sum(c.n * va) / max(n.n) AS va, sum(c.n * vb) / max(n.n) AS vb, sum(c.n * ab) / max(n.n) AS ab FROM c, n) "
)


@query(
    "linear_discriminant",
    "K11",
    _CLASS_CTE + ", w AS (SELECT k, ln(c.n / n.n) AS pr, ma, mb, (p.vb * ma - p.ab * mb) / (p.va * p.vb - p.ab * p.ab) AS wa, (p.va * mb - p.ab * ma) / (p.va * p.vb - p.ab * p.ab) AS wb FROM c, p, n), "
    "g AS (SELECT max(pr - 0.5 * (wa * ma + wb * mb)) FILTER (k = 1) - max(pr - 0.5 * (wa * ma + wb * mb)) FILTER (k = 0) AS g0, max(wa) FILTER (k = 1) - max(wa) FILTER (k = 0) AS ga, max(wb) FILTER (k = 1) - max(wb) FILTER (k = 0) AS gb FROM w) "
    "SELECT l_orderkey, l_linenumber, label, round(1 / (1 + exp(-(g0 + ga * a + gb * b))), 6) AS score FROM t, g",
)
def linear_discriminant(t):
    rows = _pair(t)
    out = gaussian.fit_linear_discriminant(rows).transform(rows)
    return out.select("l_orderkey", "l_linenumber", "label", F.round("score", 6).alias("score"))


@query(
    "quadratic_discriminant",
    "K12",
    _CLASS_CTE + ", q AS (SELECT k, ln(c.n / n.n) AS pr, ma, mb, 0.99 * sa + 0.01 AS va, 0.99 * sb + 0.01 AS vb, 0.99 * sab AS ab FROM c, n), "
    "s AS (SELECT l_orderkey, l_linenumber, label, a, b, y, k, pr - 0.5 * ln(va * vb - ab * ab) - 0.5 * (vb * (a - ma) ** 2 - 2 * ab * (a - ma) * (b - mb) + va * (b - mb) ** 2) / (va * vb - ab * ab) AS g FROM t, q) "
    "SELECT p.l_orderkey, p.l_linenumber, p.label, round(1 / (1 + exp(z.g - p.g)), 6) AS score FROM (SELECT * FROM s WHERE k = 1) p JOIN (SELECT * FROM s WHERE k = 0) z "
    "ON p.l_orderkey = z.l_orderkey AND p.l_linenumber = z.l_linenumber AND p.label = z.label AND p.a = z.a AND p.b = z.b AND p.y = z.y",
)
def quadratic_discriminant(t):
    rows = _pair(t)
    out = gaussian.fit_quadratic_discriminant(rows, 0.01).transform(rows)
    return out.select("l_orderkey", "l_linenumber", "label", F.round("score", 6).alias("score"))


@query(
    "balanced_weights",
    "K2",
    f"SELECT label, count(*) AS n, round(max((SELECT count(*) FROM lineitem)) / (2 * count(*)), 6) AS weight FROM (SELECT {_LABEL} AS label FROM lineitem) GROUP BY label",
)
def balanced_weights(t):
    rows = vectorize.balanced_weights(t.raw("lineitem").selectExpr(f"{_LABEL} AS label"), "label")
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 6).alias("weight"))


@query(
    "majority_baseline",
    "K1",
    f"WITH t AS (SELECT {_LABEL} AS label FROM lineitem), m AS (SELECT label AS top FROM t GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) "
    "SELECT cast(label as double) AS label, cast(top as double) AS prediction, count(*) AS n FROM t, m GROUP BY 1, 2",
)
def majority_baseline(t):
    rows = t.raw("lineitem").selectExpr(f"cast({_LABEL} as double) AS label")
    out = candidates.build("01_DummyClassifier")(rows)(rows)
    return out.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mean_baseline",
    "R1",
    "SELECT round(avg(l_extendedprice), 4) AS prediction, round(avg(abs(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))), 4) AS mae FROM lineitem",
)
def mean_baseline(t):
    rows = t.raw("lineitem").selectExpr("l_extendedprice AS label")
    out = candidates.build("01_DummyRegressor")(rows)(rows)
    return out.agg(
        F.round(F.max("prediction"), 4).alias("prediction"), F.round(F.avg(F.abs(F.col("label") - F.col("prediction"))), 4).alias("mae")
    )


# --- neighbours and clusters on embeddings ---------------------------------------------------------------------------

_DIST = "list_distance(cast(a.embedding as double[]), cast(b.embedding as double[]))"
_NEAR_SQL = (
    f"SELECT id, ref_id, distance, label, position FROM (SELECT a.vec_id AS id, b.vec_id AS ref_id, {_DIST} AS distance, b.label AS label, "
    f"row_number() OVER (PARTITION BY a.vec_id ORDER BY {_DIST}, b.vec_id) AS position FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE position <= 5"
)


def _vectors(t, payload=None):
    return keep_for_reuse(nearest.as_points(t.raw("embeddings"), "vec_id", "embedding", payload))


@query("knn_join", "U6", f"SELECT id, ref_id, round(distance, 6) AS distance, cast(position as integer) AS position FROM ({_NEAR_SQL})")
def knn_join(t):
    pts = _vectors(t)
    found = nearest.nearest_neighbours(pts, pts, 5, exclude_self=True)
    return found.select("id", "ref_id", F.round("distance", 6).alias("distance"), "position")


@query(
    "knn_classify",
    "K3",
    "SELECT id, cast(label as double) AS prediction FROM (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, label) AS r "
    f"FROM ({_NEAR_SQL}) GROUP BY id, label) WHERE r = 1",
)
def knn_classify(t):
    pts = _vectors(t, "label")
    return nearest.vote(nearest.nearest_neighbours(pts, pts, 5, exclude_self=True)).select("id", "prediction")


@query(
    "knn_regress",
    "R6",
    f"SELECT id, round(sum(label / distance) / sum(1 / distance), 6) AS prediction FROM ({_NEAR_SQL}) GROUP BY id",
)
def knn_regress(t):
    pts = _vectors(t, "label")
    found = nearest.nearest_neighbours(pts, pts, 5, exclude_self=True)
    return nearest.average(found, "distance").select("id", F.round("prediction", 6).alias("prediction"))


_EPS, _MIN = 1.15, 4


@query(
    "dbscan_core",
    "U5",
    f"SELECT a.vec_id AS id, count(*) AS n, count(*) >= {_MIN} AS core FROM embeddings a JOIN embeddings b ON {_DIST} <= {_EPS} GROUP BY a.vec_id",
)
def dbscan_core(t):
    return density.neighbour_counts(_vectors(t), _EPS).withColumn("core", F.col("n") >= _MIN)


_DBSCAN_SQL = (
    f"WITH RECURSIVE n AS (SELECT a.vec_id AS i, b.vec_id AS j FROM embeddings a JOIN embeddings b ON {_DIST} <= {_EPS}), "
    f"c AS (SELECT i FROM n GROUP BY i HAVING count(*) >= {_MIN}), e AS (SELECT n.i, n.j FROM n JOIN c x ON n.i = x.i JOIN c y ON n.j = y.i), "
    "r(i, root) AS (SELECT i, i FROM c UNION SELECT e.j, r.root FROM r JOIN e ON r.i = e.i), m AS (SELECT i, min(root) AS root FROM r GROUP BY i), "
    "k AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM m)), cl AS (SELECT m.i, k.cluster FROM m JOIN k USING (root)), "
    "b AS (SELECT n.i, min(cl.cluster) AS cluster FROM n JOIN cl ON n.j = cl.i WHERE n.i NOT IN (SELECT i FROM c) GROUP BY n.i) "
    "SELECT v.vec_id AS id, cast(coalesce(cl.cluster, b.cluster, -1) as bigint) AS cluster FROM embeddings v LEFT JOIN cl ON v.vec_id = cl.i LEFT JOIN b ON v.vec_id = b.i"
)


@query("dbscan_labels", "U5", _DBSCAN_SQL)
def dbscan_labels(t):
    return density.dbscan(_vectors(t), _EPS, _MIN)


_LABEL_CENTRES = (
    "WITH u AS (SELECT vec_id, label, unnest(cast(embedding as double[])) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings), "
    "m AS (SELECT label, list(v ORDER BY d) AS c FROM (SELECT label, d, avg(v) AS v FROM u GROUP BY label, d) GROUP BY label) "
)


@query(
    "davies_bouldin",
    "U4",
    _LABEL_CENTRES + ", s AS (SELECT e.label, avg(list_distance(cast(embedding as double[]), c)) AS s, any_value(c) AS c FROM embeddings e JOIN m ON e.label = m.label GROUP BY e.label) "
    "SELECT round(avg(w), 6) AS davies_bouldin FROM (SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS w FROM s a JOIN s b ON a.label <> b.label GROUP BY a.label)",
)
def davies_bouldin(t):
    rows = cluster.to_vector(t.raw("embeddings"), "embedding").withColumn("cluster", F.col("label"))
    value = cluster.davies_bouldin(rows)
    return t.spark.createDataFrame([(value,)], "davies_bouldin double").select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


def _silhouette_sql(distance: str) -> str:
    return (
        f"WITH g AS (SELECT a.vec_id, a.label AS own, b.label AS c, sum({distance}) AS s, count(*) AS n FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.label), "
        "x AS (SELECT vec_id, max(s / n) FILTER (own = c) AS a, min(s / n) FILTER (own <> c) AS b FROM g GROUP BY vec_id) "
        "SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM x"
    )


@query("silhouette_squared", "U3", _silhouette_sql(f"{_DIST} ** 2"))
def silhouette_squared(t):
    rows = cluster.to_vector(t.raw("embeddings"), "embedding").withColumn("cluster", F.col("label"))
    value = cluster.silhouette_squared(rows)
    return t.spark.createDataFrame([(value,)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


@query("silhouette_euclidean", "U3", _silhouette_sql(_DIST))
def silhouette_euclidean(t):
    value = cluster.silhouette_euclidean(_vectors(t, "label"))
    return t.spark.createDataFrame([(value,)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


@query("kmeans_search", "U1 U2 U12")
def kmeans_search(t):
    """Cost and silhouette per k, and the k that wins."""
    rows = keep_for_reuse(cluster.to_vector(t.raw("embeddings"), "embedding"))
    found = []
    for k, model in cluster.best_kmeans_each(rows, (3, 4, 5), restarts=10).items():
        score = cluster.silhouette_squared(model.transform(rows))
        found.append((f"k={k}", k, round(score, 4), round(model.cost, 4)))
    table = t.spark.createDataFrame(found, "parametros string, n_clusters int, silhouette_score double, inertia double")
    best = table.agg(F.max_by("n_clusters", "silhouette_score")).scalar()
    return table.withColumn("elegido", F.col("n_clusters") == best)


@query("pca_coordinates", "U7 U10")
def pca_coordinates(t):
    rows = keep_for_reuse(cluster.to_vector(t.raw("embeddings"), "embedding"))
    return cluster.principal_components(rows, 2).transform(rows, ["pca_1", "pca_2"]).select("vec_id", "pca_1", "pca_2", "label")


@query(
    "pca_2d",
    "U7",
    f"WITH m AS (SELECT var_pop(a) AS va, var_pop(b) AS vb, covar_pop(a, b) AS ab FROM ({_PAIR_SQL})) SELECT "
    "round(((va + vb) / 2 + sqrt(((va - vb) / 2) ** 2 + ab ** 2)) / (va + vb), 6) AS varianza_1 FROM m",
)
def pca_2d(t):
    ratio = cluster.principal_components(_pair(t), 1).ratio
    return t.spark.createDataFrame([(float(ratio[0]),)], "v double").select(F.round("v", 6).alias("varianza_1"))


_PROFILE_SQL = (
    f"WITH t AS (SELECT l_linenumber AS cluster, {_LABEL} AS late, l_quantity, l_extendedprice FROM lineitem), g AS (SELECT avg(late) AS g FROM t), "
    "p AS (SELECT cluster, count(late) AS n_envios, avg(late) AS r, avg(l_quantity) AS q, avg(l_extendedprice) AS e FROM t GROUP BY cluster) "
)


@query(
    "cluster_profile",
    "U8 U9",
    _PROFILE_SQL + "SELECT cluster, n_envios, round(r, 4) AS tasa_incidencia, round(q, 4) AS cantidad_promedio, round(e, 4) AS precio_promedio, "
    "CASE WHEN r >= g * 1.25 THEN 'riesgo_operativo_alto' WHEN r <= g * 0.75 THEN 'riesgo_operativo_bajo' ELSE 'riesgo_operativo_medio' END AS interpretacion_negocio FROM p, g",
)
def cluster_profile(t):
    return _profile(t)


def _profile(t):
    rows = t.raw("lineitem").selectExpr("l_linenumber AS cluster", f"{_LABEL} AS late", "l_quantity", "l_extendedprice")
    return cluster.cluster_profile(rows, "cluster", "late", {"cantidad_promedio": "l_quantity", "precio_promedio": "l_extendedprice"})


@query(
    "risk_band",
    "U9",
    "WITH t AS (SELECT event_type AS cluster, CASE WHEN value > 100 AND event_type IN ('click', 'view') THEN 1 WHEN value > 140 THEN 1 ELSE 0 END AS y FROM events), g AS (SELECT avg(y) AS g FROM t) "
    "SELECT cluster, count(*) AS n_envios, round(avg(y), 4) AS tasa_incidencia, CASE WHEN avg(y) >= max(g) * 1.25 THEN 'riesgo_operativo_alto' "
    "WHEN avg(y) <= max(g) * 0.75 THEN 'riesgo_operativo_bajo' ELSE 'riesgo_operativo_medio' END AS interpretacion_negocio FROM t, g GROUP BY cluster",
)
def risk_band(t):
    rows = t.raw("events").selectExpr(
        "event_type AS cluster", "CASE WHEN value > 100 AND event_type IN ('click', 'view') THEN 1 WHEN value > 140 THEN 1 ELSE 0 END AS y"
    )
    return cluster.cluster_profile(rows, "cluster", "y", {})


@query(
    "zscore",
    "U11",
    _PROFILE_SQL + ", f AS (SELECT cluster, round(r, 4) AS r, round(q, 4) AS q FROM p) "
    "SELECT cluster, round((r - (SELECT avg(r) FROM f)) / (SELECT stddev_pop(r) FROM f), 6) AS tasa_incidencia, "
    "round((q - (SELECT avg(q) FROM f)) / (SELECT stddev_pop(q) FROM f), 6) AS cantidad_promedio FROM f",
)
def zscore(t):
    table = _profile(t).select("cluster", "tasa_incidencia", "cantidad_promedio")
    out = features.z_scores(table, ["tasa_incidencia", "cantidad_promedio"])
    return out.withColumns({c: F.round(c, 6) for c in ("tasa_incidencia", "cantidad_promedio")})


# --- fitted models without a SQL twin: rows only ----------------------------------------------------------------------


#: Training rows of a partition where each core has one: a fit is hundreds of short passes, and every partition is a task in each.
PART_ROWS = 500_000


def _labelled(t, kind):
    """Order-level training rows: price, date parts and priority against the return share of the order's lines."""
    lines = t.raw("lineitem").groupBy("l_orderkey").agg(
        F.max((F.col("l_returnflag") == "R").cast("double")).alias("returned"),
        F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"),
        F.count(F.lit(1)).cast("double").alias("lines"),
        F.sum("l_extendedprice").alias("price"),
    )
    rows = t.raw("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    label = F.col("returned") if kind == "clf" else F.col("price") / 10000
    rows = rows.select(
        F.col("o_orderkey").alias("row_id"), label.alias("label"), "quantity", "discount", "lines",
        F.month("o_orderdate").cast("double").alias("month"), "o_orderpriority",
    )
    plan = vectorize.fit_vectorizer(rows, ["quantity", "discount", "lines", "month"], ["o_orderpriority"])
    ready = plan.transform(rows).select("row_id", "label", "features")
    ready = vectorize.balanced_weights(ready, "label") if kind == "clf" else ready.withColumn("weight", F.lit(1.0))
    ready = keep_for_reuse(ready)
    return ready.coalesce(max(t.spark.sparkContext.defaultParallelism, math.ceil(ready.count() / PART_ROWS)))


# The candidates' own numbers of trees and rounds; depth is set where the original has no limit.
_CLF_PARAMS = {
    "02_LogisticRegression": {},
    "04_DecisionTreeClassifier": {"max_depth": 5},
    "05_RandomForestClassifier": {"n_estimators": 100, "max_depth": 6},
    "07_GradientBoostingClassifier": {},
    "08_HistGradientBoosting": {},
    "09_AdaBoostClassifier": {},
    "10_SVC": {},
    "14_BaggingClassifier": {"max_depth": 12},
    "15_SGDClassifier": {},
}
_REG_PARAMS = {
    "07_DecisionTreeRegressor": {"max_depth": 12},
    "08_RandomForestRegressor": {"max_depth": 12},
    "10_GradientBoostingRegressor": {},
    "11_HistGradientBoosting": {},
    "12_AdaBoostRegressor": {},
    "13_SVR": {},
    "14_BaggingRegressor": {"max_depth": 12},
    "15_SGDRegressor": {},
}
_IDS = {
    "02": "K2", "04": "K4", "05": "K5", "07": "K6", "08": "K7", "09": "K8", "10": "K9", "14": "K13", "15": "K14",
}
_REG_IDS = {"07": "R7", "08": "R8", "10": "R9", "11": "R10", "12": "R11", "13": "R12", "14": "R13", "15": "R14"}


def _gain_sql(rows: str, gain: str) -> str:
    """All cuts of a table (v, x, y) by value with their gains; ``rows`` gives it."""
    return (
        f"SELECT v, x, n, s, tn, ts, {gain} AS gain FROM (SELECT v, x, sum(c) OVER (PARTITION BY v ORDER BY x) AS n, sum(s) OVER (PARTITION BY v ORDER BY x) AS s, "
        f"sum(c) OVER (PARTITION BY v) AS tn, sum(s) OVER (PARTITION BY v) AS ts FROM (SELECT v, x, count(*) AS c, sum(y) AS s FROM ({rows}) GROUP BY v, x))"
        " WHERE n >= 20 AND tn - n >= 20"
    )


_GAIN = "s * s / (n + 1) + (ts - s) * (ts - s) / (tn - n + 1) - ts * ts / (tn + 1)"
_LONG_SQL = "SELECT i, unnest([0, 1, 2]) AS v, unnest([q, d, t]) AS x, y FROM ({})"
_FIRST_BEST = "ORDER BY round(gain, 6) DESC, v, x LIMIT 1"
_TREE_SQL = (
    f"WITH base AS (SELECT row_number() OVER () AS i, l_quantity AS q, l_discount AS d, l_tax AS t, cast({_LABEL} as double) AS label FROM lineitem), "
    "r AS (SELECT i, q, d, t, (SELECT avg(label) FROM base) - label AS y FROM base), "
    f"one AS (SELECT * FROM ({_gain_sql(_LONG_SQL.format('SELECT * FROM r'), _GAIN)}) {_FIRST_BEST}), "
    "side AS (SELECT r.*, [q, d, t][1 + one.v] <= one.x AS izquierda FROM r, one), "
    f"a AS (SELECT * FROM ({_gain_sql(_LONG_SQL.format('SELECT * FROM side WHERE izquierda'), _GAIN)}) {_FIRST_BEST}), "
    f"b AS (SELECT * FROM ({_gain_sql(_LONG_SQL.format('SELECT * FROM side WHERE NOT izquierda'), _GAIN)}) {_FIRST_BEST}), "
    "two AS (SELECT * FROM (SELECT *, true AS izquierda FROM a UNION ALL SELECT *, false FROM b) WHERE gain > 0 ORDER BY gain DESC, izquierda DESC LIMIT 1), "
    "leaf AS (SELECT y, CASE WHEN side.izquierda <> two.izquierda THEN 0 WHEN [q, d, t][1 + two.v] <= two.x THEN 1 ELSE 2 END AS hoja FROM side, two) "
    "SELECT count(*) AS filas, round(-0.5 * sum(y) / (count(*) + 1), 6) AS valor FROM leaf GROUP BY hoja"
)


@query("histogram_tree", "K7 R10", _TREE_SQL)
def histogram_tree(t):
    """Leaves of one best-first tree: rows and shrunken value, with an L2 term of 1."""
    rows = t.raw("lineitem").select("l_quantity", "l_discount", "l_tax", F.expr(f"cast({_LABEL} as double)").alias("label"))
    ready = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(rows)
    model = histogram.fit_histogram_boosting(ready, "squared_error", 1, 0.5, max_leaf_nodes=3, l2=1.0)
    leaves = model.transform(ready).groupBy(F.round(F.col("prediction") - F.lit(model.base), 6).alias("valor")).agg(F.count(F.lit(1)).alias("filas"))
    return leaves.select("filas", "valor")


def _register_fits():
    for name, params in _CLF_PARAMS.items():

        def clf(t, name=name, params=params):
            rows = _labelled(t, "clf")
            out = candidates.build(name, params)(rows)(rows)
            counts = metrics.with_rates(metrics.confusion(out, "label", "prediction"))
            return counts.withColumns({c: F.round(c, 4) for c in ("accuracy", "precision", "recall", "f1")})

        query("fit_" + name.split("_")[1].lower(), _IDS[name[:2]])(clf)
    for name, params in _REG_PARAMS.items():

        def reg(t, name=name, params=params):
            rows = _labelled(t, "reg")
            out = candidates.build(name, params)(rows)(rows)
            return metrics.regression_errors(out, "label", "prediction")

        query("fit_" + name.split("_")[1].lower() + ("_reg" if name[:2] == "11" else ""), _REG_IDS[name[:2]])(reg)


_register_fits()


@query("cross_validation", "Q4")
def cross_validation(t):
    """Fold-wise scores of the aggregate models: naive Bayes and both discriminants."""
    names = ["11_GaussianNB", "12_LinearDiscriminantAnalysis", "13_QuadraticDiscriminantAnalysis", "01_DummyClassifier"]
    return selection.rank_models(_order_folds(t), names).drop("tiempo_seg")


def _order_folds(t):
    return selection.fold_input(_orders(t), "clasificacion", "late", "l_orderkey", ["quantity", "discount", "tax"], [])


def _orders(t):
    lines = t.raw("lineitem").withColumn("late", (F.col("l_returnflag") == "R").cast("int"))
    return lines.groupBy("l_orderkey").agg(
        F.max("late").alias("late"), F.sum("l_quantity").alias("quantity"), F.sum(F.col("l_extendedprice") / 1000).alias("price"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax")
    )


@query("smoothing_sweep", "Q15 Q16 Q22")
def smoothing_sweep(t):
    """Fifty log-spaced smoothing values scored over five folds in one job."""
    rows = _pair(t).withColumn("label", F.col("label").cast("int"))
    marked = folds.hashed_folds(rows, ["l_orderkey", "l_linenumber"], 5)
    values = [10 ** (-12 + 5 * i / 49) for i in range(50)]
    rates = metrics.with_rates(gaussian.smoothing_sweep(marked, values, "fold", range(5)))
    return rates.groupBy("trial", "var_smoothing").agg(F.round(F.avg("f1"), 6).alias("f1")).orderBy(F.col("f1").desc(), "trial")


@query("parameter_search", "Q14 Q15 Q16 Q19 K14")
def parameter_search(t):
    """Best grid and random point of every linear and moment model over the orders table, both problems, as a search-result table."""
    prices = selection.fold_input(_orders(t), "regresion", "price", "l_orderkey", ["quantity", "discount", "tax"], [])
    rows = []
    for data, spaces, names in (
        (_order_folds(t), candidates.CLASSIFIER_SPACES, ("02_LogisticRegression", "11_GaussianNB", "12_LinearDiscriminantAnalysis", "15_SGDClassifier")),
        (prices, candidates.REGRESSOR_SPACES, ("03_Ridge", "04_Lasso", "05_ElasticNet")),
    ):
        for name in names:
            lists = {method: selection.combinations(spaces[name][method]) for method in ("grid", "random")}
            for (method, trials), (params, score) in zip(lists.items(), selection.search_each(data, name, list(lists.values())), strict=True):
                rows.append((data.kind, name, method, len(trials), round(score, 4), selection.params_json(params)))
    return t.spark.createDataFrame(rows, "tipo_problema string, modelo string, search string, n_combinaciones int, best_score_cv double, best_params string")


def _ridge_errors_sql(alphas) -> str:
    """Ridge on two features per fold and penalty from sums of the rows outside the fold, and its error inside it."""
    sums = "count(*) AS n, sum(a) AS sa, sum(b) AS sb, sum(y) AS sy, sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(a * y) AS say, sum(b * y) AS sby"
    listed = ", ".join(f"({a})" for a in alphas)
    return (
        "WITH r AS (SELECT l_orderkey % 5 AS f, l_quantity AS a, 100 * l_discount AS b, l_extendedprice / 1000 AS y FROM lineitem), k AS (SELECT DISTINCT f AS part FROM r), "
        f"s AS (SELECT part, {sums} FROM r JOIN k ON f <> part GROUP BY part), "
        f"c AS (SELECT part, alpha, sa / n AS ma, sb / n AS mb, sy / n AS my, saa - sa * sa / n + alpha AS aa, sab - sa * sb / n AS ab, sbb - sb * sb / n + alpha AS bb, say - sa * sy / n AS ay, sby - sb * sy / n AS yb "
        f"FROM s, (VALUES {listed}) AS p(alpha)), "
        "w AS (SELECT part, alpha, ma, mb, my, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM c), "
        "e AS (SELECT alpha, part, avg(abs(my + wa * (a - ma) + wb * (b - mb) - y)) AS mae FROM w JOIN r ON f = part GROUP BY alpha, part) "
        "SELECT cast(alpha as double) AS alpha, round(avg(mae), 6) AS mae FROM e GROUP BY alpha"
    )


_ALPHAS = tuple(candidates.REGRESSOR_SPACES["03_Ridge"]["random"]["alpha"])


@query("ridge_search", "Q4 Q14 Q16 R3", _ridge_errors_sql(_ALPHAS))
def ridge_search(t):
    """Mean error over five folds of every ridge penalty of the search space: one pass to fit all, one to score all."""
    rows = t.raw("lineitem").selectExpr("cast(l_orderkey % 5 as int) AS fold", "l_quantity", "100 * l_discount AS b", "l_extendedprice / 1000 AS label", "1.0 AS weight")
    ready = VectorAssembler(inputCols=["l_quantity", "b"], outputCol="features").transform(rows)
    errors = batch.fold_means([ready] * 5, "03_Ridge", [{"alpha": a} for a in _ALPHAS], True)
    return t.spark.createDataFrame(list(zip(map(float, _ALPHAS), errors)), "alpha double, mae double").withColumn("mae", F.round("mae", 6))


@query("tuned_stages", "Q17 Q18 Q20")
def tuned_stages(t):
    """Base, random-search and grid-search stage of naive Bayes over all orders, best fold score first."""
    done = selection.tune(
        _orders(t), "clasificacion", "late", "l_orderkey", ["quantity", "discount", "tax"], [], ["11_GaussianNB"], k=5, n_iter=12
    )
    return done.comparison.drop(*["mae", "mse", "rmse", "r2"]).orderBy(F.col("cv_score").desc(), "etapa")


@query("batch_scoring", "Q21")
def batch_scoring(t):
    rows = _labelled(t, "clf")
    out = gaussian.fit_naive_bayes(rows).transform(rows)
    return selection.alert_text(out.select("row_id", "prediction", "score"))
