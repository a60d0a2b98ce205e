"""The shipment example end to end: raw tables to cleaned, joined, checked and training tables.

Column names are those of the shipment data. Every stage is a composition of
the generic operators; nothing here is needed to use them elsewhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from copy import deepcopy
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numbers import to_number
from millrace.models import candidates
from millrace.operators import clean, cluster, density, features, join, nearest, prepare, profile, rules, vectorize
from millrace.plans import selection
from millrace.session import col, cut_lineage, stage
from millrace.sources.tables import ROW_ORDER, read_csv, typed_by_content

# Default parameters of the example.
PARAMETERS: dict[str, Any] = {
    "outliers": {"iqr_multiplier": 2.0, "columnas_peso": ["peso_kg", "volumen_m3"]},
    "imputacion": {"origen_desconocido": "Desconocido"},
    "encoding": {"onehot_cols": ["tipo_carga_norm"]},
    "normalizacion": {
        "columnas_minmax": [
            "peso_kg", "volumen_m3", "distancia_km", "tiempo_estimado_hrs", "peaje_total", "km_recorridos", "costo_impacto_total",
        ]
    },
    "validacion": {
        "peso_kg": [1.0, 25000.0],
        "distancia_km": [1.0, 5000.0],
        "eficiencia_peso": [0.0, 10.0],
        "dias_en_transito": [0, 30],
        "columnas_sin_nulos": ["id_envio", "fecha_envio", "id_ruta", "id_vehiculo", "peso_kg", "tipo_carga_norm", "estado"],
    },
    "hyperparameter_tuning": {"random_state": 42, "test_size": 0.2, "cv_splits": 5, "randomized_n_iter": 12},
    "unsupervised_learning": {"random_state": 42, "kmeans_k_values": [3, 4, 5], "dbscan_eps": 2.5, "dbscan_min_samples": 10},
}

# Column sets of the training tables.
LEAKED = ["total_incidencias", "costo_impacto_total", "tipos_incidencia", "costo_impacto_total_norm"]
POST_EVENT = ["fecha_entrega", "dias_en_transito"]
REDUNDANT = [
    "tipo_carga", "placa", "estado_encoded", "tipo_via_encoded", "peso_kg_norm", "volumen_m3_norm", "distancia_km_norm",
    "tiempo_estimado_hrs_norm", "peaje_total_norm", "km_recorridos_norm",
]
IMPUTED_NUMBERS = [
    "peso_kg", "volumen_m3", "distancia_km", "tiempo_estimado_hrs", "peaje_total", "capacidad_kg", "capacidad_m3",
    "km_recorridos", "eficiencia_peso", "eficiencia_volumen", "costo_por_km",
]
CATEGORIES = ["estado", "tipo_carga_norm", "origen", "destino", "tipo_via", "tipo", "estado_vehiculo"]
CALENDAR = {"month": "mes_envio", "weekday": "dia_semana_envio", "quarter": "trimestre_envio"}
NUMBERS = [*IMPUTED_NUMBERS, "id_ruta", "id_vehiculo", *CALENDAR.values()]
CLASS_TARGET, DAYS_TARGET = "tiene_incidencia", "dias_en_transito"
YEAR = "año_fabricacion"


def parameters(changes: Mapping[str, Mapping[str, Any]] | None = None) -> dict[str, Any]:
    """Default parameters with some entries replaced."""
    out = deepcopy(PARAMETERS)
    for section, values in (changes or {}).items():
        out.setdefault(section, {}).update(values)
    return out


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four raw CSV tables, numbers recognised by content, file order kept."""
    names = ("envios", "rutas", "vehiculos", "incidencias")
    return {n: typed_by_content(read_csv(spark, f"{folder}/{n}.csv", keep_order=True)) for n in names}


def _order(df: DataFrame) -> list[str]:
    return [c for c in ROW_ORDER if c in df.columns]


def without_order(df: DataFrame) -> DataFrame:
    return df.drop(*ROW_ORDER)


def ingestion_report(raw: Mapping[str, DataFrame]) -> DataFrame:
    return profile.severity_report([profile.table_profile(without_order(df), n) for n, df in raw.items()])


def clean_shipments(envios: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Ids, dates, texts and numbers; route mode before the fences, as the fences drop rows."""
    df = clean.drop_duplicate_rows(envios, _order(envios))
    df = clean.clean_ids(df, ["id_envio", "id_ruta", "id_vehiculo"], positive_only=True)
    df = clean.parse_dates(df, ["fecha_envio", "fecha_entrega"])
    df = clean.title_columns(df, {"tipo_carga_norm": "tipo_carga", "estado": "estado"})
    df = stage(clean.coerce_numbers(df, ["peso_kg", "volumen_m3"]), "shipments")
    df = clean.fill_mode(df, ["id_ruta"])
    fence = params["outliers"]
    return clean.drop_outliers(df, fence["columnas_peso"], fence["iqr_multiplier"])


def clean_routes(rutas: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    df = clean.drop_duplicate_rows(rutas, _order(rutas))
    df = clean.title_columns(df, ["tipo_via"])
    df = clean.fill_constant(df, {"origen": params["imputacion"]["origen_desconocido"]})
    df = clean.coerce_numbers(df, ["distancia_km", "tiempo_estimado_hrs", "peaje_total"])
    return clean.clean_ids(df, ["id_ruta"])


def clean_vehicles(vehiculos: DataFrame) -> DataFrame:
    """Capacity is filled per type as written, before the type text is unified."""
    df = clean.drop_duplicate_rows(vehiculos, _order(vehiculos))
    df = clean.coerce_numbers(df, ["capacidad_kg", "capacidad_m3", YEAR, "km_recorridos"])
    df = clean.fill_group_median(df, "tipo", "capacidad_m3")
    df = clean.title_columns(df, ["estado_vehiculo", "tipo"])
    return clean.clean_ids(df, ["id_vehiculo"])


def clean_incidents(incidencias: DataFrame) -> DataFrame:
    df = clean.drop_duplicate_rows(incidencias, _order(incidencias))
    df = clean.parse_dates(df, ["fecha"])
    df = clean.title_columns(df, ["tipo_incidencia", "descripcion"])
    df = clean.clean_money(df, ["costo_impacto"])
    df = clean.fill_median(df, ["costo_impacto"])
    return clean.clean_ids(df, ["id_incidencia", "id_envio"])


def aggregate_incidents(incidencias: DataFrame) -> DataFrame:
    return join.aggregate_children(
        incidencias,
        "id_envio",
        _order(incidencias) or ["id_incidencia"],
        count={"total_incidencias": "id_incidencia"},
        total={"costo_impacto_total": "costo_impacto"},
        listed={"tipos_incidencia": "tipo_incidencia"},
    )


def _dimension(df: DataFrame, key: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return without_order(join.unique_by_key(df, key, _order(df) or rest))


def join_master(envios: DataFrame, rutas: DataFrame, vehiculos: DataFrame, incidencias: DataFrame) -> DataFrame:
    df = without_order(envios)
    df = join.left_join_unique(df, _dimension(rutas, "id_ruta"), "id_ruta")
    df = join.left_join_unique(df, _dimension(vehiculos, "id_vehiculo"), "id_vehiculo")
    df = join.left_join_unique(df, aggregate_incidents(incidencias), "id_envio")
    return join.fill_defaults(
        df, {"total_incidencias": 0, "costo_impacto_total": 0.0, "tipos_incidencia": "Sin Incidencia"}
    )


def derive(df: DataFrame) -> DataFrame:
    df = features.duration_days(df, "fecha_envio", "fecha_entrega", DAYS_TARGET)
    df = features.ratios(
        df,
        {
            "eficiencia_peso": ("peso_kg", "capacidad_kg"),
            "eficiencia_volumen": ("volumen_m3", "capacidad_m3"),
            "costo_por_km": ("peaje_total", "distancia_km"),
        },
    )
    return features.count_flag(df, "total_incidencias", CLASS_TARGET)


def encode_and_scale(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    for c in params["encoding"]["onehot_cols"]:
        if c in df.columns:
            df = features.one_hot(df, c)
    df = features.label_encode(df, "estado", "estado_encoded")
    df = features.label_encode(df, "tipo_via", "tipo_via_encoded")
    return features.min_max(df, params["normalizacion"]["columnas_minmax"])


def build_master(raw: Mapping[str, DataFrame], params: Mapping[str, Any] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Master table and the cleaned tables it was joined from."""
    params = params or parameters()
    cleaned = {
        "envios": clean_shipments(raw["envios"], params),
        "rutas": clean_routes(raw["rutas"], params),
        "vehiculos": clean_vehicles(raw["vehiculos"]),
        "incidencias": clean_incidents(raw["incidencias"]),
    }
    joined = derive(join_master(*[cleaned[n] for n in ("envios", "rutas", "vehiculos", "incidencias")]))
    return encode_and_scale(stage(joined, "master"), params), cleaned


DECLARED = (
    rules.ColumnRule("id_envio", "int", nullable=False),
    rules.ColumnRule("id_ruta", "int"),
    rules.ColumnRule("id_vehiculo", "int"),
    rules.ColumnRule("peso_kg", "float", at_least=0.0),
    rules.ColumnRule("volumen_m3", "float", at_least=0.0),
    rules.ColumnRule(CLASS_TARGET, "int", nullable=False, allowed=(0, 1)),
)
EXPECTED_TYPES = {
    "id_envio": "bigint", "id_ruta": "bigint", "id_vehiculo": "bigint", "peso_kg": "double", "volumen_m3": "double",
    "tiene_incidencia": "int", "total_incidencias": "bigint",
}


def validate(master: DataFrame, rutas: DataFrame, vehiculos: DataFrame, params: Mapping[str, Any] | None = None) -> DataFrame:
    v = (params or parameters())["validacion"]
    ranges = {c: tuple(v[c]) for c in ("peso_kg", "distancia_km", "eficiencia_peso", "dias_en_transito")}
    return rules.validation_report(
        [
            rules.check_declared(master, DECLARED),
            rules.check_types(master, EXPECTED_TYPES),
            rules.check_references(master, {"id_ruta": rutas, "id_vehiculo": vehiculos}),
            rules.check_ranges(master, ranges),
            rules.check_nulls(master, v["columnas_sin_nulos"]),
        ]
    )


def _training_ranges(params: Mapping[str, Any]) -> dict[str, tuple[float, float]]:
    return {c: tuple(params["validacion"][c]) for c in ("peso_kg", "distancia_km", "eficiencia_peso")}


def prepare_base(master: DataFrame, params: Mapping[str, Any] | None = None) -> DataFrame:
    params = params or parameters()
    df = prepare.keep_identified(master, "id_envio")
    df = prepare.drop_columns(df, LEAKED + REDUNDANT)
    df = prepare.drop_prefixed(df, "tipo_carga_", keep=["tipo_carga_norm"])
    df = features.calendar(df, "fecha_envio", CALENDAR).drop("fecha_envio")
    df = stage(prepare.rename_by_fragment(df, "fabricaci", YEAR), "base")
    df, _ = prepare.impute_medians(df, [*IMPUTED_NUMBERS, YEAR, *CALENDAR.values()])
    df, _ = prepare.impute_modes(df, [*CATEGORIES, "id_vehiculo"])
    return prepare.keep_eligible(df, _training_ranges(params))


def prepare_classification(base: DataFrame) -> DataFrame:
    prepare.require_target(base, CLASS_TARGET)
    return base.drop(*POST_EVENT)


def prepare_regression(base: DataFrame) -> DataFrame:
    prepare.require_target(base, DAYS_TARGET)
    return base.drop("fecha_entrega", CLASS_TARGET).where(col(DAYS_TARGET).isNotNull())


def preparation_report(master: DataFrame, clf: DataFrame, reg: DataFrame) -> DataFrame:
    """Long-form trace of what was kept, dropped and why."""
    m = master.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id_envio").isNull()).alias("gone")).first()
    c = prepare.binary_balance(clf, CLASS_TARGET).first()
    r = prepare.target_summary(reg, DAYS_TARGET).first()
    rows = [
        ("general", "filas_master_original", str(m["n"]), "Filas del master antes de la preparación"),
        ("general", "filas_eliminadas_id_nulo", str(m["gone"]), "Filas sin id_envio, no identificables"),
        ("general", "filas_excluidas_rangos_modelado", str(max(m["n"] - m["gone"] - c["filas"], 0)), "Filas fuera de rango"),
        ("general", "columnas_master_original", str(len(master.columns)), "Columnas del master"),
    ]
    rows += [("leakage_eliminado", x, "EXCLUIDA", "Deriva de las incidencias ocurridas") for x in LEAKED]
    rows += [("post_evento_clasificacion", x, "EXCLUIDA", "Solo se conoce después del envío") for x in POST_EVENT]
    rows.append(("post_evento_regresion", "fecha_entrega", "EXCLUIDA", "De ella se calcula el target"))
    dummies = [x for x in master.columns if x.startswith("tipo_carga_")]
    rows.append(("dummies_sucias", f"{len(dummies)} columnas tipo_carga_*", "EXCLUIDAS", "Se usa tipo_carga_norm"))
    rows += [("redundantes_excluidas", x, "EXCLUIDA", "Redundante o escalada antes de tiempo") for x in REDUNDANT]
    balance = f"{c['positivos']} positivos / {c['negativos']} negativos ({round(c['pct_positivos'], 1)}%)"
    rows += [
        ("clasificacion", "filas_finales", str(c["filas"]), "Filas de la tabla de clasificación"),
        ("clasificacion", "columnas_finales", str(len(clf.columns)), "Columnas, target incluido"),
        ("clasificacion", "target", CLASS_TARGET, "Variable objetivo binaria"),
        ("clasificacion", "balance_clases", balance, "Balance de clases"),
        ("regresion", "filas_finales", str(r["filas"]), "Filas con target"),
        ("regresion", "columnas_finales", str(len(reg.columns)), "Columnas, target incluido"),
        ("regresion", "target", DAYS_TARGET, "Variable objetivo numérica"),
        (
            "regresion",
            "target_stats",
            f"media={r['media']:.2f} | mediana={r['mediana']:.2f} | std={r['std']:.2f}",
            "Resumen del target",
        ),
    ]
    return prepare.trace_rows(master.sparkSession, rows)


def compare_models(
    table: DataFrame, kind: str, names: Sequence[str] | None = None, overrides=None, k: int = 5, parallelism: int = 4
) -> DataFrame:
    target = CLASS_TARGET if kind == selection.CLASSIFICATION else DAYS_TARGET
    every = candidates.CLASSIFIERS if kind == selection.CLASSIFICATION else candidates.REGRESSORS
    data = selection.fold_input(table, kind, target, "id_envio", NUMBERS, CATEGORIES, k)
    return selection.rank_models(data, names or every, overrides, parallelism)


def tune_models(table: DataFrame, kind: str, ranking: DataFrame, params: Mapping[str, Any] | None = None, n: int = 3) -> selection.Tuned:
    cfg = (params or parameters())["hyperparameter_tuning"]
    clf = kind == selection.CLASSIFICATION
    spaces = candidates.CLASSIFIER_SPACES if clf else candidates.REGRESSOR_SPACES
    finalists = selection.pick_finalists(ranking, list(spaces), "f1" if clf else "mae", not clf, n)
    return selection.tune(
        table, kind, CLASS_TARGET if clf else DAYS_TARGET, "id_envio", NUMBERS, CATEGORIES, finalists, spaces,
        cfg["random_state"], cfg["test_size"], cfg["cv_splits"], cfg["randomized_n_iter"],
    )


def segment(clf: DataFrame, params: Mapping[str, Any] | None = None, restarts: int = 10, euclidean: bool = True):
    """KMeans for several k, DBSCAN and two principal components: (profile, metrics, rows)."""
    cfg = (params or parameters())["unsupervised_learning"]
    spark = clf.sparkSession
    plan = vectorize.fit_vectorizer(clf, NUMBERS, CATEGORIES)
    ready = cut_lineage(plan.transform(clf).select("id_envio", "features"))
    rows, best = [], None
    for k, model in cluster.best_kmeans_each(ready, cfg["kmeans_k_values"], cfg["random_state"], restarts).items():
        labelled = cut_lineage(model.transform(ready))
        if euclidean:
            score = cluster.silhouette_euclidean(nearest.as_points(labelled, "id_envio", "features", "cluster"))
        else:
            score = cluster.silhouette_squared(labelled)
        spread = cluster.davies_bouldin(labelled)
        rows.append(("KMeans", f"k={k}", k, 0, _r(score), _r(spread), _r(model.cost), None))
        if score is not None and (best is None or score > best[0]):
            best = (score, k, labelled.select("id_envio", "cluster"))
    eps, least = cfg["dbscan_eps"], cfg["dbscan_min_samples"]
    points = cut_lineage(nearest.as_points(ready, "id_envio", "features"))
    dense = cut_lineage(density.dbscan(points, eps, least).withColumnRenamed("id", "id_envio"))
    found = dense.agg(F.count_if(F.col("cluster") == density.NOISE).alias("noise"), F.max("cluster").alias("top")).first()
    with_dense = ready.join(dense, "id_envio")
    score = spread = None
    if found["top"] >= 1:
        score = cluster.silhouette_euclidean(nearest.as_points(with_dense, "id_envio", "features", "cluster")) if euclidean else cluster.silhouette_squared(with_dense)
        spread = cluster.davies_bouldin(with_dense)
    rows.append(("DBSCAN", f"eps={eps}, min_samples={least}", found["top"] + 1, found["noise"], _r(score), _r(spread), None, None))
    parts = cluster.principal_components(ready, 2)
    rows.append(("PCA", "n_components=2", best[1], None, None, None, None, _r(parts.ratio.sum())))
    metrics = spark.createDataFrame(
        rows,
        "metodo string, parametros string, n_clusters int, n_ruido int, silhouette_score double, davies_bouldin_score double, "
        "inertia double, varianza_explicada double",
    )
    averages = {
        f"{c}_promedio": c for c in ("peso_kg", "distancia_km", "tiempo_estimado_hrs", "peaje_total", "eficiencia_peso")
    }
    profiled = cluster.cluster_profile(clf.join(best[2], "id_envio"), "cluster", CLASS_TARGET, averages)
    placed = parts.transform(ready, ["pca_1", "pca_2"]).drop("features")
    placed = cluster.cluster_rows(placed, {"cluster_kmeans": best[2], "cluster_dbscan": dense}, "id_envio")
    placed = join.left_join_unique(placed, clf.select("id_envio", CLASS_TARGET), "id_envio")
    return profiled, metrics, placed


def _r(v, digits: int = 4):
    return None if v is None else round(float(v), digits)


def score_new(rows: DataFrame, tuned: selection.Tuned) -> DataFrame:
    """Prediction, probability and alert text for new shipments."""
    ready = rows.withColumn(candidates.ROW_ID, to_number(col("id_envio")).cast("bigint"))
    return selection.alert_text(tuned.apply(tuned.vectorizer.transform(ready)))
