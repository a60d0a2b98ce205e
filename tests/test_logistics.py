import pytest
from pyspark.sql import functions as F

from millrace.plans import logistics, selection
from millrace.session import cut_lineage


@pytest.fixture(scope="module")
def built(spark, shipment_folder):
    raw = logistics.read_tables(spark, shipment_folder)
    master, cleaned = logistics.build_master(raw)
    master = cut_lineage(master)
    base = cut_lineage(logistics.prepare_base(master))
    return raw, master, cleaned, base


def test_ingestion_report_covers_every_column(built):
    raw = built[0]
    report = logistics.ingestion_report(raw)
    assert report.count() == 9 + 7 + 8 + 6
    assert report.where("dataset = 'incidencias' and columna = 'costo_impacto'").first()["tipo_dato"] == "string"


def test_master_has_one_row_per_cleaned_shipment(built):
    _, master, cleaned, _ = built
    assert master.count() == cleaned["envios"].count()
    assert master.where("tiene_incidencia = 1").count() > 0
    assert master.where("(total_incidencias > 0) != (tiene_incidencia = 1)").count() == 0
    assert master.where("dias_en_transito < 0 or dias_en_transito > 60").count() == 0
    bounds = master.agg(F.min("peso_kg_norm"), F.max("peso_kg_norm")).first()
    assert tuple(bounds) == (0.0, 1.0)
    assert cleaned["vehiculos"].where("capacidad_m3 is null").count() == 0
    assert cleaned["vehiculos"].where("tipo = 'Semi-Remolque'").count() > 0


def test_incidents_follow_file_order(built):
    _, _, cleaned, _ = built
    got = {r["id_envio"]: r["tipos_incidencia"] for r in logistics.aggregate_incidents(cleaned["incidencias"]).collect()}
    want = {}
    for r in cleaned["incidencias"].orderBy("_file", "_block", "_row").collect():
        if r["id_envio"] is not None:
            kinds = want.setdefault(r["id_envio"], [])
            if r["tipo_incidencia"] and r["tipo_incidencia"] not in kinds:
                kinds.append(r["tipo_incidencia"])
    assert got == {k: "|".join(v) for k, v in want.items()}


def test_validation_states(built):
    _, master, cleaned, _ = built
    report = logistics.validate(master, cleaned["rutas"], cleaned["vehiculos"])
    states = [r["estado"] for r in report.collect()]
    assert states == sorted(states, key=["ERROR", "ADVERTENCIA", "OK"].index)
    missing = master.join(cleaned["rutas"].select("id_ruta").distinct(), "id_ruta", "left_anti").count()
    assert report.where("check = 'integridad:id_ruta'").first()["n_afectados"] == missing


def test_training_tables(built):
    _, master, _, base = built
    clf, reg = logistics.prepare_classification(base), logistics.prepare_regression(base)
    assert len(clf.columns) == 26 and len(reg.columns) == 26
    assert not set(logistics.LEAKED + logistics.POST_EVENT) & set(clf.columns)
    assert all(clf.where(f"`{c}` is null").count() == 0 for c in ("tipo", "peso_kg", "mes_envio", "id_vehiculo"))
    assert reg.where("dias_en_transito is null").count() == 0 and clf.count() == base.count()
    report = {(r["seccion"], r["item"]): r["valor"] for r in logistics.preparation_report(master, clf, reg).collect()}
    assert report[("clasificacion", "filas_finales")] == str(clf.count())


def test_comparison_tuning_and_scoring(built):
    clf = logistics.prepare_classification(built[3])
    names = ["01_DummyClassifier", "11_GaussianNB", "12_LinearDiscriminantAnalysis"]
    ranking = logistics.compare_models(clf, selection.CLASSIFICATION, names, k=3)
    rows = ranking.collect()
    assert [r["posicion"] for r in rows] == [1, 2, 3] and all(r["error"] is None for r in rows)
    assert rows[0]["f1"] >= rows[1]["f1"] >= rows[2]["f1"]
    params = logistics.parameters({"hyperparameter_tuning": {"cv_splits": 3, "randomized_n_iter": 3}})
    tuned = logistics.tune_models(clf, selection.CLASSIFICATION, ranking, params, n=1)
    assert [r["etapa"] for r in tuned.comparison.collect()] == ["base_sin_optimizar", "randomized_search", "grid_search"]
    final = tuned.final.first()
    assert final["modelo_final"] in names and final["cv_score"] == max(r["cv_score"] for r in tuned.comparison.collect())
    scored = logistics.score_new(clf, tuned)
    assert scored.count() == clf.count() and scored.where("probabilidad not like '%.%'").count() == 0


def test_regression_comparison(built):
    reg = logistics.prepare_regression(built[3])
    ranking = logistics.compare_models(reg, selection.REGRESSION, ["01_DummyRegressor", "04_Lasso", "06_KNeighborsRegressor"], k=3)
    assert [r["posicion"] for r in ranking.collect()] == [1, 2, 3]
    assert ranking.where("error is not null").count() == 0


def test_segments(built):
    clf = logistics.prepare_classification(built[3])
    params = logistics.parameters({"unsupervised_learning": {"kmeans_k_values": [2, 3], "dbscan_eps": 4.5, "dbscan_min_samples": 5}})
    profiled, metrics, placed = logistics.segment(clf, params, restarts=1)
    assert placed.count() == clf.count() == profiled.agg(F.sum("n_envios")).first()[0]
    assert [r["metodo"] for r in metrics.collect()] == ["KMeans", "KMeans", "DBSCAN", "PCA"]
    assert placed.where("cluster_kmeans is null or cluster_dbscan is null").count() == 0
