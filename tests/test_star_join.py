"""The joins of the shipment master table, on rows of their own."""

from types import SimpleNamespace

from millrace.operators import join
from millrace.workload import shaping


def test_wide_routes_are_joined_last(spark, monkeypatch):
    t = SimpleNamespace(
        shipments=spark.createDataFrame([("1.0", 1, 7, 3, 1.5, 2.0), (None, 2, 7, None, 1.0, 2.0), ("-4", 3, None, 3, 1.0, None)], "shipment_id string, line_no int, route_id long, vehicle_id long, weight double, volume double"),
        routes=spark.createDataFrame([(7, "A", 10.0, 1.0, "Urbana"), (None, "B", 1.0, 1.0, "x")], "route_id long, origin string, km double, toll double, road string"),
        vehicles=spark.createDataFrame([(3, "van", 5.0)], "vehicle_id long, kind string, capacity double"),
        incidents=spark.createDataFrame([(1, 1, "retraso", 2.5, 1), (2, 1, "robo", 1.0, 2)], "incident_id long, shipment_id long, kind string, cost double, rank long"),
    )
    order, real = [], join.left_join_unique

    def noted(fact, dim, key, **more):
        order.append(key)
        return real(fact, dim, key, **more)

    monkeypatch.setattr(join, "left_join_unique", noted)
    out = shaping.star_join(t)
    assert order == ["shipment_id", "vehicle_id", "route_id"]
    assert out.columns == [
        "shipment_id", "vehicle_id", "route_id", "line_no", "weight", "volume", "origin", "km", "toll", "road", "kind", "capacity",
        "total_incidencias", "costo_impacto_total", "tipos_incidencia", "tiene_incidencia",
    ]
    rows = sorted((tuple(r) for r in out.collect()), key=lambda r: r[3])
    assert rows[0][:12] == (1, 3, 7, 1, 1.5, 2.0, "A", 10.0, 1.0, "Urbana", "van", 5.0) and rows[0][12:14] == (2, 3.5)
    assert rows[1][:12] == (None, None, 7, 2, 1.0, 2.0, "A", 10.0, 1.0, "Urbana", None, None) and rows[1][12:] == (0, 0.0, "Sin Incidencia", 0)
    assert rows[2][:4] == (None, 3, None, 3) and rows[2][6:12] == (None, None, None, None, "van", 5.0)
