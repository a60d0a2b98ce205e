import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, 8, "tests")
    yield session
    session.stop()


def _messy(rng, word):
    return rng.choice([word, word.upper(), word.lower(), f"  {word}  "])


def _date(rng, y, m, d):
    return f"{d:02d}/{m:02d}/{y}" if rng.random() < 0.5 else f"{y}-{m:02d}-{d:02d}"


def write_shipment_tables(folder, n=400, seed=7):
    """Four small dirty CSV tables with the shape of the shipment case."""
    rng = random.Random(seed)
    cities = ["Temuco", "Santiago", "Castro", "Angol", "Rancagua", "Pucón"]

    def maybe(value, p=0.04):
        return "" if rng.random() < p else value

    rutas = [["id_ruta", "origen", "destino", "distancia_km", "tiempo_estimado_hrs", "tipo_via", "peaje_total"]]
    for i in range(1, 41):
        road = _messy(rng, rng.choice(["Urbana", "Autopista", "Camino Rural", "Ruta Nacional"]))
        km = round(rng.uniform(30, 1900), 1) if i != 9 else 18627.0
        rutas.append([maybe(f"{i}.0"), maybe(rng.choice(cities)), maybe(rng.choice(cities)), maybe(km), maybe(round(rng.uniform(1, 24), 1)), maybe(road), maybe(float(rng.randint(68, 14941)))])
    rutas.append(list(rutas[3]))
    vehiculos = [["id_vehiculo", "placa", "tipo", "capacidad_kg", "capacidad_m3", "año_fabricacion", "estado_vehiculo", "km_recorridos"]]
    for i in range(1, 31):
        kind = _messy(rng, rng.choice(["Camioneta", "Furgón", "Van", "semi-remolque", "Camión"]))
        vehiculos.append([f"{i}.0", f"AB-{i:02d}", maybe(kind), maybe(float(rng.choice([1000, 3000, 5000, 10000]))), maybe(round(rng.uniform(5, 79), 1), 0.15), float(rng.randint(2010, 2024)), rng.choice(["Operativo", "En mantención"]), maybe(float(rng.randint(10000, 480000)))])
    vehiculos.append(list(vehiculos[5]))
    envios = [["id_envio", "id_ruta", "id_vehiculo", "fecha_envio", "fecha_entrega", "tipo_carga", "estado", "peso_kg", "volumen_m3"]]
    for i in range(1, n + 1):
        month, day = rng.randint(1, 12), rng.randint(1, 18)
        ident = maybe(str(i)) if i != 17 else "-17"
        weight = rng.choice(["abc", "90000.0"]) if rng.random() < 0.02 else round(rng.uniform(20, 18000), 1)
        envios.append([ident, maybe(str(rng.randint(1, 42))), maybe(str(rng.randint(1, 32))), maybe(_date(rng, 2023, month, day)), maybe(_date(rng, 2023, month, day + rng.randint(4, 10))), _messy(rng, rng.choice(["Frágil", "Perecible", "General"])), _messy(rng, rng.choice(["Entregado", "En tránsito"])), weight, maybe(round(rng.uniform(1, 60), 1))])
    envios.append(list(envios[10]))
    incidencias = [["id_incidencia", "id_envio", "fecha", "tipo_incidencia", "descripcion", "costo_impacto"]]
    for i in range(1, 91):
        cost = rng.choice(["{}", "{}", "{}", "${}", "~{}", "{} aprox"]).format(float(rng.randint(10000, 1900000)))
        incidencias.append([maybe(f"{i}.0", 0.07), maybe(f"{rng.randint(1, n)}.0"), maybe(_date(rng, 2023, rng.randint(1, 12), rng.randint(1, 28))), maybe(rng.choice(["Robo", "Daño en carga", "Retraso", "Accidente"])), "Incidencia menor", maybe(cost)])
    incidencias.append(list(incidencias[4]))
    for name, rows in {"envios": envios, "rutas": rutas, "vehiculos": vehiculos, "incidencias": incidencias}.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8") as f:
            f.writelines(",".join(str(v) for v in r) + "\n" for r in rows)


@pytest.fixture(scope="session")
def shipment_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shipments")
    write_shipment_tables(str(folder))
    return str(folder)
