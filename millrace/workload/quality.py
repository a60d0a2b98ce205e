"""Profiling, cleaning and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, numbers, text
from millrace.operators import clean, join, prepare, profile, rules
from millrace.operators.stats import group_medians
from millrace.plans import logistics
from millrace.sources.tables import inventory, keep_for_reuse
from millrace.workload.base import query


def _profile_sql(table: str, name: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for c, kind in columns:
        numeric = kind != "string"
        stats = (
            f"round(cast(min({c}) as double), 4) AS min, round(cast(max({c}) as double), 4) AS max, "
            f"round(avg({c}), 4) AS media, round(stddev_samp({c}), 4) AS std"
            if numeric
            else "cast(NULL as double) AS min, cast(NULL as double) AS max, cast(NULL as double) AS media, cast(NULL as double) AS std"
        )
        parts.append(
            f"SELECT '{name}' AS dataset, '{c}' AS columna, '{kind}' AS tipo_dato, count(*) AS total_registros, "
            f"count(*) - count({c}) AS nulos, round((count(*) - count({c})) * 100.0 / count(*), 2) AS pct_nulos, "
            f"count(DISTINCT {c}) AS valores_unicos, {stats} FROM t"
        )
    return f"WITH t AS {table} " + " UNION ALL ".join(parts)


_SHIPMENT_TYPES = [
    ("shipment_id", "string"), ("line_no", "int"), ("route_id", "bigint"), ("vehicle_id", "bigint"), ("sent", "string"),
    ("cargo", "string"), ("weight_text", "string"), ("weight", "double"), ("volume", "double"), ("discount", "double"),
    ("late", "int"),
]
_ROUTE_TYPES = [("route_id", "bigint"), ("origin", "string"), ("km", "double"), ("toll", "double"), ("road", "string")]


@query("profile_columns", "P1 P2", _profile_sql("{shipments}", "shipments", _SHIPMENT_TYPES))
def profile_columns(t):
    return profile.table_profile(t.shipments, "shipments")


@query("profile_routes", "P1 P2", _profile_sql("{routes}", "routes", _ROUTE_TYPES))
def profile_routes(t):
    return profile.table_profile(t.routes, "routes")


@query(
    "duplicate_rows",
    "P3",
    "SELECT cast(sum(n - 1) as bigint) AS duplicates FROM (SELECT count(*) AS n FROM {routes} "
    "GROUP BY route_id, origin, km, toll, road)",
)
def duplicate_rows(t):
    return profile.duplicate_rows(t.routes)


@query(
    "missing_keys",
    "P4",
    "WITH t AS {shipments} SELECT 'shipment_id' AS key, count(*) FILTER (shipment_id IS NULL) AS missing, "
    "round(count(*) FILTER (shipment_id IS NULL) * 100.0 / count(*), 1) AS pct FROM t UNION ALL "
    "SELECT 'route_id', count(*) FILTER (route_id IS NULL), round(count(*) FILTER (route_id IS NULL) * 100.0 / count(*), 1) FROM t",
)
def missing_keys(t):
    return profile.missing_key(t.shipments, ["shipment_id", "route_id"])


_NUMBER_SQL = r"CASE WHEN regexp_full_match(trim({c}), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN cast(trim({c}) as double) END"


@query(
    "iqr_outlier_count",
    "P5",
    "WITH t AS (SELECT " + _NUMBER_SQL.replace("{c}", "weight_text") + " AS w FROM {shipments}), "
    "q AS (SELECT quantile_cont(w, 0.25) AS a, quantile_cont(w, 0.75) AS b FROM t) "
    "SELECT count(*) FILTER (w < a - 3 * (b - a) OR w > b + 3 * (b - a)) AS extremes, "
    "round(max(a - 3 * (b - a)), 4) AS low, round(max(b + 3 * (b - a)), 4) AS high FROM t, q",
)
def iqr_outlier_count(t):
    out = profile.extreme_count(t.shipments, "weight_text")
    return out.select("extremes", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


@query(
    "padded_text",
    "P6",
    "WITH t AS {shipments} SELECT 'cargo' AS columna, count(*) FILTER (trim(cargo) <> cargo) AS afectados FROM t "
    "UNION ALL SELECT 'weight_text', count(*) FILTER (trim(weight_text) <> weight_text) FROM t",
)
def padded_text(t):
    return profile.padded_text(t.shipments, ["cargo", "weight_text"])


@query(
    "value_counts",
    "P7",
    "SELECT road, count(*) AS cantidad FROM {routes} WHERE road IS NOT NULL GROUP BY road",
)
def value_counts(t):
    return profile.value_counts(t.routes, "road")


@query(
    "category_summary",
    "P8",
    "SELECT kind, count(incident_id) AS cantidad, count(cost_text) AS costo_no_nulos FROM {incidents} "
    "WHERE kind IS NOT NULL GROUP BY kind",
)
def category_summary(t):
    return profile.category_summary(t.incidents, "kind", {"cantidad": "incident_id", "costo_no_nulos": "cost_text"})


def _severity_sql() -> str:
    both = (
        "SELECT * FROM (" + _profile_sql("{shipments}", "shipments", _SHIPMENT_TYPES) + ") UNION ALL "
        "SELECT * FROM (" + _profile_sql("{routes}", "routes", _ROUTE_TYPES) + ")"
    )
    return (
        "SELECT *, CASE WHEN pct_nulos > 0 THEN 'Tiene nulos' ELSE 'Sin nulos' END AS alerta_nulos, "
        "CASE WHEN pct_nulos > 20 THEN 'CRITICO' WHEN pct_nulos >= 5 THEN 'MODERADO' WHEN pct_nulos > 0 THEN 'BAJO' ELSE 'OK' END "
        f"AS nivel_criticidad FROM ({both})"
    )


@query("severity_report", "P9", _severity_sql())
def severity_report(t):
    return profile.severity_report(
        [profile.table_profile(t.shipments, "shipments"), profile.table_profile(t.routes, "routes")]
    )


def _null_sql(table: str, name: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{c}' AS columna, count(*) - count({c}) AS nulos, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS porcentaje FROM {table}"
        for c in columns
    )


@query(
    "null_ranking",
    "P10",
    "WITH s AS {shipments}, r AS {routes}, v AS {vehicles} SELECT * FROM ("
    + " UNION ALL ".join(
        [
            _null_sql("s", "shipments", [c for c, _ in _SHIPMENT_TYPES]),
            _null_sql("r", "routes", [c for c, _ in _ROUTE_TYPES]),
            _null_sql("v", "vehicles", ["vehicle_id", "kind", "capacity"]),
        ]
    )
    + ") WHERE nulos > 0 ORDER BY porcentaje DESC, dataset, columna LIMIT 20",
)
def null_ranking(t):
    return profile.null_ranking({"shipments": t.shipments, "routes": t.routes, "vehicles": t.vehicles})


@query(
    "describe_numbers",
    "P11",
    "WITH t AS {shipments} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS columna, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, "
        f"round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, "
        f"max({c}) AS max FROM t"
        for c in ("weight", "volume", "discount")
    ),
)
def describe_numbers(t):
    out = profile.describe(t.shipments, ["weight", "volume", "discount"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")})


@query(
    "class_balance",
    "P12",
    "WITH t AS {shipments} SELECT late, count(*) AS cantidad, CASE late WHEN 0 THEN 'on time' ELSE 'late' END AS clase, "
    "round(count(*) * 100.0 / (SELECT count(*) FROM t), 2) AS porcentaje FROM t GROUP BY late",
)
def class_balance(t):
    return profile.class_balance(t.shipments, "late", {0: "on time", 1: "late"})


@query(
    "readiness_audit",
    "P13",
    "SELECT 'shipments' AS dataset, count(*) AS filas, cast(11 as integer) AS columnas, cast("
    + " + ".join(f"count(*) - count({c})" for c, _ in _SHIPMENT_TYPES)
    + " as bigint) AS nulos_totales, 'late, sent' AS columnas_leakage_presentes FROM {shipments}",
)
def readiness_audit(t):
    return profile.readiness_audit(t.shipments, "shipments", ["late", "total_incidencias", "sent"])


# --- cleaning ---------------------------------------------------------------------------------


@query("drop_duplicates", "C1", "SELECT DISTINCT * FROM {routes}")
def drop_duplicates(t):
    return clean.drop_duplicate_rows(t.routes)


@query(
    "coerce_numeric",
    "C2",
    "SELECT weight_text, " + _NUMBER_SQL.replace("{c}", "weight_text") + " AS weight_kg, count(*) AS n FROM {shipments} GROUP BY 1, 2",
)
def coerce_numeric(t):
    coerced = t.shipments.withColumn("weight_kg", numbers.to_number(F.col("weight_text")))
    return coerced.groupBy("weight_text", "weight_kg").agg(F.count(F.lit(1)).alias("n"))


@query(
    "positive_ids",
    "C3 C4",
    "SELECT CASE WHEN cast(shipment_id as double) > 0 THEN cast(cast(shipment_id as double) as bigint) END AS shipment_id, "
    "count(*) AS n FROM {shipments} GROUP BY 1",
)
def positive_ids(t):
    cleaned = clean.clean_ids(t.shipments, ["shipment_id"], positive_only=True)
    return cleaned.groupBy("shipment_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fractional_ids",
    "C4",
    "SELECT 'weight_text' AS columna, count(*) FILTER (w <> floor(w)) AS afectados FROM (SELECT "
    + _NUMBER_SQL.replace("{c}", "weight_text") + " AS w FROM {shipments}) UNION ALL "
    "SELECT 'shipment_id', count(*) FILTER (cast(shipment_id as double) <> floor(cast(shipment_id as double))) FROM {shipments}",
)
def fractional_ids(t):
    return clean.fractional_ids(t.shipments, ["weight_text", "shipment_id"])


@query(
    "mixed_dates",
    "C5",
    "SELECT sent, CASE WHEN sent LIKE '%/%' THEN cast(try_strptime(sent, '%d/%m/%Y') as date) "
    "WHEN sent LIKE '%-%' THEN cast(try_strptime(sent, '%Y-%m-%d') as date) END AS sent_on, count(*) AS n FROM {shipments} GROUP BY 1, 2",
)
def mixed_dates(t):
    parsed = t.shipments.withColumn("sent_on", dates.parse_date(F.col("sent")))
    return parsed.groupBy("sent", "sent_on").agg(F.count(F.lit(1)).alias("n"))


_TITLE_SQL = (
    "array_to_string(list_transform(regexp_extract_all(trim({c}), '[A-Za-z]+|[^A-Za-z]+'), "
    "lambda w: concat(upper(w[1]), lower(w[2:]))), '')"
)


@query(
    "title_text",
    "C6",
    "SELECT cargo, CASE WHEN cargo IS NOT NULL THEN " + _TITLE_SQL.replace("{c}", "cargo") + " END AS cargo_norm, count(*) AS n FROM {shipments} GROUP BY 1, 2",
)
def title_text(t):
    titled = t.shipments.withColumn("cargo_norm", text.strip_title(F.col("cargo")))
    return titled.groupBy("cargo", "cargo_norm").agg(F.count(F.lit(1)).alias("n"))


@query(
    "null_share_guard",
    "C7",
    "WITH t AS {shipments} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS columna, round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 6) AS proporcion, "
        f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0.10 AS excede FROM t"
        for c in ("cargo", "volume", "weight")
    ),
)
def null_share_guard(t):
    return clean.null_share_guard(t.shipments, ["cargo", "volume", "weight"])


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "impute_mode",
    "C8 F7",
    f"WITH t AS {{shipments}} SELECT coalesce(route_id, {_mode_sql('route_id')}) AS route_id, coalesce(cargo, {_mode_sql('cargo')}) AS cargo, "
    "count(*) AS n FROM t GROUP BY 1, 2",
)
def impute_mode(t):
    filled = clean.fill_mode(t.shipments.select("route_id", "cargo"), ["route_id", "cargo"])
    return filled.groupBy("route_id", "cargo").agg(F.count(F.lit(1)).alias("n"))


@query(
    "tukey_filter",
    "C9",
    "WITH t AS (SELECT shipment_id, line_no, weight, volume FROM {shipments}), "
    "q AS (SELECT quantile_cont(weight, 0.25) AS a, quantile_cont(weight, 0.75) AS b, quantile_cont(volume, 0.25) AS c, quantile_cont(volume, 0.75) AS d FROM t) "
    "SELECT shipment_id, line_no, weight, volume FROM t, q WHERE NOT coalesce(weight < a - 2 * (b - a) OR weight > b + 2 * (b - a), false) "
    "AND NOT coalesce(volume < c - 2 * (d - c) OR volume > d + 2 * (d - c), false)",
)
def tukey_filter(t):
    rows = t.shipments.select("shipment_id", "line_no", "weight", "volume")
    return clean.drop_outliers(rows, ["weight", "volume"], 2.0)


@query(
    "tukey_report",
    "C9",
    "WITH t AS {shipments}, q AS (SELECT quantile_cont(weight, 0.25) AS a, quantile_cont(weight, 0.75) AS b FROM t) "
    "SELECT 'weight' AS columna, round(max(a - 2 * (b - a)), 4) AS limite_inf, round(max(b + 2 * (b - a)), 4) AS limite_sup, "
    "count(*) FILTER (weight < a - 2 * (b - a) OR weight > b + 2 * (b - a)) AS fuera, "
    "count(*) FILTER (weight < a - 2 * (b - a) OR weight > b + 2 * (b - a)) AS filas_eliminadas FROM t, q",
)
def tukey_report(t):
    out = clean.outlier_report(t.shipments, ["weight"], 2.0)
    return out.withColumns({c: F.round(c, 4) for c in ("limite_inf", "limite_sup")})


@query(
    "impute_const",
    "C10",
    "SELECT coalesce(origin, 'Desconocido') AS origin, count(*) AS n FROM {routes} GROUP BY 1",
)
def impute_const(t):
    return clean.fill_constant(t.routes, {"origin": "Desconocido"}).groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


@query(
    "impute_group_median",
    "C11",
    "WITH t AS {vehicles}, g AS (SELECT kind, quantile_cont(capacity, 0.5) AS m FROM t WHERE kind IS NOT NULL GROUP BY kind), "
    "f AS (SELECT vehicle_id, t.kind, coalesce(capacity, m) AS capacity FROM t LEFT JOIN g ON t.kind = g.kind) "
    "SELECT vehicle_id, kind, round(coalesce(capacity, (SELECT quantile_cont(capacity, 0.5) FROM f)), 4) AS capacity FROM f",
)
def impute_group_median(t):
    filled = clean.fill_group_median(t.vehicles, "kind", "capacity")
    return filled.select("vehicle_id", "kind", F.round("capacity", 4).alias("capacity"))


@query(
    "group_median_weight",
    "C11",
    "SELECT cargo, round(quantile_cont(weight, 0.5), 4) AS median FROM {shipments} WHERE cargo IS NOT NULL AND weight IS NOT NULL GROUP BY cargo",
)
def group_median_weight(t):
    out = group_medians(t.shipments, "cargo", "weight")
    return out.select("cargo", F.round("median", 4).alias("median"))


@query(
    "money_clean",
    "C12",
    r"SELECT cost_text, try_cast(regexp_replace(regexp_replace(cost_text, '[$~]', '', 'g'), '\s*aprox.*$', '') as double) AS cost_num, count(*) AS n "
    "FROM {incidents} GROUP BY 1, 2",
)
def money_clean(t):
    cleaned = t.incidents.withColumn("cost_num", numbers.money(F.col("cost_text")))
    return cleaned.groupBy("cost_text", "cost_num").agg(F.count(F.lit(1)).alias("n"))


@query(
    "impute_median",
    "C13 F6",
    "WITH t AS {incidents} SELECT rank, coalesce(cost, (SELECT quantile_cont(cost, 0.5) FROM t)) AS cost FROM t",
)
def impute_median(t):
    return clean.fill_median(t.incidents.select("rank", "cost"), ["cost"])


@query(
    "clean_shipments",
    "C14",
    "WITH d AS (SELECT DISTINCT * FROM {shipments}), n AS (SELECT CASE WHEN cast(shipment_id as double) > 0 THEN cast(cast(shipment_id as double) as bigint) END AS shipment_id, "
    "line_no, route_id, CASE WHEN sent LIKE '%/%' THEN cast(try_strptime(sent, '%d/%m/%Y') as date) WHEN sent LIKE '%-%' THEN cast(try_strptime(sent, '%Y-%m-%d') as date) END AS sent, "
    "CASE WHEN cargo IS NOT NULL THEN " + _TITLE_SQL.replace("{c}", "cargo") + " END AS cargo, "
    + _NUMBER_SQL.replace("{c}", "weight_text") + " AS weight FROM d), "
    "m AS (SELECT route_id AS r FROM n WHERE route_id IS NOT NULL GROUP BY route_id ORDER BY count(*) DESC, route_id LIMIT 1), "
    "q AS (SELECT quantile_cont(weight, 0.25) AS a, quantile_cont(weight, 0.75) AS b FROM n) "
    "SELECT shipment_id, line_no, coalesce(route_id, r) AS route_id, sent, cargo, weight FROM n, m, q "
    "WHERE NOT coalesce(weight < a - 2 * (b - a) OR weight > b + 2 * (b - a), false)",
)
def clean_shipments(t):
    df = clean.drop_duplicate_rows(t.shipments)
    df = clean.clean_ids(df, ["shipment_id"], positive_only=True)
    df = clean.parse_dates(df, ["sent"])
    df = clean.title_columns(df, ["cargo"])
    df = df.withColumn("weight", numbers.to_number(F.col("weight_text")))
    df = keep_for_reuse(df.select("shipment_id", "line_no", "route_id", "sent", "cargo", "weight"))
    df = clean.fill_mode(df, ["route_id"])
    return clean.drop_outliers(df, ["weight"], 2.0)


@query(
    "clean_routes",
    "C14",
    "WITH d AS (SELECT DISTINCT * FROM {routes}) SELECT cast(route_id as bigint) AS id_ruta, coalesce(origin, 'Sin origen') AS origen, km AS distancia_km, "
    "toll AS peaje_total, CASE WHEN road IS NOT NULL THEN " + _TITLE_SQL.replace("{c}", "road") + " END AS tipo_via FROM d",
)
def clean_routes(t):
    rutas = t.routes.select(
        F.col("route_id").cast("string").alias("id_ruta"), F.col("origin").alias("origen"), F.col("km").cast("string").alias("distancia_km"),
        F.col("toll").cast("string").alias("peaje_total"), F.col("road").alias("tipo_via"),
    )
    return logistics.clean_routes(rutas, {"imputacion": {"origen_desconocido": "Sin origen"}})


@query(
    "clean_vehicles",
    "C11 C14",
    "WITH d AS (SELECT DISTINCT * FROM {vehicles}), g AS (SELECT kind AS k, quantile_cont(capacity, 0.5) AS m FROM d WHERE kind IS NOT NULL GROUP BY kind), "
    "o AS (SELECT vehicle_id, kind, coalesce(capacity, m) AS c FROM d LEFT JOIN g ON kind = k) "
    "SELECT cast(vehicle_id as bigint) AS id_vehiculo, CASE WHEN kind IS NOT NULL THEN " + _TITLE_SQL.replace("{c}", "kind") + " END AS tipo, "
    "coalesce(c, (SELECT quantile_cont(c, 0.5) FROM o)) AS capacidad_m3 FROM o",
)
def clean_vehicles(t):
    vehiculos = t.vehicles.select(
        F.col("vehicle_id").cast("string").alias("id_vehiculo"), F.col("kind").alias("tipo"), F.col("capacity").cast("string").alias("capacidad_m3")
    )
    return logistics.clean_vehicles(vehiculos)


@query(
    "clean_incidents",
    "C14",
    "WITH d AS (SELECT DISTINCT incident_id, shipment_id, seen, kind, cost_text FROM {incidents}), n AS (SELECT cast(incident_id as bigint) AS id_incidencia, "
    "cast(shipment_id as bigint) AS id_envio, CASE WHEN seen LIKE '%/%' THEN cast(try_strptime(seen, '%d/%m/%Y') as date) "
    "WHEN seen LIKE '%-%' THEN cast(try_strptime(seen, '%Y-%m-%d') as date) END AS fecha, CASE WHEN kind IS NOT NULL THEN " + _TITLE_SQL.replace("{c}", "kind")
    + " END AS tipo_incidencia, try_cast(trim(replace(replace(replace(cost_text, '$', ''), '~', ''), 'aprox', '')) as double) AS c FROM d) "
    "SELECT id_incidencia, id_envio, fecha, tipo_incidencia, coalesce(c, (SELECT quantile_cont(c, 0.5) FROM n)) AS costo_impacto FROM n",
)
def clean_incidents(t):
    incidencias = t.incidents.select(
        F.col("incident_id").cast("string").alias("id_incidencia"), F.col("shipment_id").cast("string").alias("id_envio"), F.col("seen").alias("fecha"),
        F.col("kind").alias("tipo_incidencia"), F.col("cost_text").alias("costo_impacto"),
    )
    return logistics.clean_incidents(incidencias)


# --- rules ------------------------------------------------------------------------------------


@query(
    "schema_rules",
    "V1",
    "WITH t AS {shipments}, c AS (SELECT count(*) AS n, count(*) FILTER (route_id IS NULL) AS a, count(*) FILTER (weight < 5000) AS b, "
    "1 + 0 * count(*) AS d FROM t) SELECT * FROM (SELECT 'esquema_declarado:schema_global' AS \"check\", 'ADVERTENCIA' AS estado, "
    "concat(a + b + d, ' violaciones en columnas: [''route_id'', ''weight'', ''sent'']') AS detalle, a + b + d AS n_afectados, round((a + b + d) * 100.0 / n, 2) AS porcentaje FROM c "
    "UNION ALL SELECT 'esquema_declarado:route_id', 'ADVERTENCIA', concat(a, ' registros inválidos en columna ''route_id''.'), a, round(a * 100.0 / n, 2) FROM c "
    "UNION ALL SELECT 'esquema_declarado:weight', 'ADVERTENCIA', concat(b, ' registros inválidos en columna ''weight''.'), b, round(b * 100.0 / n, 2) FROM c "
    "UNION ALL SELECT 'esquema_declarado:sent', 'ADVERTENCIA', concat(d, ' registros inválidos en columna ''sent''.'), d, round(d * 100.0 / n, 2) FROM c)",
)
def schema_rules(t):
    declared = [
        rules.ColumnRule("route_id", "int", nullable=False),
        rules.ColumnRule("weight", "float", at_least=5000.0),
        rules.ColumnRule("late", "int", nullable=False, allowed=[0, 1]),
        rules.ColumnRule("sent", "date"),
    ]
    return rules.check_declared(t.shipments, declared)


_TYPES_SQL = (
    "SELECT 'esquema:shipment_id' AS \"check\", 'OK' AS estado, 'dtype actual: string | esperado: string' AS detalle, cast(0 as bigint) AS n_afectados, cast(0 as double) AS porcentaje "
    "UNION ALL SELECT 'esquema:weight', 'OK', 'dtype actual: double | esperado: double', 0, 0 "
    "UNION ALL SELECT 'esquema:route_id', 'OK', 'dtype actual: bigint | esperado: int', 0, 0 "
    "UNION ALL SELECT 'esquema:volume', 'ADVERTENCIA', 'dtype actual: double | esperado: bigint', 0, 0 "
    "UNION ALL SELECT 'esquema:absent', 'ADVERTENCIA', 'Columna ''absent'' no encontrada en el dataset.', 0, 0"
)


_EXPECTED_TYPES = {"shipment_id": "string", "weight": "double", "route_id": "int", "volume": "bigint", "absent": "int"}


def _reference_sql() -> str:
    return (
        "SELECT concat('integridad:', k) AS \"check\", CASE WHEN bad = 0 THEN 'OK' ELSE 'ERROR' END AS estado, "
        "concat(bad, '/', total, ' registros con ', k, ' no encontrado en la tabla de referencia.') AS detalle, bad AS n_afectados, "
        "round(bad * 100.0 / total, 2) AS porcentaje FROM ("
        "SELECT 'route_id' AS k, count(*) AS total, count(*) FILTER (route_id IS NULL OR NOT EXISTS (SELECT 1 FROM {routes} r WHERE r.route_id = s.route_id)) AS bad FROM {shipments} s "
        "UNION ALL SELECT 'vehicle_id', count(*), count(*) FILTER (vehicle_id IS NULL OR NOT EXISTS (SELECT 1 FROM {vehicles} v WHERE v.vehicle_id = s.vehicle_id)) FROM {shipments} s)"
    )


@query("ref_integrity", "V3", _reference_sql())
def ref_integrity(t):
    return rules.check_references(t.shipments, {"route_id": t.routes, "vehicle_id": t.vehicles})


@query(
    "orphan_examples",
    "V3",
    'SELECT route_id, count(*) AS "rows" FROM {shipments} WHERE route_id IS NOT NULL AND route_id NOT IN (SELECT route_id FROM {routes} WHERE route_id IS NOT NULL) '
    "GROUP BY route_id ORDER BY route_id LIMIT 5",
)
def orphan_examples(t):
    return rules.reference_examples(t.shipments, t.routes, "route_id")


_RANGES = {"weight": (1000.0, 100000.0), "volume": (1.0, 50.0), "discount": (0.0, 0.2)}


def _range_sql() -> str:
    parts = []
    for c, (lo, hi) in _RANGES.items():
        parts.append(
            f"SELECT '{c}' AS c, '[{lo}, {hi}]' AS r, count(*) AS n, count(*) FILTER (NOT coalesce({c} BETWEEN {lo} AND {hi}, false)) AS bad FROM {{shipments}}"
        )
    inner = " UNION ALL ".join(parts)
    return (
        "SELECT concat('rango:', c) AS \"check\", CASE WHEN bad = 0 THEN 'OK' WHEN pct < 5 THEN 'ADVERTENCIA' ELSE 'ERROR' END AS estado, "
        "concat('Rango esperado ', r, '. Fuera de rango: ', bad, ' (', pct, '%)') AS detalle, bad AS n_afectados, pct AS porcentaje "
        f"FROM (SELECT *, round(bad * 100.0 / n, 2) AS pct FROM ({inner}))"
    )


@query("range_check", "V4", _range_sql())
def range_check(t):
    return rules.check_ranges(t.shipments, _RANGES)


_CRITICAL = ["shipment_id", "route_id", "line_no", "cargo"]


def _null_rule_sql() -> str:
    parts = [f"SELECT '{c}' AS c, count(*) AS n, count(*) - count({c}) AS bad FROM {{shipments}}" for c in _CRITICAL]
    return (
        "SELECT concat('nulos:', c) AS \"check\", CASE WHEN bad = 0 THEN 'OK' ELSE 'ERROR' END AS estado, "
        "concat(bad, '/', n, ' nulos (', pct, '%) en columna crítica.') AS detalle, bad AS n_afectados, pct AS porcentaje "
        f"FROM (SELECT *, round(bad * 100.0 / n, 2) AS pct FROM ({' UNION ALL '.join(parts)}))"
    )


@query("critical_nulls", "V5", _null_rule_sql())
def critical_nulls(t):
    return rules.check_nulls(t.shipments, _CRITICAL)


def _report_sql() -> str:
    parts = [_TYPES_SQL, _reference_sql(), _range_sql(), _null_rule_sql()]
    return (
        "SELECT \"check\", estado, detalle, n_afectados, porcentaje, split_part(\"check\", ':', 1) AS categoria FROM ("
        + " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
        + ")"
    )


@query("validation_report", "V2 V6 V7", _report_sql())
def validation_report(t):
    s = t.shipments
    return rules.validation_report(
        [
            rules.check_types(s, _EXPECTED_TYPES),
            rules.check_references(s, {"route_id": t.routes, "vehicle_id": t.vehicles}),
            rules.check_ranges(s, _RANGES),
            rules.check_nulls(s, _CRITICAL),
        ]
    )


@query("rule_state_counts", "V6 N7", f"SELECT estado, count(*) AS cantidad FROM ({_report_sql()}) GROUP BY estado")
def rule_state_counts(t):
    return rules.state_counts(validation_report(t))


# --- text hygiene -------------------------------------------------------------------------------


@query(
    "latin1_text",
    "S7",
    "SELECT doc_id, regexp_replace(text, '[^\\x{00}-\\x{FF}]', '?', 'g') AS safe FROM documents",
)
def latin1_text(t):
    return t.raw("documents").select("doc_id", text.latin1_safe(F.col("text")).alias("safe"))


@query("mojibake_repair", "S6", "SELECT doc_id, text AS repaired FROM documents")
def mojibake_repair(t):
    """Damage every document by one UTF-8/latin-1 round, repair it, and get the original back."""
    docs = t.raw("documents")
    clean_text = F.col("text")
    latin = clean_text.rlike(r"^[\x{00}-\x{7F}\x{A0}-\x{FF}]*$")
    damaged = F.when(latin, F.decode(F.encode(clean_text, "UTF-8"), "ISO-8859-1")).otherwise(clean_text)
    return docs.select("doc_id", text.repair_mojibake(damaged).alias("repaired"))


@query(
    "table_inventory",
    "S9",
    "SELECT 'lineitem' AS dataset, count(*) AS filas, cast(11 as integer) AS columnas FROM lineitem UNION ALL "
    "SELECT 'orders', count(*), 6 FROM orders UNION ALL SELECT 'part', count(*), 6 FROM part UNION ALL SELECT 'events', count(*), 6 FROM events",
)
def table_inventory(t):
    return inventory({n: t.raw(n) for n in ("lineitem", "orders", "part", "events")})


@query(
    "imputation_register",
    "F6 F7",
    "WITH t AS {shipments} SELECT 'weight' AS columna, 'mediana' AS estrategia, count(*) FILTER (weight IS NULL) AS n_imputados, "
    "cast(round((SELECT quantile_cont(weight, 0.5) FROM t), 4) as string) AS valor FROM t UNION ALL "
    f"SELECT 'cargo', 'moda', count(*) FILTER (cargo IS NULL), {_mode_sql('cargo')} FROM t",
)
def imputation_register(t):
    _, numeric = prepare.impute_medians(t.shipments, ["weight", "discount"])
    _, text_register = prepare.impute_modes(t.shipments, ["cargo"])
    return numeric.unionByName(text_register)


@query("match_rates", "T6", "SELECT round(avg(CASE WHEN route_id IS NULL THEN 1 ELSE 0 END) * 100, 1) AS sin_ruta, "
       "round(avg(late) * 100, 1) AS tarde FROM {shipments}")  # fmt: skip
def match_rates(t):
    return join.match_rates(t.shipments, {"sin_ruta": F.col("route_id").isNull(), "tarde": F.col("late") == 1})
