"""Join, derivation and training-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import numbers, text
from millrace.operators import clean, features, folds, join, prepare
from millrace.sources.tables import keep_for_reuse
from millrace.workload.base import query

_DIM_ORDER = ["origin", "km", "toll", "road"]
_FIRST_ROUTE = (
    "SELECT route_id, origin, km, toll, road FROM (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY origin NULLS FIRST, "
    "km NULLS FIRST, toll NULLS FIRST, road NULLS FIRST) AS rn FROM {routes} WHERE route_id IS NOT NULL) WHERE rn = 1"
)
_LOW = "CASE WHEN kind IS NOT NULL THEN lower(trim(kind)) END"


@query("unique_dim", "T1", _FIRST_ROUTE)
def unique_dim(t):
    return join.unique_by_key(t.routes, "route_id", _DIM_ORDER)


@query(
    "key_uniqueness",
    "T3",
    'SELECT count(route_id) AS keys, count(DISTINCT route_id) AS distinct_keys, count(route_id) = count(DISTINCT route_id) AS "unique" FROM {routes}',
)
def key_uniqueness(t):
    return join.key_uniqueness(t.routes, "route_id")


def _children(t, sort_list=False):
    kids = t.incidents.withColumn("kind", F.lower(text.strip(F.col("kind"))))
    return join.aggregate_children(
        kids,
        "shipment_id",
        ["rank"],
        count={"total_incidencias": "incident_id"},
        total={"costo_impacto_total": "cost"},
        listed={"tipos_incidencia": "kind"},
        sort_list=sort_list,
    )


_CHILD_SQL = (
    "SELECT shipment_id, cast(sum(c) as bigint) AS total_incidencias, round(coalesce(sum(s), 0), 2) AS costo_impacto_total, "
    "coalesce(string_agg(kind, '|' ORDER BY f) FILTER (kind IS NOT NULL), '') AS tipos_incidencia FROM ("
    f"SELECT shipment_id, {_LOW} AS kind, count(incident_id) AS c, sum(cost) AS s, min(rank) AS f FROM {{incidents}} "
    f"WHERE shipment_id IS NOT NULL GROUP BY shipment_id, {_LOW}) GROUP BY shipment_id"
)


@query("child_agg", "T2", _CHILD_SQL)
def child_agg(t):
    return _children(t).withColumn("costo_impacto_total", F.round("costo_impacto_total", 2))


@query("child_agg_sorted", "T2", _CHILD_SQL.replace("ORDER BY f", "ORDER BY kind"))
def child_agg_sorted(t):
    return _children(t, sort_list=True).withColumn("costo_impacto_total", F.round("costo_impacto_total", 2))


_SHIP_ID = "CASE WHEN cast(shipment_id as double) > 0 THEN cast(cast(shipment_id as double) as bigint) END"


def _master(t):
    ships = clean.clean_ids(t.shipments, ["shipment_id"], positive_only=True)
    ships = ships.select("shipment_id", "line_no", "route_id", "vehicle_id", "weight", "volume")
    routes = join.unique_by_key(t.routes, "route_id", _DIM_ORDER)
    vehicles = join.unique_by_key(t.vehicles, "vehicle_id", ["kind", "capacity"])
    children = _children(t)
    # The table that adds least comes first and the widest last, so no shuffle carries the texts of the routes.
    out = join.left_join_unique(ships, children, "shipment_id")
    out = join.left_join_unique(out, vehicles, "vehicle_id")
    out = join.left_join_unique(out, routes, "route_id")
    keys = ["shipment_id", "vehicle_id", "route_id"]
    out = out.select(*keys, *[c for part in (ships, routes, vehicles, children) for c in part.columns if c not in keys])
    out = join.fill_defaults(
        out, {"total_incidencias": 0, "costo_impacto_total": 0.0, "tipos_incidencia": "Sin Incidencia"}
    )
    return features.count_flag(out, "total_incidencias", "tiene_incidencia")


_MASTER_SQL = (
    f"WITH s AS (SELECT {_SHIP_ID} AS shipment_id, line_no, route_id, vehicle_id, weight, volume FROM {{shipments}}), "
    f"r AS ({_FIRST_ROUTE}), k AS ({_CHILD_SQL}) "
    "SELECT s.shipment_id, line_no, s.route_id, s.vehicle_id, weight, volume, origin, km, toll, road, kind, capacity, "
    "coalesce(total_incidencias, 0) AS total_incidencias, round(coalesce(costo_impacto_total, 0.0), 2) AS costo_impacto_total, "
    "coalesce(tipos_incidencia, 'Sin Incidencia') AS tipos_incidencia, cast(coalesce(total_incidencias, 0) > 0 as integer) AS tiene_incidencia "
    "FROM s LEFT JOIN r ON s.route_id = r.route_id LEFT JOIN {vehicles} v ON s.vehicle_id = v.vehicle_id LEFT JOIN k ON s.shipment_id = k.shipment_id"
)


@query("star_join", "T3 T4 T5 T9 T13", _MASTER_SQL)
def star_join(t):
    return _master(t).withColumn("costo_impacto_total", F.round("costo_impacto_total", 2))


@query(
    "incident_rate",
    "T6 T9",
    "SELECT road, count(*) AS n_envios, round(avg(tiene_incidencia), 6) AS tasa_incidencia, round(sum(costo_impacto_total), 2) AS costo "
    f"FROM ({_MASTER_SQL}) GROUP BY road",
)
def incident_rate(t):
    return (
        _master(t)
        .groupBy("road")
        .agg(
            F.count(F.lit(1)).alias("n_envios"),
            F.round(F.avg("tiene_incidencia"), 6).alias("tasa_incidencia"),
            F.round(F.sum("costo_impacto_total"), 2).alias("costo"),
        )
    )


@query(
    "transit_days",
    "T7",
    "SELECT order_id, line_no, ordered, shipped, cast(CASE WHEN ordered IS NOT NULL AND shipped IS NOT NULL THEN "
    "least(greatest(date_diff('day', ordered, shipped), 0), 60) END as integer) AS days FROM {trips}",
)
def transit_days(t):
    return features.duration_days(t.trips.drop("amount"), "ordered", "shipped", "days")


@query(
    "safe_ratio",
    "T8",
    "SELECT route_id, origin, km, toll, road, round(toll / nullif(km, 0), 6) AS costo_por_km FROM {routes}",
)
def safe_ratio(t):
    return features.ratios(t.routes, {"costo_por_km": ("toll", "km")}).withColumn("costo_por_km", F.round("costo_por_km", 6))


@query(
    "minmax_scale",
    "T12",
    "WITH t AS (SELECT shipment_id, line_no, weight, volume FROM {shipments}) SELECT *, "
    "round((weight - (SELECT min(weight) FROM t)) / ((SELECT max(weight) FROM t) - (SELECT min(weight) FROM t)), 6) AS weight_norm, "
    "round((volume - (SELECT min(volume) FROM t)) / ((SELECT max(volume) FROM t) - (SELECT min(volume) FROM t)), 6) AS volume_norm FROM t",
)
def minmax_scale(t):
    out = features.min_max(t.shipments.select("shipment_id", "line_no", "weight", "volume"), ["weight", "volume"])
    return out.withColumns({c: F.round(c, 6) for c in ("weight_norm", "volume_norm")})


@query(
    "label_encode",
    "T11",
    "SELECT road, cast(dense_rank() OVER (ORDER BY coalesce(road, 'nan')) - 1 as integer) AS road_encoded FROM {routes}",
)
def label_encode(t):
    return features.label_encode(t.routes, "road", "road_encoded").select("road", "road_encoded")


@query(
    "onehot",
    "T10",
    "SELECT p_partkey, p_type, "
    + ", ".join(
        f"cast(p_type = '{v}' as integer) AS p_type_{v}" for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    )
    + " FROM part",
)
def onehot(t):
    return features.one_hot(t.raw("part").select("p_partkey", "p_type"), "p_type")


@query(
    "calendar_features",
    "F5",
    "SELECT o_orderkey, cast(month(o_orderdate) as double) AS mes_envio, cast(isodow(o_orderdate) - 1 as double) AS dia_semana_envio, "
    "cast(quarter(o_orderdate) as double) AS trimestre_envio FROM orders",
)
def calendar_features(t):
    names = {"month": "mes_envio", "weekday": "dia_semana_envio", "quarter": "trimestre_envio"}
    return features.calendar(t.raw("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", names).drop("o_orderdate")


_ELIGIBLE = {"weight": (1000.0, 100000.0), "volume": (2.0, 49.0)}
_ELIGIBLE_SQL = "coalesce(weight BETWEEN 1000 AND 100000, false) AND coalesce(volume BETWEEN 2 AND 49, false)"


@query(
    "range_eligible",
    "F8",
    f"SELECT shipment_id, line_no, weight, volume FROM {{shipments}} WHERE {_ELIGIBLE_SQL}",
)
def range_eligible(t):
    return prepare.keep_eligible(t.shipments.select("shipment_id", "line_no", "weight", "volume"), _ELIGIBLE)


@query(
    "eligibility_counts",
    "F8",
    "SELECT 'weight' AS regla, count(*) FILTER (NOT coalesce(weight BETWEEN 1000 AND 100000, false)) AS fuera FROM {shipments} UNION ALL "
    "SELECT 'volume', count(*) FILTER (NOT coalesce(volume BETWEEN 2 AND 49, false)) FROM {shipments} UNION ALL "
    f"SELECT 'total', count(*) FILTER (NOT ({_ELIGIBLE_SQL})) FROM {{shipments}}",
)
def eligibility_counts(t):
    return prepare.eligibility_counts(t.shipments, _ELIGIBLE)


@query(
    "remaining_nulls",
    "F9",
    "SELECT * FROM (SELECT 'route_id' AS columna, count(*) FILTER (route_id IS NULL) AS nulos FROM {routes} UNION ALL "
    "SELECT 'origin', count(*) FILTER (origin IS NULL) FROM {routes} UNION ALL SELECT 'km', count(*) FILTER (km IS NULL) FROM {routes} "
    "UNION ALL SELECT 'toll', count(*) FILTER (toll IS NULL) FROM {routes} UNION ALL SELECT 'road', count(*) FILTER (road IS NULL) FROM {routes}) WHERE nulos > 0",
)
def remaining_nulls(t):
    return prepare.remaining_nulls(t.routes)


@query(
    "ml_table",
    "F1 F2 F3 F4 F6 F7 F10",
    f"WITH s AS (SELECT {_SHIP_ID} AS id_envio, line_no, route_id, weight AS peso, volume AS volumen, cargo, late FROM {{shipments}}), "
    "b AS (SELECT * FROM s WHERE id_envio IS NOT NULL), "
    "m AS (SELECT quantile_cont(peso, 0.5) AS pm, quantile_cont(volumen, 0.5) AS vm FROM b), "
    "c AS (SELECT cargo AS cm FROM b WHERE cargo IS NOT NULL GROUP BY cargo ORDER BY count(*) DESC, cargo LIMIT 1), "
    "r AS (SELECT route_id AS rm FROM b WHERE route_id IS NOT NULL GROUP BY route_id ORDER BY count(*) DESC, route_id LIMIT 1) "
    "SELECT id_envio, line_no, coalesce(route_id, rm) AS route_id, coalesce(peso, pm) AS peso, coalesce(volumen, vm) AS volumen, coalesce(cargo, cm) AS cargo, late "
    "FROM b, m, c, r WHERE coalesce(peso, pm) BETWEEN 1000 AND 100000",
)
def ml_table(t):
    df = clean.clean_ids(t.shipments, ["shipment_id"], positive_only=True)
    df = df.withColumns({"tipo_carga_a": F.lit(1), "costo_total": F.lit(0.0)})
    df = df.withColumnRenamed("weight", "peso")
    df = prepare.rename_by_fragment(df, "shipment", "id_envio")
    df = prepare.rename_by_fragment(df, "volum", "volumen")
    df = prepare.keep_identified(df, "id_envio")
    df = prepare.drop_columns(df, ["costo_total", "not_there", "vehicle_id", "sent", "weight_text", "discount"])
    df = keep_for_reuse(prepare.drop_prefixed(df, "tipo_carga_", keep=["tipo_carga_norm"]))
    df, _ = prepare.impute_medians(df, ["peso", "volumen"])
    df, _ = prepare.impute_modes(df, ["cargo", "route_id"])
    return prepare.keep_eligible(df, {"peso": (1000.0, 100000.0)})


@query(
    "binary_balance",
    "F11",
    "SELECT count(*) AS filas, cast(sum(late) as bigint) AS positivos, cast(count(*) - sum(late) as bigint) AS negativos, "
    "round(sum(late) * 100.0 / count(*), 2) AS pct_positivos, sum(late) * 100.0 / count(*) < 10 OR sum(late) * 100.0 / count(*) > 90 AS desbalance FROM {shipments}",
)
def binary_balance(t):
    return prepare.binary_balance(t.shipments, "late")


@query(
    "target_stats",
    "F12",
    "SELECT count(*) AS filas, round(avg(d), 4) AS media, quantile_cont(d, 0.5) AS mediana, round(stddev_samp(d), 4) AS std FROM ("
    "SELECT least(greatest(date_diff('day', ordered, shipped), 0), 60) AS d FROM {trips} WHERE shipped IS NOT NULL)",
)
def target_stats(t):
    days = features.duration_days(t.trips, "ordered", "shipped", "d").select("d")
    return prepare.target_summary(days, "d").withColumns({c: F.round(c, 4) for c in ("media", "std")})


@query(
    "trace_report",
    "F13 S7",
    "WITH t AS {shipments} SELECT 'general' AS seccion, 'filas_original' AS item, cast(count(*) as string) AS valor, 'Filas de partida' AS detalle FROM t "
    "UNION ALL SELECT 'general', 'filas_id_nulo', cast(count(*) FILTER (shipment_id IS NULL) as string), 'Registros no identificables' FROM t "
    "UNION ALL SELECT 'clasificacion', 'balance_clases', concat(cast(sum(late) as bigint), ' positivos / ', cast(count(*) - sum(late) as bigint), ' negativos'), 'Balance de clases' FROM t "
    "UNION ALL SELECT 'leakage_eliminado', 'discount', 'EXCLUIDA', 'Derivada del evento ?'",
)
def trace_report(t):
    s = t.shipments
    counted = s.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("shipment_id").isNull()).alias("gone"), F.sum("late").alias("pos")
    )
    lines = [
        ("general", "filas_original", F.col("n").cast("string"), "Filas de partida"),
        ("general", "filas_id_nulo", F.col("gone").cast("string"), "Registros no identificables"),
        (
            "clasificacion",
            "balance_clases",
            F.format_string("%d positivos / %d negativos", F.col("pos"), F.col("n") - F.col("pos")),
            "Balance de clases",
        ),
    ]
    rows = [
        F.struct(F.lit(a).alias("seccion"), F.lit(b).alias("item"), v.alias("valor"), F.lit(d).alias("detalle"))
        for a, b, v, d in lines
    ]
    measured = counted.select(F.inline(F.array(*rows)))
    fixed = prepare.trace_rows(t.spark, [("leakage_eliminado", "discount", "EXCLUIDA", "Derivada del evento →")])
    return measured.unionByName(fixed)


@query(
    "strat_folds",
    "Q1",
    "SELECT event_type, event_id, cast((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) % 5 as integer) AS fold FROM events",
)
def strat_folds(t):
    rows = t.raw("events").select("event_type", "event_id")
    return folds.stratified_folds(rows, "event_type", ["event_id"], 5, seed=None)


@query("plain_folds", "Q2")
def plain_folds(t):
    marked = folds.hashed_folds(t.raw("orders").select("o_orderkey"), ["o_orderkey"], 5, 42)
    return marked.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("holdout_split", "Q3")
def holdout_split(t):
    rows = t.raw("events").select("event_type", "event_id")
    train, test = folds.holdout(rows, ["event_id"], 0.2, "event_type")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "melt",
    "N1",
    "SELECT r, variable, round(valor, 6) AS valor FROM (SELECT p_type AS r, avg(p_size) AS avg_size, avg(p_retailprice) AS avg_price FROM part GROUP BY 1) "
    "UNPIVOT (valor FOR variable IN (avg_size, avg_price))",
)
def melt(t):
    wide = t.raw("part").groupBy(F.col("p_type").alias("r")).agg(
        F.avg("p_size").alias("avg_size"), F.avg("p_retailprice").alias("avg_price")
    )
    return wide.unpivot(["r"], ["avg_size", "avg_price"], "variable", "valor").select("r", "variable", F.round("valor", 6).alias("valor"))


@query(
    "days_flag_ratio",
    "T7 T9",
    "SELECT ordered, count(*) AS n, cast(sum(CASE WHEN date_diff('day', ordered, shipped) > 0 THEN 1 ELSE 0 END) as bigint) AS with_delay FROM {trips} "
    "WHERE shipped IS NOT NULL GROUP BY ordered",
)
def days_flag_ratio(t):
    days = features.duration_days(t.trips, "ordered", "shipped", "d").where(F.col("shipped").isNotNull())
    flagged = days.withColumn("late", numbers.flag(F.col("d")))
    return flagged.groupBy("ordered").agg(F.count(F.lit(1)).alias("n"), F.sum("late").alias("with_delay"))
