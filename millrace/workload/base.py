"""Query registry, table access, and the expressions that make clean test tables dirty.

The test tables have no nulls, padding or mixed formats, so the queries first
derive dirty ones. A derivation is a plain list of SQL expressions that both
engines read; what is under test (the operator) is written twice, on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    ids: str
    build: Callable[[Tables], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register ``build(tables)`` under a name with its inventory ids and oracle SQL.

    ``{shipments}`` and the other derived names in the SQL are replaced by
    their derivation.
    """

    def register(build):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        text = sql
        if text is not None:
            for table in DERIVED:
                text = text.replace("{" + table + "}", derived_sql(table))
        REGISTRY[name] = Query(name, ids, build, text)
        return build

    return register


def _ddmmyyyy(c: str) -> str:
    return f"concat(lpad(cast(day({c}) as string), 2, '0'), '/', lpad(cast(month({c}) as string), 2, '0'), '/', cast(year({c}) as string))"


def _iso(c: str) -> str:
    return f"concat(cast(year({c}) as string), '-', lpad(cast(month({c}) as string), 2, '0'), '-', lpad(cast(day({c}) as string), 2, '0'))"


def _money(c: str) -> str:
    return f"cast(cast({c} as decimal(18,2)) as string)"


_CARGO = "CASE l_returnflag WHEN 'A' THEN 'dry-bulk goods' WHEN 'N' THEN 'Frozen food' ELSE 'machine parts' END"
_KIND = "CASE s_nationkey % 4 WHEN 0 THEN 'van' WHEN 1 THEN 'pickup truck' WHEN 2 THEN 'semi-trailer' ELSE 'box van' END"


def _messy(value: str, turn: str, gone: str) -> str:
    return (
        f"CASE WHEN {gone} THEN NULL WHEN {turn} % 4 = 0 THEN upper({value}) "
        f"WHEN {turn} % 4 = 1 THEN concat('  ', {value}, ' ') WHEN {turn} % 4 = 2 THEN lower({value}) ELSE {value} END"
    )


# name -> (source tables, join condition, extra copies, {column: expression})
DERIVED: dict[str, dict] = {
    "shipments": {
        "source": "lineitem",
        "columns": {
            "shipment_id": "CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 41 = 0 THEN concat('-', cast(l_orderkey as string)) "
            "ELSE concat(cast(l_orderkey as string), '.0') END",
            "line_no": "l_linenumber",
            "route_id": "CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN l_partkey + 1000000 ELSE l_partkey END",
            "vehicle_id": "CASE WHEN l_quantity = 13 THEN NULL ELSE l_suppkey END",
            "sent": f"CASE WHEN l_suppkey % 13 = 0 THEN ' ' WHEN l_linenumber % 2 = 0 THEN {_ddmmyyyy('l_shipdate')} ELSE {_iso('l_shipdate')} END",
            "cargo": _messy(_CARGO, "l_linenumber", "l_suppkey % 11 = 0"),
            "weight_text": "CASE WHEN l_partkey % 23 = 0 THEN 'n/a' WHEN l_partkey % 29 = 0 THEN '' "
            f"WHEN l_orderkey % 97 = 0 THEN {_money('l_extendedprice * 40')} ELSE concat(' ', {_money('l_extendedprice')}) END",
            "weight": "CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 40 ELSE l_extendedprice END",
            "volume": "CASE WHEN l_tax = 0.03 THEN NULL ELSE l_quantity END",
            "discount": "l_discount",
            "late": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
        },
    },
    "trips": {
        "source": "lineitem",
        "join": ("orders", "l_orderkey", "o_orderkey"),
        "columns": {
            "order_id": "l_orderkey",
            "line_no": "l_linenumber",
            "ordered": "cast(o_orderdate as date)",
            "shipped": "CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE cast(l_shipdate as date) END",
            "amount": "l_extendedprice",
        },
    },
    "routes": {
        "source": "part",
        "again": "p_size > 45",
        "columns": {
            "route_id": "CASE WHEN p_size = 50 THEN NULL ELSE p_partkey END",
            "origin": "CASE WHEN p_size = 3 THEN NULL ELSE p_brand END",
            "km": "CASE WHEN p_size = 11 THEN NULL WHEN p_size = 12 THEN cast(0 as double) ELSE p_retailprice END",
            "toll": "p_retailprice * p_size",
            "road": _messy("p_type", "p_partkey", "p_size = 7"),
        },
    },
    "vehicles": {
        "source": "supplier",
        "columns": {
            "vehicle_id": "s_suppkey",
            "kind": _messy(_KIND, "s_suppkey", "s_nationkey = 24"),
            "capacity": "CASE WHEN s_suppkey % 6 = 0 THEN NULL WHEN s_suppkey % 14 = 1 THEN cast(0 as double) ELSE s_acctbal END",
        },
    },
    "incidents": {
        "source": "events",
        "columns": {
            "incident_id": "CASE WHEN value < 4 THEN NULL ELSE event_id END",
            "shipment_id": "CASE WHEN event_type = 'signup' AND value > 60 THEN NULL ELSE user_id * 100 END",
            "seen": f"CASE WHEN event_type = 'error' AND value > 50 THEN 'NaT' WHEN value < 30 THEN {_ddmmyyyy('ts')} ELSE {_iso('ts')} END",
            "kind": _messy("event_type", "event_id", "value < 2"),
            "cost_text": f"CASE WHEN event_id % 10 = 0 THEN concat('$', {_money('value')}) WHEN event_id % 10 = 1 THEN concat('~', {_money('value')}) "
            f"WHEN event_id % 10 = 2 THEN concat({_money('value')}, ' aprox') WHEN event_id % 10 = 3 THEN NULL ELSE {_money('value')} END",
            "cost": "CASE WHEN event_id % 10 = 3 THEN NULL ELSE value END",
            "rank": "event_id",
        },
    },
}


def derived_sql(name: str) -> str:
    spec = DERIVED[name]
    cols = ", ".join(f"{e} AS {n}" for n, e in spec["columns"].items())
    source = spec["source"]
    if "join" in spec:
        other, a, b = spec["join"]
        source = f"{source} JOIN {other} ON {a} = {b}"
    text = f"SELECT {cols} FROM {source}"
    if "again" in spec:
        text += f" UNION ALL SELECT {cols} FROM {source} WHERE {spec['again']}"
    return f"({text})"


class Tables:
    """Reads the parquet tables of one folder and derives the dirty ones."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derived(self, name: str) -> DataFrame:
        spec = DERIVED[name]
        df = self.raw(spec["source"])
        if "join" in spec:
            other, a, b = spec["join"]
            right = self.raw(other)
            df = df.join(right, df[a] == right[b])
        exprs = [f"{e} AS {n}" for n, e in spec["columns"].items()]
        out = df.selectExpr(*exprs)
        if "again" in spec:
            out = out.unionByName(df.where(spec["again"]).selectExpr(*exprs))
        return out

    def __getattr__(self, name: str) -> DataFrame:
        if name in DERIVED:
            return self.derived(name)
        raise AttributeError(name)
