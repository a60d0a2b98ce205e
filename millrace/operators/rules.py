"""Validation rules whose outcome is a table: schema, integrity, ranges, nulls, summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import outside
from millrace.operators.join import orphan_keys
from millrace.operators.profile import percent
from millrace.session import col, stage

# States of a rule, in reporting order. The Spanish result texts below are fixed too.
ERROR, WARNING, OK = "ERROR", "ADVERTENCIA", "OK"
RESULT_SCHEMA = "check string, estado string, detalle string, n_afectados bigint, porcentaje double"
RESULT_COLUMNS = ("check", "estado", "detalle", "n_afectados", "porcentaje")


@dataclass(frozen=True)
class ColumnRule:
    """Declared shape of one column: type family, nullability, bounds, allowed values."""

    name: str
    kind: str | None = None
    nullable: bool = True
    at_least: float | None = None
    allowed: Sequence | None = field(default=None)


# Type families by their Spark names; ``int`` and ``float`` accept any width.
_KINDS = {
    "int": ("tinyint", "smallint", "int", "bigint"),
    "float": ("float", "double"),
    "string": ("string",),
    "date": ("date", "timestamp", "timestamp_ntz"),
}


def _result(check: Column, state: Column, detail: Column, affected: Column, pct: Column) -> Column:
    return F.struct(
        check.alias("check"),
        state.alias("estado"),
        detail.alias("detalle"),
        affected.cast("bigint").alias("n_afectados"),
        pct.cast("double").alias("porcentaje"),
    )


def _text(c: Column) -> Column:
    return c.cast("string")


def check_declared(df: DataFrame, rules: Sequence[ColumnRule], check: str = "esquema_declarado") -> DataFrame:
    """All violations of a declared schema in one pass: a global row, then one per failing column.

    A wrong type or an absent column is one violation; a broken null rule or
    value rule is one violation per row.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, parts = [F.count(F.lit(1)).alias("n")], []
    for i, r in enumerate(rules):
        if r.name not in types:
            parts.append((r.name, F.lit(1)))
            continue
        fixed = 0 if r.kind is None or types[r.name] in _KINDS[r.kind] else 1
        broken = []
        c = col(r.name)
        if not r.nullable:
            broken.append(F.count_if(c.isNull()))
        if r.at_least is not None:
            broken.append(F.count_if(c < F.lit(r.at_least)))
        if r.allowed is not None:
            broken.append(F.count_if(~c.isin(list(r.allowed))))
        total = F.lit(fixed)
        for b in broken:
            total = total + b
        aggs.append(total.cast("bigint").alias(f"b{i}"))
        parts.append((r.name, F.col(f"b{i}")))
    every = F.lit(0)
    for _, n in parts:
        every = every + n
    names = F.array_join(
        F.filter(F.array(*[F.when(n > 0, F.concat(F.lit("'"), F.lit(c), F.lit("'"))) for c, n in parts]), lambda x: x.isNotNull()),
        ", ",
    )
    head = _result(
        F.lit(f"{check}:schema_global"),
        F.when(every == 0, OK).otherwise(WARNING),
        F.when(every == 0, "esquema cumplido en todas las columnas definidas").otherwise(
            F.concat(_text(every), F.lit(" violaciones en columnas: ["), names, F.lit("]"))
        ),
        every,
        percent(every, F.greatest(F.col("n"), F.lit(1))),
    )
    rest = [
        _result(
            F.lit(f"{check}:{c}"),
            F.lit(WARNING),
            F.concat(_text(n), F.lit(f" registros inválidos en columna '{c}'.")),
            n,
            percent(n, F.greatest(F.col("n"), F.lit(1))),
        )
        for c, n in parts
    ]
    rows = df.agg(*aggs).select(F.posexplode(F.array(head, *rest)).alias("pos", "r"))
    return rows.where((F.col("pos") == 0) | (F.col("r.n_afectados") > 0)).select("r.*")


def check_types(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Type names against expected ones; a match is containment either way, an absent column a warning."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for c, want in expected.items():
        if c not in types:
            rows.append((f"esquema:{c}", WARNING, f"Columna '{c}' no encontrada en el dataset.", 0, 0.0))
            continue
        have = types[c]
        ok = want.lower() in have.lower() or have.lower() in want.lower()
        rows.append((f"esquema:{c}", OK if ok else WARNING, f"dtype actual: {have} | esperado: {want}", 0, 0.0))
    return df.sparkSession.createDataFrame(rows, RESULT_SCHEMA)


def check_references(df: DataFrame, references: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose key is missing from its reference table; a null key counts as missing.

    One scan of the fact table counts the rows of every key of all references (grouping sets); anti joins
    then meet one row per key, so neither hot nor null keys pile up.
    """
    checks = [(c, ref) for c, ref in references.items() if c in df.columns and c in ref.columns]
    if not checks:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    names = [f"k{i}" for i in range(len(checks))]
    keys = df.select(*[col(c).alias(n) for n, (c, _) in zip(names, checks)])
    counts = keys.groupingSets([[n] for n in names], *names).agg(F.count(F.lit(1)).alias("rows"), F.grouping_id().alias("of"))
    counts = stage(counts, "reference-keys")
    out = None
    for i, (c, ref) in enumerate(checks):
        own = counts.where(F.col("of") == (1 << len(checks)) - 1 - (1 << (len(checks) - 1 - i))).select(names[i], "rows")
        totals = own.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(F.col(names[i]).isNull(), F.col("rows"))), F.lit(0)).alias("bad"))
        there = ref.select(col(c).alias(names[i])).where(F.col(names[i]).isNotNull()).distinct()
        orphans = own.where(F.col(names[i]).isNotNull()).join(there, names[i], "left_anti").agg(F.lit(0).cast("bigint").alias("total"), F.coalesce(F.sum("rows"), F.lit(0)).alias("bad"))
        both = totals.unionByName(orphans).agg(F.sum("total").alias("total"), F.sum("bad").alias("bad"))
        row = both.select(
            _result(
                F.lit(f"integridad:{c}"),
                F.when(F.col("bad") == 0, OK).otherwise(ERROR),
                F.concat(_text(F.col("bad")), F.lit("/"), _text(F.col("total")), F.lit(f" registros con {c} no encontrado en la tabla de referencia.")),
                F.col("bad"),
                percent(F.col("bad"), F.col("total")),
            ).alias("r")
        ).select("r.*")
        out = row if out is None else out.unionByName(row)
    return out


def reference_examples(df: DataFrame, reference: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first orphan keys in key order, as examples for a reader."""
    return orphan_keys(df, reference, key).orderBy(col(key)).limit(n)


def check_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows outside [low, high]; missing counts as outside. 0 is OK, under 5 % a warning, else an error."""
    usable = {c: r for c, r in ranges.items() if c in df.columns}
    if not usable:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(outside(col(c), *r)).alias(f"b{i}") for i, (c, r) in enumerate(usable.items())]
    rows = []
    for i, (c, (low, high)) in enumerate(usable.items()):
        bad, pct = F.col(f"b{i}"), percent(F.col(f"b{i}"), F.col("n"))
        rows.append(
            _result(
                F.lit(f"rango:{c}"),
                F.when(bad == 0, OK).when(pct < 5, WARNING).otherwise(ERROR),
                F.concat(F.lit(f"Rango esperado [{low}, {high}]. Fuera de rango: "), _text(bad), F.lit(" ("), _text(pct), F.lit("%)")),
                bad,
                pct,
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def check_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls in columns that must not have any; an absent column is a warning."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(col(c).isNull()).alias(f"b{i}") for i, c in enumerate(columns) if c in df.columns]
    rows = []
    for i, c in enumerate(columns):
        if c not in df.columns:
            rows.append(_result(F.lit(f"nulos:{c}"), F.lit(WARNING), F.lit(f"Columna '{c}' no encontrada."), F.lit(0), F.lit(0.0)))
            continue
        bad, pct = F.col(f"b{i}"), percent(F.col(f"b{i}"), F.col("n"))
        detail = F.concat(_text(bad), F.lit("/"), _text(F.col("n")), F.lit(" nulos ("), _text(pct), F.lit("%) en columna crítica."))
        rows.append(_result(F.lit(f"nulos:{c}"), F.when(bad == 0, OK).otherwise(ERROR), detail, bad, pct))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def validation_report(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack results, add the category (text before the colon), errors first."""
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    rank = F.when(F.col("estado") == ERROR, 0).when(F.col("estado") == WARNING, 1).otherwise(2)
    return report.withColumn("categoria", F.substring_index("check", ":", 1)).orderBy(rank, "check")


def state_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("estado").agg(F.count("check").alias("cantidad"))
