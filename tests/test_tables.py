import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import clean, features, folds, join, metrics, prepare, profile, rules
from millrace.sources import tables


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_profile_row(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, "a")], "n double, t string")
    got = {r["columna"]: r for r in profile.table_profile(df, "d").collect()}
    assert (got["n"]["nulos"], got["n"]["pct_nulos"], got["n"]["valores_unicos"]) == (1, 33.33, 2)
    assert (got["n"]["media"], got["n"]["std"]) == (2.0, 1.4142)
    assert got["t"]["valores_unicos"] == 1 and got["t"]["min"] is None
    assert {r["columna"] for r in profile.table_profile(df, "d", approx_distinct=True).collect()} == {"n", "t"}


def test_profile_of_nested_and_zero(spark):
    df = spark.createDataFrame([([1], 0.0), ([1], -0.0), ([2], 1.0)], "a array<int>, z double")
    got = {r["columna"]: r["valores_unicos"] for r in profile.table_profile(df, "d").collect()}
    assert got == {"a": 2, "z": 2}


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "a int")
    assert profile.duplicate_rows(df).first()[0] == 1
    assert clean.drop_duplicate_rows(df).count() == 2


def test_drop_duplicates_keeps_first_order(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "t string, o int")
    assert rows(clean.drop_duplicate_rows(df, ["o"]), "o") == [("a", 1), ("b", 3)]


def test_severity_order_and_bands(spark):
    p = spark.createDataFrame(
        [("d", "a", 25.0), ("d", "b", 20.0), ("d", "c", 1.0), ("d", "e", 0.0)], "dataset string, columna string, pct_nulos double"
    )
    assert [r["nivel_criticidad"] for r in profile.severity_report([p]).collect()] == ["BAJO", "CRITICO", "MODERADO", "OK"]
    worst = [r["nivel_criticidad"] for r in profile.severity_report([p], by_severity=True).collect()]
    assert worst == ["CRITICO", "MODERADO", "BAJO", "OK"]


def test_group_median_fill_falls_back_to_global(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, "b", None), (5, None, None)], "i int, g string, v double"
    )
    assert [r[2] for r in rows(clean.fill_group_median(df, "g", "v"), "i")] == [1.0, 3.0, 2.0, 2.0, 2.0]


def test_outlier_filter_keeps_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(1000.0,), (None,)], "v double")
    kept = clean.drop_outliers(df, ["v", "absent"], 2.0)
    assert kept.count() == 11
    assert clean.drop_outliers(kept, ["v"], 2.0).count() == 11


def test_unique_by_key_takes_first(spark):
    df = spark.createDataFrame([(1, "z", 2), (1, "a", 1), (None, "q", 0), (2, None, 3)], "k int, t string, o int")
    assert rows(join.unique_by_key(df, "k", ["o"]), "k") == [(1, "a", 1), (2, None, 3)]


def test_children_in_order_of_appearance(spark):
    df = spark.createDataFrame(
        [(1, 10, "b", 2.0, 1), (1, None, "a", None, 2), (1, 11, "b", 3.0, 3), (2, None, None, None, 4), (None, 5, "c", 1.0, 5)],
        "k int, id int, t string, c double, o int",
    )
    got = join.aggregate_children(df, "k", ["o"], {"n": "id"}, {"cost": "c"}, {"kinds": "t"})
    assert rows(got, "k") == [(1, 2, 5.0, "b|a"), (2, 0, 0.0, "")]


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_left_join_with_hot_and_null_keys(spark, limit):
    fact = spark.createDataFrame([(i, 1 if i % 3 else (None if i % 2 else i % 50)) for i in range(600)], "i int, k int")
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(40)], "k int, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = {r["i"]: r["name"] for r in join.left_join_unique(fact, dim, "k").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 600
    assert all(got[r["i"]] == (f"d{r['k']}" if r["k"] is not None and r["k"] < 40 else None) for r in fact.collect())


def test_key_uniqueness(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(join.key_uniqueness(df, "k")) == [(2, 1, False)]


def test_min_max_constant_and_null(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, None), (5.0, 3.0)], "a double, b double")
    assert [r[2:] for r in rows(features.min_max(df, ["a", "b"]))] == [(0.0, 0.0), (0.0, None), (0.0, 1.0)]


def test_label_codes_and_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "i int, t string")
    assert [r[2] for r in rows(features.label_encode(df, "t", "code"), "i")] == [1, 2, 0]
    assert [r[2:] for r in rows(features.one_hot(df, "t"), "i")] == [(0, 1, 0), (0, 0, 1), (1, 0, 0)]
    many = spark.createDataFrame([(t,) for t in ("b", "aa", "aaaaaaaaz", "aaaaaaaab", "ñ", "é")], "t string")
    got = {r["t"]: r["code"] for r in features.label_encode(many, "t", "code").collect()}
    assert got == {v: i for i, v in enumerate(sorted(got))}


def test_levels_have_no_cap(spark):
    urls = spark.range(6000).selectExpr("concat('https://example.org/', id) AS t")
    got = {r["t"]: r["code"] for r in features.label_encode(urls, "t", "code").collect()}
    assert got == {v: i for i, v in enumerate(sorted(got))} and len(got) == 6000
    assert len(features.levels(urls, "t")) == 6000


def test_rules(spark):
    df = spark.createDataFrame([(1, -1.0, 0), (None, 2.0, 2), (3, None, 1)], "id bigint, w double, f int")
    declared = [
        rules.ColumnRule("id", "int", nullable=False),
        rules.ColumnRule("w", "float", at_least=0.0),
        rules.ColumnRule("f", "float", allowed=[0, 1]),
        rules.ColumnRule("gone", "int"),
    ]
    got = {r["check"]: r["n_afectados"] for r in rules.check_declared(df, declared).collect()}
    assert got == {
        "esquema_declarado:schema_global": 5, "esquema_declarado:id": 1, "esquema_declarado:w": 1,
        "esquema_declarado:f": 2, "esquema_declarado:gone": 1,
    }
    clean_df = df.where("id = 1").withColumn("w", F.lit(1.0))
    assert [r["estado"] for r in rules.check_declared(clean_df, declared[:2]).collect()] == ["OK"]
    refs = rules.check_references(df, {"id": spark.createDataFrame([(1,), (None,)], "id bigint")}).first()
    assert (refs["estado"], refs["n_afectados"], refs["porcentaje"]) == ("ERROR", 2, 66.67)
    assert rules.check_ranges(df, {"w": (0.0, 5.0)}).first()["n_afectados"] == 2
    nulls = {r["check"]: r["estado"] for r in rules.check_nulls(df, ["id", "f", "gone"]).collect()}
    assert nulls == {"nulos:id": "ERROR", "nulos:f": "OK", "nulos:gone": "ADVERTENCIA"}
    report = rules.validation_report([rules.check_nulls(df, ["id", "f", "gone"])])
    assert [r["estado"] for r in report.collect()] == ["ERROR", "ADVERTENCIA", "OK"]


def test_prepare(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, None), (3, 4.0, "a")], "i int, v double, t string")
    filled, register = prepare.impute_medians(df, ["v", "absent"])
    assert rows(register) == [("v", "mediana", 1, "3.0")] and filled.where("v is null").count() == 0
    filled, register = prepare.impute_modes(filled, ["t"])
    assert rows(register) == [("t", "moda", 1, "a")] and prepare.remaining_nulls(filled).count() == 0
    assert prepare.keep_eligible(df, {"v": (0.0, 3.0)}).count() == 1
    assert prepare.drop_prefixed(df.withColumn("x_a", F.lit(1)).withColumn("x_b", F.lit(1)), "x_", ["x_b"]).columns[-1] == "x_b"
    with pytest.raises(ValueError):
        prepare.require_target(df, "y")


def test_metrics_match_published_counts(spark):
    counts = spark.createDataFrame([(13, 132, 1, 28)], "tn bigint, fp bigint, fn bigint, tp bigint")
    r = metrics.with_rates(counts).first()
    assert [round(r[c], 4) for c in ("accuracy", "precision", "recall", "f1")] == [0.2356, 0.175, 0.9655, 0.2963]
    empty = spark.createDataFrame([(5, 0, 2, 0)], "tn bigint, fp bigint, fn bigint, tp bigint")
    assert [metrics.with_rates(empty).first()[c] for c in ("precision", "recall", "f1")] == [0.0, 0.0, 0.0]


@pytest.mark.parametrize("rows_per_bucket", [10**6, 3])
def test_auc_with_ties(spark, rows_per_bucket):
    data = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1), (0, 0.4), (1, 0.2), (0, 0.05)]
    df = spark.createDataFrame(data, "y int, s double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df, "y", "s", rows_per_bucket=rows_per_bucket).first()[0] == pytest.approx(want)
    assert metrics.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


@pytest.mark.parametrize("parts,rows_per_bucket", [(1, 10**6), (7, 20)])
def test_folds_balanced_and_stable(spark, parts, rows_per_bucket):
    df = spark.range(300).select("id", (F.col("id") % 3 == 0).cast("int").alias("y")).repartition(parts)
    got = folds.stratified_folds(df, "y", ["id"], 5, rows_per_bucket=rows_per_bucket)
    sizes = {}
    for r in got.groupBy("y", "fold").count().collect():
        sizes.setdefault(r["y"], []).append(r["count"])
    assert all(max(s) - min(s) <= 1 and len(s) == 5 for s in sizes.values())
    assert got.agg(F.sum(F.xxhash64("id", "fold").cast("decimal(38,0)"))).first()[0] == folds.stratified_folds(
        df.repartition(2), "y", ["id"], 5
    ).agg(F.sum(F.xxhash64("id", "fold").cast("decimal(38,0)"))).first()[0]


def test_holdout_parts(spark):
    df = spark.range(100).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    train, test = folds.holdout(df, ["id"], 0.2, "y")
    assert (train.count(), test.count(), test.where("y = 1").count()) == (80, 20, 5)


def test_csv_round(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("k,t,n\n1,ñandú,NA\n2,b,3.5\n".encode("latin-1"))
    assert tables.detect_encoding(spark, str(path)) == "ISO-8859-1"
    df = tables.typed_by_content(tables.read_csv(spark, str(path), encoding=None, keep_order=True))
    assert [r["t"] for r in df.orderBy("_row").collect()] == ["ñandú", "b"]
    assert dict(df.dtypes)["n"] == "double" and df.where("n is null").count() == 1
    bad = tmp_path / "b.csv"
    bad.write_text("k,t\n1,a\n2,b,c\n", encoding="utf-8")
    kept = tables.read_csv(spark, str(bad), columns=["k", "t"], keep_corrupt=True)
    assert kept.cache().where("_corrupt_record is not null").count() == 1
    out = str(tmp_path / "stage")
    tables.write_stage(df, out)
    assert tables.read_stage(spark, out).count() == 2
    tables.write_report(df.select("k", "t"), str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 2


def test_inventory_and_audit(spark):
    df = spark.createDataFrame([(1, None)], "a int, fecha_entrega date")
    assert rows(tables.inventory({"t": df})) == [("t", 1, 2)]
    audit = profile.readiness_audit(df, "t", ["fecha_entrega", "x"]).first()
    assert (audit["nulos_totales"], audit["columnas_leakage_presentes"]) == (1, "fecha_entrega")


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),)], "d date")
    assert rows(features.calendar(df, "d", {"month": "m", "weekday": "w", "quarter": "q"}).drop("d")) == [(1.0, 6.0, 1.0)]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", (F.col("id") % 50).cast("double").alias("v"), F.lit("x").alias("wide")).write.parquet(path)
    df = tables.read_stage(spark, path)
    text = plan(clean.drop_outliers(df, ["v"], 2.0).select("id"))
    assert "Or(IsNull(v)," in text and "ReadSchema: struct<id:bigint,v:double>" in text
    text = plan(prepare.keep_eligible(df, {"v": (1.0, 5.0)}).select("id"))
    assert "GreaterThanOrEqual(v,1.0)" in text and "LessThanOrEqual(v,5.0)" in text


def test_no_cross_join_in_star_plan(spark):
    import __spark_entry__ as contract

    text = plan(contract.entry(spark))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_join_refuses_a_repeated_key(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "i int, k string")
    once = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert {r["i"]: r["v"] for r in join.left_join_unique(fact, once, "k").collect()} == {1: 1, 2: None, 3: None}
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="not unique"):
        join.left_join_unique(fact, twice, "k").collect()


def test_csv_keeps_quotes_and_breaks_inside_cells(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('a,b\n"x ""y"" z",1\n"line\nbreak",2\n', encoding="utf-8")
    rows = tables.read_csv(spark, str(path), multi_line=True).collect()
    assert [(r["a"], r["b"]) for r in rows] == [('x "y" z', "1"), ("line\nbreak", "2")]


def test_charset_probe(spark, tmp_path):
    (tmp_path / "utf.csv").write_bytes("a\nreplacement � char\n".encode())
    (tmp_path / "latin.csv").write_bytes("a\nPucón\n".encode("latin-1"))
    assert tables.detect_encoding(spark, str(tmp_path / "utf.csv")) == "UTF-8"
    assert tables.detect_encoding(spark, str(tmp_path / "latin.csv")) == "ISO-8859-1"


def test_holdout_sizes(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 4 = 0 as int) AS y")
    for size in (0.2, 0.3, 0.4):
        train, held = folds.holdout(df, ["id"], size, "y")
        assert held.count() == math.ceil(750 * size) + math.ceil(250 * size)
        assert train.count() + held.count() == 1000 and train.join(held, "id").count() == 0
    assert folds.holdout(df, ["id"], 0.3)[1].count() == 300
