import datetime as dt
import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillmark import schema, session
from tillmark.operators import cleaning, features, missing, outliers
from tillmark.plans import stages
from tillmark.sources import csv

HEADER = "FECHA;CANAL;SKU;PRODUCTO;UNIDADES;PORCENTAJE DESCUENTO;MONTO APLICADO;BOLETA;LOCAL;CODIGO CLIENTE;RUN CLIENTE;NOMBRES;APELLIDOS;FECHA NACIMIENTO;GENERO"
LINES = [
    '"2024-05-04 10:00:00+00:00";"APP";"1";"a";"2";"0.1";"100";"1";"7";"c1";"r1";"N";"A";"1980-01-01";"2"',
    '"2024-05-05T22:00:00-03:00";"web";"x";"b";"1";"";"50";"1";"7";"c2";"r2";"N";"A";"";"1"',
    '"nonsense";"APP";"1";"a";"2";"0.1";"100";"2";"7";"c1";"r1";"N";"A";"1980-01-01";"2"',
    '"2024-05-06";"APP";"1";"a";"0";"0.1";"100";"2";"7";"c1";"r1";"N";"A";"1980-01-01";"2"',
    '"2024-05-06";"APP";"1";"a";"1";"0.1";"-1";"2";"7";"c1";"r1";"N";"A";"1980-01-01";"2"',
    '"2024-05-06";"APP";"1";"a";"1";"0.1";"0";"0";"7";"c1";"r1";"N";"A";"1980-01-01";"2"',
    '"2024-05-06";"APP";"1";"a";"1";"1.17";"10";"3";"7";"c1";"r1";"N";"A";"1980-01-01";"2"',
    '"2024-05-06 12:30:00";"POS";"3";"c";"1";"1";"0";"4";"nan";"";"r1";"N";"A";"2000-01-01";"NaN"',
]


@pytest.fixture(scope="module")
def sales_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "ventas.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n", encoding="utf-8")
    return str(path)


def test_separator(spark, tmp_path, sales_file):
    assert csv.detect_separator(spark, sales_file) == ";"
    other = tmp_path / "x.csv"
    other.write_text("a,b;c,d\n1,2;3,4\n")
    assert csv.detect_separator(spark, str(other)) == ","


def test_scan_drops_names_and_caps_rows(spark, sales_file):
    df = csv.read_sales_csv(spark, sales_file)
    assert df.columns == schema.expected_columns()
    assert csv.missing_columns(df.columns) == []
    assert csv.missing_columns(["FECHA"])[:2] == ["CANAL", "SKU"]
    assert df.count() == 8
    assert csv.read_sales_csv(spark, sales_file, n_rows=3).count() == 3
    assert csv.read_sales_csv(spark, sales_file, n_rows=0).count() == 8


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.read_sales_csv(spark, str(tmp_path / "none.csv"))


def test_gzip_round_trip(spark, tmp_path, sales_file):
    typed = cleaning.coerce_types(csv.read_sales_csv(spark, sales_file))
    path = str(tmp_path / "out")
    csv.write_sales_csv(typed, path, compression="gzip")
    again = cleaning.coerce_types(csv.read_sales_csv(spark, path))
    assert sorted(map(str, rows(again))) == sorted(map(str, rows(typed)))


def test_clean(spark, sales_file):
    raw = csv.read_sales_csv(spark, sales_file)
    typed = cleaning.coerce_types(raw)
    audit = {r["rule"]: r["n_rows"] for r in cleaning.cleaning_audit(typed).collect()}
    assert audit == {"required_values": 1, "units_and_amount": 2, "receipt_number": 1, "discount_range": 1, "kept": 3}
    clean = {r["canal"]: r for r in cleaning.clean_sales(raw).collect()}
    assert set(clean) == {"APP", "web", "POS"}
    assert clean["APP"]["fecha"] == dt.datetime(2024, 5, 4, 10)
    assert clean["web"]["fecha"] == dt.datetime(2024, 5, 6, 1)
    assert clean["web"]["porcentaje_descuento"] == 0.0
    assert clean["web"]["sku"] is None
    assert clean["POS"]["porcentaje_descuento"] == 1.0
    assert clean["POS"]["codigo_cliente"] is None and clean["POS"]["local"] is None
    # median of 1980-01-01 and 2000-01-01; the smaller of two equally frequent genders
    assert clean["web"]["fecha_nacimiento"] == dt.datetime(1989, 12, 31, 12)
    assert clean["POS"]["genero"] == 1.0


def test_session_zone_does_not_matter(spark, sales_file):
    before = spark.conf.get("spark.sql.session.timeZone")
    expected = sorted(rows(cleaning.coerce_types(csv.read_sales_csv(spark, sales_file)).select("fecha").dropna()))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
        found = sorted(rows(cleaning.coerce_types(csv.read_sales_csv(spark, sales_file)).select("fecha").dropna()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == expected


def test_receipt_numbers(spark):
    df = spark.createDataFrame([("123",), ("123.0",), ("x",), (None,)], "BOLETA string")
    assert [r[0] for r in cleaning.coerce_types(df).collect()] == [123, 123, None, None]


def test_hot_client_and_partitioning(spark):
    """One client and one receipt hold a third of the rows; counts do not depend on partitions."""
    n = 600
    df = spark.range(n).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("fecha"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("boleta"),
        F.when(F.col("id") % 3 != 1, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("codigo_cliente"),
        F.lit(1.0).alias("monto_aplicado"),
        F.lit(1.0).alias("unidades"),
    )
    results = []
    for parts in (1, 4, 40):
        got = features.derive_features(df.repartition(parts)).select("boleta", "codigo_cliente", "frecuencia_compra", "items_por_boleta")
        results.append(sorted(rows(got)))
    assert results[0] == results[1] == results[2]
    found = {(b, c): (f, i) for b, c, f, i in results[0]}
    assert found[1, "hot"] == (201, 201)  # 200 receipts of its own and receipt 1, which client "1" shares
    assert found[1, "1"] == (1, 201)
    assert found[2, "hot"] == (201, 1)


def test_gender_alias(spark):
    df = spark.createDataFrame([("1",)], ["GÉNERO"])
    assert cleaning.coerce_types(df).columns == ["genero"]


def test_mode_ties_and_default(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (2.0,), (1.0,), (None,)], "genero double")
    assert cleaning.modal_value(df, "genero").first()[0] == 1.0
    assert cleaning.modal_value(df.where("genero is null"), "genero").first()[0] == 1.0


def make_sales(spark, data):
    return spark.createDataFrame(
        data, "fecha string, fecha_nacimiento string, boleta long, codigo_cliente string, monto_aplicado double, unidades double"
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("fecha", "fecha_nacimiento")})


def test_features(spark):
    df = make_sales(
        spark,
        [
            ("2024-05-04 10:00:00", "1984-05-04 12:00:00", 1, "a", 10.0, 4.0),
            ("2024-05-05 00:00:00", "1994-05-05 00:00:00", 1, "b", 10.0, 1.0),
            ("2024-05-06 23:59:59", "1900-01-01 00:00:00", 2, "a", 10.0, 1.0),
            ("2024-05-06 08:00:00", "2024-05-06 09:00:00", None, None, 10.0, 1.0),
            ("2024-05-06 08:00:00", None, 2, "a", 10.0, 1.0),
        ],
    )
    got = {(r["fecha"], r["boleta"]): r for r in features.derive_features(df).collect()}
    first = got[dt.datetime(2024, 5, 4, 10), 1]
    # two hours short of 14,610 days
    assert first["edad"] == round(14609 / 365.25, 1)
    assert (first["frecuencia_compra"], first["items_por_boleta"], first["monto_por_unidad"]) == (2, 2, 2.5)
    assert (first["hora"], first["dia_semana"], first["mes"], first["anio"], first["es_fin_de_semana"]) == (10, 5, 5, 2024, True)
    second = got[dt.datetime(2024, 5, 5), 1]
    assert second["edad"] == 30.0 and second["frecuencia_compra"] == 1 and second["es_fin_de_semana"] is True
    # over 100 takes the median of the plausible ages 40.0, 30.0 and 0.0
    assert got[dt.datetime(2024, 5, 6, 23, 59, 59), 2]["edad"] == 30.0
    no_key = got[dt.datetime(2024, 5, 6, 8), None]
    assert no_key["edad"] == 0.0  # an hour before birth is day -1, which rounds to a plausible zero
    assert no_key["frecuencia_compra"] is None and no_key["items_por_boleta"] is None
    assert got[dt.datetime(2024, 5, 6, 8), 2]["edad"] is None


def test_negative_age_takes_the_median(spark):
    data = [("2024-05-04", "1984-05-04", 1, "a", 1.0, 1.0), ("2024-05-04", "2024-09-04", 2, "a", 1.0, 1.0)]
    aged = features.add_age(make_sales(spark, data))
    assert sorted(rows(aged.select("boleta", "edad"))) == [(1, 40.0), (2, 40.0)]


def test_median_age_falls_back_to_all(spark):
    df = make_sales(spark, [("2024-05-04", "1800-05-04", 1, "a", 1.0, 1.0)])
    assert features.median_age(df).first()[0] == pytest.approx(224.0, abs=0.1)


def test_missing_reports(spark):
    df = spark.createDataFrame(
        [(1.0, None, None, "x"), (2.0, 1.0, 1.0, None), (3.0, None, None, "y"), (4.0, 2.0, 5.0, "z")],
        "a double, b double, c double, s string",
    )
    assert rows(missing.missing_report(df).select("column", "n_missing", "pct_missing")) == [("b", 2, 50.0), ("c", 2, 50.0), ("s", 1, 25.0)]
    assert rows(missing.mcar_check(df)) == [(pytest.approx(1.0), "possible systematic pattern")]
    assert rows(missing.mcar_check(df, ["a"])) == [(None, "no missing values")]
    assert rows(missing.mcar_check(df, ["a", "b"])) == [(0.0, "plausibly missing at random")]
    assert missing.mcar_check(df.select("s")).first()["message"] == "no numeric columns"


def test_null_patterns_of_many_columns(spark):
    names = [f"c{k}" for k in range(70)]
    data = [[None if (i * (k % 7 + 1)) % 5 == 0 else float(k) for k in range(70)] for i in range(40)]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names))
    got = {(r[0], r[1]): r[2] for r in rows(missing.missing_indicator_pairs(df, ["c0", "c3", "c65", "c69"]))}
    wide = {(r[0], r[1]): r[2] for r in rows(missing.missing_indicator_pairs(df, names))}
    flags = np.array([[v is None for v in line] for line in data], dtype=float)
    for (a, b), r in got.items():
        expected = abs(np.corrcoef(flags[:, int(a[1:])], flags[:, int(b[1:])])[0, 1])
        assert r == pytest.approx(expected) and wide[a, b] == pytest.approx(expected)
    assert missing.null_patterns(df, names).agg({"n": "sum"}).first()[0] == 40


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(20), 1000]] + [(None,)], "x double").withColumn("k", F.lit(1.0))
    assert rows(outliers.outlier_summary(df, "x")) == [("x", 1, 4.76, 1, 4.76)]
    assert rows(outliers.outlier_summary(df, "k")) == [("k", 0, 0.0, 0, 0.0)]
    assert "error" in outliers.outlier_summary(df, "nope").columns
    flags = outliers.flag_outliers(df, "x").where("iqr_outlier").select("x")
    assert rows(flags) == [(1000.0,)]


def test_standardize_with_given_parameters(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    fit = features.scaling_parameters(df, ["x", "k"])
    assert sorted(rows(features.standardize(df, ["x", "k"], fit))) == [(-1.0, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([(5.0, 6.0)], "x double, k double")
    assert rows(features.standardize(other, ["x", "k"], fit)) == [(3.0, 1.0)]


KINDS = "fecha timestamp_ntz, unidades double, monto_aplicado double, porcentaje_descuento double, boleta bigint, codigo_cliente string, fecha_nacimiento timestamp_ntz, genero double"


def receipt_lines(spark):
    moment, born = dt.datetime(2024, 5, 1, 10), dt.datetime(1980, 1, 1)
    rows = [(moment, 1.0, float(i), 0.1, 1 + i % 7, [None, "a", "b"][i % 5 % 3], born, 1.0) for i in range(200)]
    rows += [(moment, 1.0, 5.0, None, 99, None, None, None)] * 3 + [(moment, 1.0, 5.0, 0.0, None, "a", born, 2.0), (moment, 1.0, 5.0, 0.0, -4, "a", born, 2.0)]
    return spark.createDataFrame(rows, KINDS)


def test_lines_dealt_out_by_receipt_stay_where_the_counts_are_joined(spark):
    valid = cleaning.valid_rows(receipt_lines(spark))
    plain = features.derive_features(cleaning.impute(valid))
    table = session.materialize_by(valid, "valid", "boleta")
    with session.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), session.setting(spark, session.ALL_KEYS, "false"):
        derived = features.derive_features(cleaning.impute(table), dealt=True)
        plan = derived._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, derived.collect())) == sorted(map(str, plain.collect()))
    assert "ShuffledHashJoin" in plan and not re.search(r"Exchange hashpartitioning\((coalesce\()?boleta", plan)
    assert spark.conf.get(session.ALL_KEYS) == "true"
    prepared = stages.prepare(receipt_lines(spark))
    assert prepared.columns == plain.columns and sorted(map(str, prepared.collect())) == sorted(map(str, plain.collect()))


def test_filters_do_not_read_text_again(spark):
    raw = spark.createDataFrame(
        [("05/01/2024 10:00:00", "1", "2.5", "7.0", "x"), ("2024-05-01 10:00:00+03:00", "1", "2", "8", "0.5"), ("soon", "1", "1", "9", "0.1"), (None, "1d", "NaN", None, None)],
        "FECHA string, UNIDADES string, `MONTO APLICADO` string, BOLETA string, `PORCENTAJE DESCUENTO` string",
    )
    once = cleaning.valid_rows(raw)
    assert once.columns == cleaning.coerce_types(raw).columns
    assert sorted(map(str, once.collect())) == sorted(map(str, cleaning.keep_valid_rows(cleaning.coerce_types(raw)).collect()))
    assert once.count() == 2
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(cleaning.DAY_FORMS[2][0]) == 2  # the test and the replacement, in one place


def test_receipts_are_cast_only_if_whole(spark):
    """A cast that fails makes an exception a row, so decimal receipts never reach the cast to a whole number."""
    texts = ["12", " -7 ", "+3", "12.0", "1e3", ".5", "12d", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "boleta string")
    typed = cleaning.coerce_types(df)
    assert [r.boleta for r in typed.collect()] == [12, -7, 3, 12, 1000, 0, None, None, None]
    first = typed._jdf.queryExecution().analyzed().toString().lower().split("as bigint")[0]
    assert cleaning.WHOLE in first and cleaning.DECIMAL.lower() not in first
