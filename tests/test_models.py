import json
import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillmark.operators import clustering, partitions, regression
from tillmark.operators.sampling import sales_key
from tillmark.plans import stages
from tillmark.sources import results


@pytest.fixture(scope="module")
def sales(spark):
    """A prepared-looking table with a known linear amount: 3 + 2 x + channel effect + noise."""
    rng = np.random.default_rng(11)
    n = 3000
    frame = pd.DataFrame(
        {
            "boleta": np.arange(1, n + 1),
            "sku": rng.integers(1, 50, n).astype(float),
            "local": rng.integers(1, 30, n).astype(float),
            "canal": rng.choice(["APP", "POS", "WEB"], n, p=[0.1, 0.7, 0.2]),
            "items_por_boleta": rng.integers(1, 9, n),
            "unidades": 1.0,
            "porcentaje_descuento": rng.random(n).round(2),
            "codigo_cliente": rng.integers(1, 200, n).astype(str),
            "noise": rng.normal(size=n),
        }
    )
    effect = frame["canal"].map({"APP": 0.0, "POS": 5.0, "WEB": -4.0})
    frame["monto_aplicado"] = 100 + 2 * frame["items_por_boleta"] + effect + 0.1 * frame["local"] + frame["noise"]
    return spark.createDataFrame(frame.drop(columns="noise")).cache(), frame


def design(frame):
    x = np.column_stack(
        [
            np.ones(len(frame)),
            frame["canal"] == "POS",
            frame["canal"] == "WEB",
            frame["local"],
            frame["items_por_boleta"],
            frame["porcentaje_descuento"],
        ]
    ).astype(float)
    return x, frame["monto_aplicado"].to_numpy()


def test_regression_against_normal_equations(spark, sales):
    df, _ = sales
    model_rows = regression.model_rows(df, sales_key()).cache()
    model = regression.fit_amount_model(model_rows)
    assert model.terms == ["intercept", "canal_POS", "canal_WEB", "local", "items_por_boleta", "porcentaje_descuento"]
    every = model_rows.toPandas()
    train, test = every[every["is_train"]], every[~every["is_train"]]
    x, y = design(train)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert np.allclose(model.coefficients, beta)
    e = y - x @ beta
    dof = len(y) - x.shape[1]
    errors = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (e @ e) / dof)
    table = {r["term"]: r for r in regression.coefficient_table(model, spark).collect()}
    for term, b, error in zip(model.terms, beta, errors):
        assert table[term]["std_error"] == pytest.approx(error)
        assert table[term]["t"] == pytest.approx(b / error)
        assert (table[term]["high"] - table[term]["low"]) / 2 / error == pytest.approx(1.961, abs=1e-3)
    assert abs(table["canal_POS"]["coefficient"] - 5) < 0.5 and table["canal_POS"]["p_value"] < 1e-50

    measures = regression.fit_measures(model, model_rows).first()
    r2 = 1 - (e @ e) / ((y - y.mean()) ** 2).sum()
    assert measures["r_squared_adj"] == pytest.approx(1 - (1 - r2) * (len(y) - 1) / dof)
    xt, yt = design(test)
    assert measures["rmse_test"] == pytest.approx(math.sqrt(((yt - xt @ beta) ** 2).mean()))
    assert measures["mae_test"] == pytest.approx(abs(yt - xt @ beta).mean())

    z = e**2
    g, *_ = np.linalg.lstsq(x, z, rcond=None)
    bp = len(z) * (1 - ((z - x @ g) ** 2).sum() / ((z - z.mean()) ** 2).sum())
    got = regression.breusch_pagan(model, model_rows).first()
    assert got["statistic"] == pytest.approx(bp) and got["dof"] == 5.0 and got["homocedastico"]

    jb = regression.jarque_bera(model.predict(model_rows.where("is_train"))).first()
    skew, kurt = (e**3).mean() / (e**2).mean() ** 1.5, (e**4).mean() / (e**2).mean() ** 2
    assert jb["statistic"] == pytest.approx(len(e) / 6 * (skew**2 + (kurt - 3) ** 2 / 4), rel=1e-5)
    assert jb["residuales_normales"]

    points = regression.residual_sample(model, model_rows, sales_key(), n=500)
    qq = regression.qq_points(points).orderBy("i").collect()
    assert len(qq) == 500
    assert all(a["sample_quantile"] <= b["sample_quantile"] for a, b in zip(qq, qq[1:]))
    assert qq[0]["theoretical"] == pytest.approx(-qq[-1]["theoretical"])


def test_published_jarque_bera():
    n, skew, kurt = 2270008, 7.503366534420996, 82.07428677338862
    assert n / 6 * (skew**2 + (kurt - 3) ** 2 / 4) == pytest.approx(612707777.9020989, rel=1e-9)


def test_unseen_channel_is_an_error(spark, sales):
    df, _ = sales
    model = regression.fit_amount_model(df.withColumn("is_train", F.lit(True)))
    with pytest.raises(Exception, match="channel without train rows"):
        model.predict(df.limit(1).withColumn("canal", F.lit("FAX"))).collect()


def test_volume_falls_back_to_units(spark, sales):
    df, _ = sales
    varied = df.drop("items_por_boleta").withColumn("unidades", 1 + F.col("boleta") % 3)
    model = regression.fit_amount_model(varied.withColumn("is_train", F.lit(True)))
    assert model.design.numeric == ["local", "unidades", "porcentaje_descuento"]


def test_vif_has_no_intercept(spark, sales):
    df, frame = sales
    columns = ["local", "items_por_boleta", "porcentaje_descuento"]
    got = dict(rows(regression.variance_inflation(df, columns)))
    x = frame[columns].to_numpy(float)
    for i, name in enumerate(columns):
        others = np.delete(x, i, axis=1)
        b, *_ = np.linalg.lstsq(others, x[:, i], rcond=None)
        rest = x[:, i] - others @ b
        assert got[name] == pytest.approx((x[:, i] ** 2).sum() / (rest**2).sum())
    centred = dict(rows(regression.variance_inflation(df, columns, intercept=True)))
    assert all(1.0 <= v < 1.05 for v in centred.values())
    assert regression.variance_inflation(df.limit(9), columns).count() == 0


@pytest.fixture(scope="module")
def clusters(spark):
    rng = np.random.default_rng(2)
    centres = [(0, 0, 0, 0), (8, 0, 8, 0), (0, 9, 0, 9)]
    data = [
        (f"c{i}", *[float(v) for v in np.array(centres[i % 3]) + rng.normal(size=4) * 0.3]) for i in range(900)
    ]
    names = ", ".join(f"{c} double" for c in clustering.FEATURES)
    return spark.createDataFrame(data, f"codigo_cliente string, {names}").cache()


def test_segments(spark, clusters):
    scaled = clustering.scaled_clients(clusters).cache()
    train = scaled.where("is_train")
    fits = clustering.fit_segments(train, [1, 2, 3, 4], restarts=4)
    inertia = dict(rows(clustering.elbow_table(spark, fits)))
    assert list(inertia) == [1, 2, 3, 4]
    assert inertia[1] > inertia[2] > inertia[3] > inertia[4]
    three = fits[2]
    labelled = clustering.assign(three, scaled).cache()
    sizes = rows(clustering.cluster_sizes(labelled))
    assert sorted(n for _, n in sizes) == [300, 300, 300]
    # every source group is one cluster
    groups = labelled.groupBy((F.substring("codigo_cliente", 2, 9).cast("int") % 3).alias("g")).agg(F.count_distinct("cluster").alias("n"))
    assert {n for _, n in rows(groups)} == {1}
    profile = rows(clustering.cluster_profile(labelled))
    assert len(profile) == 3 and all(round(v, 1) == v for r in profile for v in r[1:])
    # inertia is the sum of squares around the cluster means
    z = [f"z_{c}" for c in clustering.FEATURES]
    frame = labelled.where("is_train").toPandas()
    around = sum(((g[z] - g[z].mean()) ** 2).to_numpy().sum() for _, g in frame.groupby("cluster"))
    assert three.inertia == pytest.approx(around, rel=1e-6)
    again = clustering.fit_segments(train.repartition(5), [3], restarts=4)[0]
    assert again.inertia == pytest.approx(three.inertia, rel=1e-9)
    found = clustering.full_silhouette(labelled, z).where("cluster is null").first()
    assert found["silhouette"] > 0.9 and found["n_clients"] == labelled.count()


def test_silhouette_by_brute_force(spark, clusters):
    scaled = clustering.scaled_clients(clusters.limit(60))
    labelled = scaled.withColumn("cluster", (F.crc32("codigo_cliente") % 3).cast("int")).cache()
    z = [f"z_{c}" for c in clustering.FEATURES]
    frame = labelled.toPandas()
    x, labels = frame[z].to_numpy(), frame["cluster"].to_numpy()
    widths = {}
    for i, name in enumerate(frame["codigo_cliente"]):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        inside = d[labels == labels[i]].sum() / max((labels == labels[i]).sum() - 1, 1)
        outside = min(d[labels == c].mean() for c in set(labels) - {labels[i]})
        widths[name] = (outside - inside) / max(outside, inside) if (labels == labels[i]).sum() > 1 else 0.0
    got = {r["codigo_cliente"]: r["silhouette"] for r in clustering.silhouette_points(labelled, z, ["codigo_cliente"]).collect()}
    assert got == pytest.approx(widths)
    mean = clustering.silhouette(labelled, z, ["codigo_cliente"]).first()
    assert mean["n_sample"] == 60 and mean["silhouette"] == pytest.approx(np.mean(list(widths.values())))


def test_too_few_clients(spark, clusters):
    assert clustering.has_enough_clients(clusters, 4)
    assert not clustering.has_enough_clients(clusters.limit(7), 4)


def test_map_partitions_and_totals(spark, sales):
    df, frame = sales
    parts = partitions.map_partitions(df.select("monto_aplicado"), partitions.sales_partials, "n_rows bigint, sum_monto double", 5)
    total = partitions.combine_totals(parts, ["n_rows", "sum_monto"]).first()
    assert total["n_rows"] == len(frame) and total["sum_monto"] == pytest.approx(frame["monto_aplicado"].sum())
    none = partitions.map_partitions(df, lambda piece: None, "n_rows bigint, sum_monto double")
    assert partitions.combine_totals(none, ["n_rows"]).count() == 0


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_map_group_parts(spark, sales, small_batches):
    df, frame = sales
    merge = {"n_rows": "sum", "sum_monto": "sum"}
    schema = "n_rows bigint, sum_monto double, canal string"
    got = partitions.map_group_parts(df.select("canal", "monto_aplicado"), partitions.sales_partials, schema, ["canal"], merge)
    found = {r["canal"]: r for r in got.collect()}
    for canal, group in frame.groupby("canal"):
        assert found[canal]["n_rows"] == len(group)
        assert found[canal]["sum_monto"] == pytest.approx(group["monto_aplicado"].sum())


def test_calls_do_not_grow_with_the_batches_a_group_is_in(spark, small_batches, monkeypatch):
    monkeypatch.setattr(partitions, "ROWS_PER_CALL", 50)
    shops = spark.range(0, 4_000, 1, 2).selectExpr("cast(id % 1000 as double) as local", "1.0D as monto_aplicado", "id % 3 = 0 as odd")
    nobody = spark.createDataFrame([(None, 9.0, True)], shops.schema)
    rows_in = shops.unionByName(nobody).coalesce(2)
    calls = spark.sparkContext.accumulator(0)

    def counted(func):
        def call(piece):
            calls.add(1)
            return func(piece)

        return call

    merge = {"n_rows": "sum", "sum_monto": "sum"}
    schema = "n_rows bigint, sum_monto double, local double"
    expected = {float(i): (4, 4.0) for i in range(1_000)}
    for func, keyed, most in ((partitions.shop_partials, True, 4_001 // 50 + 3), (partitions.sales_partials, False, 2 * 1_000 + 4_001 // 50 + 3)):
        before = calls.value
        got = partitions.map_group_parts(rows_in, counted(func), schema, ["local"], merge, keyed).collect()
        assert {r["local"]: (r["n_rows"], r["sum_monto"]) for r in got} == expected
        assert 0 < calls.value - before <= most


def test_groups_stay_whole(spark, sales, small_batches):
    df, frame = sales
    median = partitions.whole(lambda piece: pd.DataFrame({"canal": [piece["canal"].iloc[0]], "m": [piece["monto_aplicado"].median()]}))
    got = partitions.map_groups(df.select("canal", "monto_aplicado"), median, "canal string, m double", ["canal"])
    assert dict(rows(got)) == pytest.approx(frame.groupby("canal")["monto_aplicado"].median().to_dict())


def test_a_hot_key_is_counted_whole(spark, small_batches):
    def by_client(piece):
        return piece.groupby("codigo_cliente", sort=False)["boleta"].nunique().rename("n").reset_index()

    def sums_by_client(piece):
        return piece.groupby("codigo_cliente", sort=False)["boleta"].agg(n="size", total="sum", top="max").reset_index()

    lines = spark.range(200_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 as string)) as codigo_cliente", "id % 5 as boleta")
    lines = lines.unionByName(spark.createDataFrame([(None, 1)], "codigo_cliente string, boleta bigint"))
    whole = partitions.whole_keys(by_client, "codigo_cliente")
    got = dict(rows(partitions.map_by_key(lines, whole, "codigo_cliente string, n bigint", "codigo_cliente")))
    assert got["hot"] == 5 and None not in got and len(got) == 51
    merged = partitions.merged_keys(sums_by_client, "codigo_cliente", {"n": "sum", "total": "sum", "top": "max"})
    kind = "codigo_cliente string, n bigint, total bigint, top bigint"
    found = {r[0]: r[1:] for r in rows(partitions.map_by_key(lines, merged, kind, "codigo_cliente", n_buckets=3))}
    frame = lines.dropna().toPandas().groupby("codigo_cliente")["boleta"].agg(["size", "sum", "max"])
    assert found == {k: tuple(v) for k, v in zip(frame.index, frame.to_numpy().tolist())}


@pytest.mark.parametrize("sizes", [[3], [1, 1], [2, 2, 2], [1, 5, 1, 1, 4], [4, 1, 3]])
def test_frames_hold_whole_keys(sizes):
    keys = [k for k, n in enumerate([2, 1, 3, 1, 5]) for _ in range(n)]
    frames, at = [], 0
    while at < len(keys):
        n = sizes[len(frames) % len(sizes)]
        frames.append(pd.DataFrame({"k": keys[at : at + n]}))
        at += n
    calls = []

    def count(piece):
        calls.append(set(piece["k"]))
        return piece.groupby("k", sort=False).size().rename("n").reset_index()

    for adapter in (partitions.whole_keys(count, "k"), partitions.merged_keys(count, "k", {"n": "sum"})):
        found = pd.concat(list(adapter(iter(frames))))
        assert dict(zip(found["k"], found["n"])) == {0: 2, 1: 1, 2: 3, 3: 1, 4: 5} and len(found) == 5


def test_ranges_are_in_order(spark, small_batches):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as x", "id").repartition(7)

    def ends(piece, add):
        assert list(piece.columns) == ["x", "id"]
        return pd.DataFrame({"low": [piece["x"].iloc[0] + add], "high": [piece["x"].iloc[-1]], "n": [len(piece)]})

    got = partitions.map_ranges(df, ends, "low bigint, high bigint, n bigint", ["x"], rows_per_range=130, add=1).orderBy("ordinal").collect()
    assert [tuple(r) for r in got] == [(130 * k + 1, min(130 * k + 129, 999), min(130, 1000 - 130 * k), k) for k in range(8)]
    assert partitions.map_ranges(df.where("false"), ends, "low bigint, high bigint, n bigint", ["x"], add=0).count() == 0


def test_nested_document(spark, tmp_path):
    one = spark.createDataFrame([("b", 1, None), ('a"', 2, 0.5)], "k string, n int, p double")
    found = {"z": (one, ("k",)), "first": (one.where("n = 1").drop("k"), ()), "none": (one.where("false"), ("k",))}
    document = results.results_document(found).first()["document"]
    assert json.loads(document) == {"z": {"b": {"n": 1, "p": None}, 'a"': {"n": 2, "p": 0.5}}, "first": {"n": 1, "p": None}, "none": None}
    results.write_document(found, str(tmp_path / "d"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "d")).collect()] == [document]


def test_results_sink(spark, tmp_path):
    one = spark.createDataFrame([("a", 1, None)], "k string, n int, p double")
    path = str(tmp_path / "results")
    results.write_results({"first": (one, ("k",)), "second": (one.select("n"), ())}, path)
    lines = [json.loads(v["value"]) for v in spark.read.text(path).collect()]
    assert {"section": "first", "key1": "a", "key2": "p", "value": None} in lines
    assert {"section": "second", "key1": "", "key2": "n", "value": "1"} in lines
    assert len(lines) == 3


def test_whole_run(spark):
    from tillmark.sources.tables import sales_lines

    raw = sales_lines(spark, "/root/testdata/sf0.001")
    prepared, found = stages.run(raw, "preprocess")
    assert prepared.count() < raw.count()
    found.update(stages.explore(prepared))
    found.update(stages.infer(prepared, restarts=1))
    table = results.results_table(found)
    sections = {r["section"] for r in table.select("section").distinct().collect()}
    assert {"run", "mcar", "describe", "acf", "pacf", "hypotheses", "regression_terms", "cluster_sizes", "elbow"} <= sections
    with pytest.raises(ValueError):
        stages.run(raw, "other")
