"""The stages of a sales analysis: preprocess, explore, infer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.operators import cleaning, clustering, correlation, describe, features, hypothesis
from tillmark.operators import missing, normality, outliers, regression, timeseries
from tillmark.operators.sampling import DEFAULT_SEED, sales_key
from tillmark.operators.sums import Sums, collect_sums
from tillmark.schema import numeric_columns
from tillmark.session import ALL_KEYS, materialize, materialize_by, setting

Results = dict[str, tuple[DataFrame, Sequence[str]]]
TEST_COLUMNS = ("unidades", "monto_aplicado", "porcentaje_descuento")
MIN_DECOMPOSED_DAYS = 15


def prepare(raw: DataFrame) -> DataFrame:
    """Cleaned and derived sales lines, written once for the stages that follow.

    Valid rows are written before the medians, mode and per-key counts are taken, so the joins
    behind ``raw`` run once rather than once for each of them. They are dealt out by receipt, which
    no valid row lacks, so the counts join them where they lie.
    """
    valid = cleaning.valid_rows(raw)
    if "boleta" not in valid.columns:
        return materialize(features.derive_features(cleaning.impute(materialize(valid, "valid"))), "prepared")
    valid = materialize_by(valid, "valid", "boleta")
    with setting(valid.sparkSession, ALL_KEYS, "false"):
        return materialize(features.derive_features(cleaning.impute(valid), dealt=True), "prepared")


#: Columns whose products the stages read: correlations, regression, variance inflation.
PAIRED = ("unidades", "monto_aplicado", "porcentaje_descuento", "monto_por_unidad", "edad", "items_por_boleta", "local")


def statistics(prepared: DataFrame, seed: int = DEFAULT_SEED) -> Sums:
    """The one table of sums that describes, tests, correlates and scales a prepared table, by one scan of it.

    Its keys are those of the group tests, and ``is_train``, the regression's split of the rows it can use.
    """
    columns = numeric_columns(prepared)
    split = prepared.withColumn("is_train", regression.train_rows(prepared, sales_key(), seed))
    keys = [*[c for c in hypothesis.BATTERY_KEYS if c in prepared.columns], "is_train"]
    return collect_sums(split, columns, [c for c in PAIRED if c in columns], columns, keys).written()


def preprocess(raw: DataFrame, seed: int = DEFAULT_SEED) -> tuple[DataFrame, Sums, Results]:
    """Prepared table, its statistics and the reports on how it came about."""
    typed = cleaning.coerce_types(raw)
    prepared = prepare(raw)
    sums = statistics(prepared, seed)
    counted = raw.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("seed", F.lit(seed))
    results: Results = {
        "run": (counted, ()),
        "missing_before": (missing.missing_report(typed), ("column",)),
        "mcar": (missing.mcar_check(typed), ()),
        "cleaning_audit": (cleaning.cleaning_audit(typed), ("step", "rule")),
        "missing_after": (missing.missing_report(prepared), ("column",)),
        "shop_totals": (describe.shop_totals(prepared), ("local", "is_total")),
    }
    for column in ("monto_aplicado", "unidades"):
        results[f"outliers_{column}"] = (outliers.outlier_summary(prepared, column, sums=sums), ("column",))
    return prepared, sums, results


def explore(prepared: DataFrame, seed: int = DEFAULT_SEED, sums: Sums | None = None) -> Results:
    sums = sums or statistics(prepared, seed)
    columns = [c for c in TEST_COLUMNS if c in prepared.columns]
    normal = materialize(normality.normality_tests(prepared, columns, sales_key(), seed=seed), "normality")
    method = normality.correlation_method(normal, columns)
    daily = materialize(timeseries.daily_sales(prepared), "daily")
    results: Results = {
        "describe": (describe.describe(prepared, sums=sums), ("variable",)),
        "normality": (normal, ("variable",)),
        f"correlation_{method}": (correlation.correlation_with_pvalues(prepared, columns, method, sums=sums), ("column_a", "column_b")),
        "chi2_canal_local": (hypothesis.chi_square(prepared, "canal", "local"), ()),
        "anova_monto_canal": (hypothesis.anova(sums, "monto_aplicado", "canal"), ()),
        "canal": (describe.value_shares(prepared, "canal"), ("canal",)),
        "hours": (describe.peak_hours(prepared), ()),
        "daily_summary": (timeseries.daily_summary(daily), ()),
        "acf": (timeseries.autocorrelation(daily), ("lag",)),
        "pacf": (timeseries.partial_autocorrelation(daily), ("lag",)),
    }
    if daily.count() >= MIN_DECOMPOSED_DAYS:
        results["decomposition"] = (timeseries.decompose(daily), ("day",))
    return results


def infer(
    prepared: DataFrame, seed: int = DEFAULT_SEED, n_clusters: int = 4, restarts: int = clustering.RESTARTS, sums: Sums | None = None
) -> Results:
    sums = sums or statistics(prepared, seed)
    spark = prepared.sparkSession
    rows = materialize(regression.model_rows(prepared, sales_key(), seed), "model-rows")
    model = regression.fit_amount_model(rows)
    vif_columns = ["local", hypothesis.volume_column(prepared), "porcentaje_descuento"]
    results: Results = {
        "hypotheses": (hypothesis.hypothesis_battery(prepared, sales_key(), seed, sums), ("hypothesis",)),
        "regression_terms": (regression.coefficient_table(model, spark), ("term",)),
        "regression_fit": (regression.fit_measures(model, rows), ()),
        "vif": (regression.variance_inflation(sums.where(F.col("is_train")), vif_columns), ("variable",)),
        "breusch_pagan": (regression.breusch_pagan(model, rows), ()),
        "jarque_bera": (regression.jarque_bera(model.predict(rows.where("is_train"))), ()),
    }
    clients = materialize(clustering.client_features(prepared), "clients")
    if not clustering.has_enough_clients(clients, n_clusters):
        message = spark.range(1).select(F.lit("not enough clients").alias("error"))
        return {**results, "clustering": (message, ())}
    scaled = clustering.scaled_clients(clients, seed)
    train = scaled.where("is_train")
    fits = clustering.fit_segments(train, [*clustering.ELBOW_RANGE, n_clusters], restarts, seed)
    segments = next(s for s in fits if s.k == n_clusters)
    labelled = materialize(clustering.assign(segments, scaled), "segments")
    scaled_columns = [f"z_{c}" for c in clustering.FEATURES]
    inertia = spark.range(1).select(F.lit(segments.k).alias("k"), F.lit(segments.inertia).alias("inertia"))
    return {
        **results,
        "clustering": (inertia, ()),
        "cluster_sizes": (clustering.cluster_sizes(labelled), ("cluster",)),
        "cluster_profile": (clustering.cluster_profile(labelled), ("cluster",)),
        "silhouette": (clustering.silhouette(labelled, scaled_columns, ["codigo_cliente"], seed=seed), ()),
        "elbow": (clustering.elbow_table(spark, [s for s in fits if s.k in clustering.ELBOW_RANGE]), ("k",)),
    }


def run(raw: DataFrame, stage: str = "all", seed: int = DEFAULT_SEED) -> tuple[DataFrame, Results]:
    """One stage ("preprocess", "explore", "infer") or "all"; the table is prepared once."""
    if stage not in ("all", "preprocess", "explore", "infer"):
        raise ValueError(f"unknown stage {stage!r}")
    if stage in ("all", "preprocess"):
        prepared, sums, results = preprocess(raw, seed)
    else:
        prepared, results = prepare(raw), {}
        sums = statistics(prepared, seed)
    if stage in ("all", "explore"):
        results.update(explore(prepared, seed, sums))
    if stage in ("all", "infer"):
        results.update(infer(prepared, seed, sums=sums))
    return prepared, results
