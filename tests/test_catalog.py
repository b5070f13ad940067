"""The driver contract, and a sample of registered queries beside their SQL."""

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, sorted_rows
from tillmark.catalog import queries as catalog

SF = "/root/testdata/sf0.001"
SAMPLED = [
    "sales_csv_scan", "missing_before", "cleaning_audit", "clean_sales", "sales_features", "outlier_summary_monto",
    "shop_totals", "describe_sales", "spearman_matrix", "chi_square_statistic", "mann_whitney_app_web_statistic",
    "ols_coefficients", "pacf", "histogram", "box_by_channel", "client_totals_by_key",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_contract(spark):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries)
    flagship = contract.entry(spark)
    assert flagship.columns == ["local", "is_total", "n_rows", "sum_monto"] and flagship.count() > 1


@pytest.mark.parametrize("name", SAMPLED)
def test_query_matches_sql(spark, db, name):
    df = contract.queries()[name](spark, SF)
    result = db.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(result.columns, result.fetchall())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_their_columns(spark):
    plan = plan_of(contract.queries()["shop_totals"](spark, SF))
    assert "ReadSchema: struct<monto_aplicado:double,local:double>" in plan
    raw = plan_of(contract.queries()["run_header"](spark, SF))
    assert "l_extendedprice" not in raw and "part.parquet" not in raw


def test_no_cross_joins(spark):
    prepared = catalog.prepared(spark, SF)
    for name in ("outlier_flags", "standardized_sales", "chi_square_statistic", "describe_sales", "hypothesis_battery", "density_curve"):
        plan = plan_of(contract.queries()[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert prepared.columns


@pytest.mark.parametrize("name", ["acf", "acf_by_channel", "daily_summary", "discount_regression_statistic"])
def test_few_columns_need_no_preparation(spark, db, monkeypatch, name):
    """Series and the discount regression read columns that preparation leaves as they are, and the lines of a receipt."""
    monkeypatch.setattr(catalog, "_shared", {})
    monkeypatch.setattr(catalog.stages, "prepare", lambda raw: pytest.fail("prepared"))
    df = contract.queries()[name](spark, SF)
    result = db.sql(contract.oracle_sql()[name])
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(result.columns, result.fetchall())
