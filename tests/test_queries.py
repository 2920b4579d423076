"""Every registered query against its SQL twin in DuckDB, and a rows check for the others."""

import glob
import math
import os

import pytest

from adjudica import plans

DATA = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, CHECKS = plans.all_queries(), plans.all_check_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(frame):
    """Rows as sorted tuples over sorted columns, missing values as None."""
    columns = sorted(frame.columns)

    def plain(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return None
        return value.item() if hasattr(value, "item") else value

    rows = [tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False)]
    return columns, sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(name, spark, duck):
    assert rows_of(QUERIES[name](spark, DATA).toPandas()) == rows_of(duck.execute(CHECKS[name]).fetchdf())


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize(
    "name", ["isolation_forest_score", "provider_tiers", "pricing_features", "churn_drivers", "score_new_providers"]
)
def test_rows_only_queries_give_rows(name, spark):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    result = entry.entry(spark)
    assert result.columns == ["provider_license_key", "anomaly_score"]
    assert result.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
