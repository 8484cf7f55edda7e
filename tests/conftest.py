import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_DIR = os.environ.get("AISLEKIT_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from aislekit.session import get_session

    # one JVM runs every query of the suite, so give the driver room
    return get_session("local[4]", 8, app_name="aislekit-tests", extra={"spark.driver.memory": "4g"})


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    from aislekit.plans.registry import tables_for

    return tables_for(spark, sf_dir)


@pytest.fixture(scope="session")
def duck(sf_dir):
    from aislekit.sources.tables import BASE_TABLES

    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
