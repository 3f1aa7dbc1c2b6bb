import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/tablelift-warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def no_views_left():
    """Temporary views that a test makes go with it: the session is one for all, and every listing of tables has them."""
    def views(session):
        return {t.name for t in session.catalog.listTables() if t.isTemporary} if session else set()

    before = views(SparkSession.getActiveSession())
    yield
    session = SparkSession.getActiveSession()
    for name in views(session) - before:
        session.catalog.dropTempView(name)
