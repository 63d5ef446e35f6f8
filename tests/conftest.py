import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("basketry-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lines(spark):
    """Builds transaction lines from partial rows."""
    from basketry.sources.schemas import RAW

    defaults = dict(
        invoice="1", stock_code="85123A", description="mug", quantity=1,
        invoice_date="2011-01-01 10:00:00", unit_price=1.0, customer_id=1, country="United Kingdom",
        source_sheet="a",
    )

    def build(*rows):
        from datetime import datetime

        full = [{**defaults, **r} for r in rows]
        for r in full:
            r["invoice_date"] = datetime.fromisoformat(r["invoice_date"])
        return spark.createDataFrame([tuple(r[c] for c in RAW.fieldNames()) for r in full], RAW)

    return build


@pytest.fixture(scope="session")
def sales(lines):
    """Cleaned customer sales from partial rows."""
    from basketry.operators.cleaning import clean_transactions

    return lambda *rows: clean_transactions(lines(*rows))["customer_sales"]


@pytest.fixture(scope="session")
def sf():
    return SF
