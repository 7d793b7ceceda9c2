import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def names(spark):
    """Three fresh table names; the tables go afterwards."""
    import uuid

    run = uuid.uuid4().hex[:12]
    made = [f"{layer}_{run}" for layer in ("bronze", "silver", "gold")]
    yield made
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


BRONZE = "row_id long, batch_id string, observation_id string, company_id string, metric_id string, period_id string, value double, ingested_at timestamp_ntz"


@pytest.fixture
def bronze(spark):
    """Makes a Bronze frame of tuples (observation_id, company_id, metric_id, period_id, value, ingested_at[, batch_id])."""
    from datetime import datetime

    def make(rows):
        out = []
        for k, r in enumerate(rows, 1):
            stamp = datetime.fromisoformat(r[5]) if isinstance(r[5], str) else r[5]
            out.append((k, r[6] if len(r) > 6 else "f000-001", *r[:5], stamp))
        return spark.createDataFrame(out, BRONZE)

    return make
