from __future__ import annotations

import pytest

from feedquality.session import session_builder


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = (session_builder("tests").master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
             .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
