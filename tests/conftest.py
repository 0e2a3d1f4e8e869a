from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("shiftlens-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SCHEMAS = {
    "status_blocks": "line_id string, start_ts timestamp_ntz, end_ts timestamp_ntz, running boolean, faults string, stop_type string, start_id long",
    "fof_changes": "line_id string, ndx long, alarm_text string, t_stamp timestamp_ntz",
    "ppm": "line_id string, t_stamp timestamp_ntz, output_ppm double",
    "output_stats": "line_id string, row_id long, t_stamp timestamp_ntz, counter_total long, counter_good long",
    "machine_state": "line_id string, t_stamp timestamp_ntz, state_text string",
    "hydration_counters": "line_id string, row_id long, block_id long, t_stamp timestamp_ntz, name string, cnt long",
    "foil_counters": "line_id string, row_id long, block_id long, t_stamp timestamp_ntz, name string, cnt long",
    "downtime_overlays": "line_id string, start_ts timestamp_ntz",
}


@pytest.fixture
def make_site(spark):
    """A site over hand-made rows; tables that are not given are empty."""
    from shiftlens.sources.site import Site

    def build(lines=None, **tables):
        def table(name):
            return spark.createDataFrame(tables.get(name, []), SCHEMAS[name])

        options = {"lines": lines} if lines else {}
        return Site(spark, table, **options)

    return build


def at(text: str):
    """'01-10 07:30:00.5' in January 2024 as a naive datetime."""
    from datetime import datetime

    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in text else "%Y-%m-%d %H:%M:%S"
    return datetime.strptime(f"2024-{text}", fmt)
