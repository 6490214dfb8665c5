from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from eventsieve.session import RECOMMENDED_CONF

    ckpt = tempfile.mkdtemp(prefix="eventsieve-test-ckpt-")
    b = (
        SparkSession.builder.master("local[*]")
        .appName("eventsieve-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", ckpt)
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from eventsieve.session import scratch_path

    return scratch_path(spark, "test")


def lines_df(spark, rows):
    """rows: list of (seq, arrival_ts or None, json_string)."""
    from datetime import datetime, timedelta

    from eventsieve import schemas

    base = datetime(2026, 7, 9, 12, 0, 0)
    data = [(s, base + timedelta(seconds=t) if t is not None else None, j) for s, t, j in rows]
    return spark.createDataFrame(data, schemas.RAW_LINES)
