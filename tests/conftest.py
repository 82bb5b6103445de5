"""A session for all tests, and a comparison of rows."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 9)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows(columns, records):
    """Rows in an order of their own, columns by name."""
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = [tuple(_plain(r[k]) for k in order) for r in records]
    return [columns[k] for k in order], sorted(plain, key=repr)


def of_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def run(sql: str, sf_dir: str):
        con = duckdb.connect()
        con.execute("SET TimeZone = 'UTC'")
        for p in Path(sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        got = con.execute(sql)
        return rows([d[0] for d in got.description], got.fetchall())

    return run
