import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from barlake.catalog import spec_of
from barlake.operators.merge import conform
from barlake.plans.market import Market
from barlake.session import build_session
from barlake.sources.tables import Tables, empty_table


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "barlake-tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


class FrameTables(Tables):
    """Tables from hand-made rows (dicts); any table not given is empty."""

    def __init__(self, spark, **rows):
        self.spark = spark
        self.rows = rows

    def scan(self, table, code=None, start=None, end=None, dates=None):
        if table not in self.rows:
            return empty_table(self.spark, table)
        return make(self.spark, table, self.rows[table])


def make(spark, table, rows):
    """Typed rows of a catalogue table from dicts."""
    spec = spec_of(table)
    values = [tuple(r.get(c) for c in spec.columns) for r in rows]
    return conform(spark.createDataFrame(values, spec.schema), table)


@pytest.fixture
def market(spark):
    return lambda **rows: Market(FrameTables(spark, **rows))


def rows_of(df):
    return [tuple(r) for r in df.collect()]
