import os
import sys
import tempfile
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind import schemas  # noqa: E402
from tradewind.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows (dicts) of a signal table, missing columns NULL, numbers converted to the declared types."""

    def build(table, rows):
        schema = schemas.TABLES[table]

        def value(field, raw):
            if raw is None:
                return None
            if field.dataType.typeName() == "decimal":
                return Decimal(str(raw))
            if field.dataType.typeName() == "date" and isinstance(raw, str):
                return date.fromisoformat(raw)
            return raw

        return spark.createDataFrame([tuple(value(f, r.get(f.name)) for f in schema) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def batch(spark):
    """A batch of dict rows as they arrive: every column text unless a DDL says otherwise."""

    def build(rows, ddl=None):
        names = list(rows[0])
        ddl = ddl or ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)

    return build


def rows(df):
    return [r.asDict() for r in df.collect()]
