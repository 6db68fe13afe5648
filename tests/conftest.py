import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from matchvault import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "matchvault-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_chunks(spark):
    """Force ordered scans to split every key with more than a few rows."""
    from matchvault.operators.scan import ROWS_PER_CHUNK_CONF

    spark.conf.set(ROWS_PER_CHUNK_CONF, "40")
    yield
    spark.conf.unset(ROWS_PER_CHUNK_CONF)


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])
