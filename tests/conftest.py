import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_visits(spark):
    """Visits from (entry, exit[, category[, duration]]) tuples of text."""

    def make(rows, **extra):
        from dwellgrid.operators import clean
        from dwellgrid.sources.visits import text_rows

        full = []
        for row in rows:
            entry, leave, *rest = row
            category = rest[0] if rest else "GREEN"
            if len(rest) > 1:
                duration = rest[1]
            else:
                length = datetime.fromisoformat(leave) - datetime.fromisoformat(entry)
                duration = length.total_seconds() / 60
            full.append((entry, leave, category, duration))
        return clean.typed(text_rows(spark, full, clean.VISIT_COLUMNS))

    return make


def rows_of(df, *columns):
    """Collected rows as sorted tuples of the given columns."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
