import pytest
from pyspark.sql import SparkSession

from usagelens.schemas import SOURCES


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sources(spark):
    """Build a source table from ``{path: content}``, all in one repo."""

    def build(files, repo="r"):
        return spark.createDataFrame([(repo, p, c) for p, c in files.items()], SOURCES)

    return build


def rows(df, *columns):
    """Rows as a sorted list of tuples, nested values included."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
