import pytest
from pyspark.sql import SparkSession

from snapmill.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        configure(SparkSession.builder)
        .master("local[*]")
        .appName("snapmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def either_mode(spark, request):
    """Results must not depend on ANSI mode."""
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.unset("spark.sql.ansi.enabled")
