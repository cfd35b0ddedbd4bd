import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from platewise import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    made = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield session.configure(made)
    made.stop()


@pytest.fixture
def plan_of(capsys):
    """The physical plan of a frame as text."""

    def explain(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return explain


@pytest.fixture
def rate(spark):
    """Ratings frame from (user, meal, rating, review, time) tuples."""
    from platewise.schemas import RATING

    return lambda rows: spark.createDataFrame(rows, RATING)


@pytest.fixture
def meal_list(spark):
    """Meal list from (id, name) pairs, numbered from 1."""
    from platewise.schemas import MEAL_LIST

    return lambda pairs: spark.createDataFrame(
        [(number, meal, name) for number, (meal, name) in enumerate(pairs, 1)], MEAL_LIST
    )
