import json
from pathlib import Path

import pytest

from platewise import schemas, session
from platewise.sources import catalog, files, jdbc

ROW = {"UserID": "u", "MealID": "m", "Rating": 4.0, "Review": "fine", "ReviewTime": 7}


def test_json_scan_keeps_broken_lines(spark, tmp_path):
    path = tmp_path / "ratings.json"
    path.write_text("\n".join([json.dumps(ROW), "{broken", json.dumps({"UserID": "v", "extra": 1})]))
    got = {r["UserID"]: r for r in files.read_ratings(spark, str(path)).collect()}
    assert got["u"]["Rating"] == 4.0 and got["u"][schemas.CORRUPT] is None
    assert got[None][schemas.CORRUPT] == "{broken"
    assert got["v"]["MealID"] is None and got["v"][schemas.CORRUPT] is None


def test_json_round_trip(spark, rate, tmp_path):
    path = str(tmp_path / "out")
    df = rate([tuple(ROW.values()), ("ü", None, None, "汉字", 1)])
    files.write_json(df, path)
    files.write_json(df, path)
    back = files.read_ratings(spark, path).drop(schemas.CORRUPT)
    assert back.schema == df.schema and back.exceptAll(df).count() == 0 and back.count() == 2


def test_meals_from_json(spark, tmp_path):
    path = tmp_path / "meals.json"
    path.write_text(json.dumps({"mealno": 1, "mealID": None, "meal_name": "soup"}))
    row = files.read_meals(spark, str(path)).first()
    assert (row["mealno"], row["mealID"], row["meal_name"]) == (1, None, "soup")


def test_csv_modes_and_single_file(spark, tmp_path):
    path = tmp_path / "report"
    df = spark.range(40).repartition(4)
    files.write_csv(df, str(path), mode="errorifexists", single_file=True)
    assert len(list(path.glob("part-*"))) == 1
    assert sorted(int(r["_c0"]) for r in spark.read.csv(str(path)).collect()) == list(range(40))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_csv(df, str(path), mode="errorifexists")
    files.write_csv(df, str(path), header=True)
    assert spark.read.option("header", True).csv(str(path)).columns == ["id"]
    many = spark.range(100_001).repartition(4)
    files.write_csv(many, str(path), single_file=True)
    assert len(list(path.glob("part-*"))) == 1 and spark.read.csv(str(path)).count() == 100_001


def test_catalog(spark, rate, tmp_path):
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, "catalog_test", str(tmp_path / "db"))
    try:
        df = rate([tuple(ROW.values())])
        catalog.save_table(df, "t")
        saved = catalog.save_table(df.unionByName(df), "t")
        assert spark.catalog.currentDatabase() == "catalog_test"
        assert saved.count() == 2 == catalog.read_table(spark, "T").count()
    finally:
        spark.catalog.setCurrentDatabase(before)


class Recorder:
    """Stands in for a session: a database of its own is not available to the tests."""

    def __init__(self):
        self.read = self
        self.calls = []

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))


def test_jdbc_arguments(monkeypatch):
    monkeypatch.setenv("MEAL_DB_USER", "reader")
    monkeypatch.delenv("MEAL_DB_PASSWORD", raising=False)
    source, spark = jdbc.JdbcTable("jdbc:x", "meal_list", "some.Driver"), Recorder()
    jdbc.read_jdbc(spark, source)
    jdbc.read_jdbc(spark, source, "mealno", 1, 2034, 4)
    (plain, plain_options), (_, split_options) = spark.calls
    assert plain == ("jdbc:x", "meal_list")
    assert plain_options["properties"] == {"driver": "some.Driver", "fetchsize": "10000", "user": "reader"}
    assert (split_options["column"], split_options["lowerBound"], split_options["upperBound"],
            split_options["numPartitions"]) == ("mealno", 1, 2034, 4)
    with pytest.raises(ValueError, match="partitioned read"):
        jdbc.read_jdbc(spark, source, "mealno")


def test_require(spark, rate):
    assert schemas.require(rate([]).withColumnRenamed("UserID", "userid"), schemas.RATING)
    with pytest.raises(ValueError, match="Review is missing"):
        schemas.require(rate([]).drop("Review"), schemas.RATING)
    with pytest.raises(ValueError, match="ReviewTime is string, not bigint"):
        schemas.require(rate([]).selectExpr("UserID", "MealID", "Rating", "Review", "Review as ReviewTime"), schemas.RATING)


def test_staging_uses_the_shared_folder(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.staging_root(spark) == root
    assert session.staged_path(spark, "x").startswith(root)
    staged = session.stage(spark.range(5), "five")
    assert staged.count() == 5 and staged.inputFiles()[0].removeprefix("file://").startswith(root)
    assert spark.sparkContext.getCheckpointDir() is not None


def test_staged_data_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "staging_root", lambda _: str(tmp_path))
    session.stage(spark.range(5), "five")
    assert list(tmp_path.rglob("*.parquet"))
    session.drop_staged(spark)
    assert not list(tmp_path.iterdir())


def test_a_local_session_without_a_shared_folder_keeps_its_own(spark):
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = spark.sparkContext, Conf()

    assert session.staging_root(Session()) == session.staging_root(Session()) == spark.sparkContext.getCheckpointDir()


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_root(Session())


def test_fixed_order_does_not_depend_on_the_input_s_partitions(spark):
    rows = [
        session.in_fixed_order(spark.range(500).repartition(n), 7, "id").rdd.glom().map(lambda p: [r[0] for r in p]).collect()
        for n in (2, 8)
    ]
    assert rows[0] == rows[1] and len(rows[0]) == 7 and all(part == sorted(part) for part in rows[0])


def test_a_scope_deletes_what_was_staged_in_it(spark):
    with session.scope(spark):
        staged = session.stage(spark.range(5), "five")
        folder = Path(staged.inputFiles()[0].removeprefix("file://")).parent
        assert staged.count() == 5
    assert not folder.exists() and not folder.parent.exists()


def test_broken_lines_are_counted_and_set_aside(spark, tmp_path):
    from platewise.plans import load

    path, before = tmp_path / "ratings.json", spark.catalog.currentDatabase()
    path.write_text("\n".join([json.dumps(ROW), "not json", json.dumps(ROW | {"Rating": "5"})]))
    meals = spark.createDataFrame([(1, "m", "soup")], schemas.MEAL_LIST)
    try:
        audit = load.load(spark, files.read_ratings(spark, str(path)), meals, "broken_test")
        got = {r["stage"]: r["rows"] for r in audit.collect()}
        assert got == {schemas.MEAL_RATING: 1, schemas.BAD_RATINGS: 2, schemas.MEAL_LIST_TABLE: 1, schemas.BAD_MEALS: 0}
        assert "not json" in {r[0] for r in catalog.read_table(spark, schemas.BAD_RATINGS).collect()}
        with pytest.raises(ValueError, match="do not parse"):
            load.load(spark, files.read_ratings(spark, str(path)), meals, "broken_test", broken="fail")
        assert catalog.read_table(spark, schemas.MEAL_RATING).count() == 1
    finally:
        spark.catalog.setCurrentDatabase(before)
