"""The jobs in order, through the command line's own dispatch, on a small database."""

import json
import random
import subprocess
import sys
from pathlib import Path

import pytest

from platewise import __main__ as cli
from platewise import schemas, session
from platewise.operators import matrix, splits

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    chance = random.Random(2)
    with open(folder / "ratings.json", "w") as out:
        for _ in range(3000):
            row = {
                "UserID": f"u{chance.randrange(80)}",
                "MealID": f"m{chance.randrange(45)}",
                "Rating": float(chance.randrange(1, 6)),
                "Review": "text",
                "ReviewTime": 1493596800 + chance.randrange(61 * 86400),
            }
            out.write(json.dumps(row) + "\n")
    with open(folder / "meals.json", "w") as out:
        for number in range(50):
            # Meals 40..44 are rated but unlisted: their entries have no id.
            meal = f"m{number}" if number < 40 else None
            out.write(json.dumps({"mealno": number + 1, "mealID": meal, "meal_name": f"菜{number}"}) + "\n")
    return folder


def test_all_jobs(spark, inputs, capsys):
    before = spark.catalog.currentDatabase()

    def run(*argv):
        cli._run(spark, cli._parser().parse_args(["--database", "jobs_test", *argv]))

    try:
        run("load", "--ratings", str(inputs / "ratings.json"), "--meals-json", str(inputs / "meals.json"))
        run("explore", "--out", str(inputs / "reports"))
        run("explore", "--out", str(inputs / "reports"), "--form", "json")
        for name in ("RatingType", "result2", "result3", "top10", "RatingTop10"):
            assert spark.read.csv(str(inputs / "reports" / f"{name}.csv")).count() > 0
            assert spark.read.json(str(inputs / "reports" / f"{name}.json")).count() > 0

        run("clean", "--splits", str(inputs / "splits"))
        cleaned = spark.read.table(schemas.CLEANED)
        assert cleaned.count() == cleaned.select("UserID", "MealID").distinct().count()
        assert cleaned.filter("meal_name is null or mealno > 40").count() == 0
        parts = [spark.read.json(str(inputs / "splits" / f"{n}data.json")).count() for n in ("train", "test", "verify")]
        assert sum(parts) == cleaned.count() and parts[0] > parts[1] > 0 < parts[2]

        raw = spark.read.table(schemas.MEAL_RATING).select("UserID", "MealID")
        users = cleaned.select("UserID").distinct().count()
        assert spark.read.csv(str(inputs / "reports" / "repeats.csv")).count() == 3000 - raw.distinct().count()

        run("matrix")
        assert spark.read.table(schemas.MATRIX).count() == cleaned.count()
        run("matrix", "--wide")
        wide = spark.read.table(schemas.MATRIX)
        assert wide.columns == ["UserID"] + sorted(f"m{i}" for i in range(40)) and wide.count() == users
        run("topics", "--k", "4", "--max-iter", "5")
        assert spark.read.table(schemas.USER_MEAL_IDS).count() == users
        listed = spark.read.table(schemas.LDA_LIST)
        assert listed.columns == ["UserID", "meal_name_list"] and listed.count() == users

        run("topics", "--k", "4", "--max-iter", "5", "--mode", "positional", "--min-avg-rating", "2.5")
        assert spark.read.table(schemas.USER_MEAL_IDS).count() == 4

        run("names")
        assert spark.read.table(schemas.LDA_LIST).count() == 4
        run("topics", "--k", "3", "--max-iter", "2", "--solver", "rows")
        assert spark.read.table(schemas.USER_MEAL_IDS).count() == users

        run("factors")
        recommended = spark.read.table(schemas.ALS_LIST)
        assert recommended.columns == ["UserID", "meal_name_list"] and recommended.count() == users
        assert recommended.filter("size(meal_name_list) <> 10").count() == 0

        run("factors", "--solver", "sums", "--max-iter", "2", "--exclude-seen")
        rated = cleaned.groupBy("UserID").count().collect()
        names = {r["UserID"]: len(r["meal_name_list"]) for r in spark.read.table(schemas.ALS_LIST).collect()}
        assert names == {r["UserID"]: min(10, 40 - r["count"]) for r in rated if r["count"] < 40}

        # a second load: earlier ids stay, exact parts, and a table whose users need no shuffle
        old = {r["UserID"]: r["UserIndex"] for r in cleaned.select("UserID", "UserIndex").distinct().collect()}
        more = inputs / "more.json"
        extra = {"UserID": "a-new-user", "MealID": "m1", "Rating": 3.0, "Review": "text", "ReviewTime": 1493596800}
        more.write_text((inputs / "ratings.json").read_text() + json.dumps(extra) + "\n")
        run("load", "--ratings", str(more), "--meals-json", str(inputs / "meals.json"))
        run("clean", "--keep-ids", "--exact", "--buckets", "3", "--splits", str(inputs / "exact"))
        cleaned = spark.read.table(schemas.CLEANED)
        assert {r["UserID"]: r["UserIndex"] for r in cleaned.select("UserID", "UserIndex").distinct().collect()} == (
            old | {"a-new-user": len(old)}
        )
        parts = [spark.read.json(str(inputs / "exact" / f"{n}data.json")).count() for n in ("train", "test", "verify")]
        assert parts == list(splits.exact_sizes(cleaned.count(), splits.SHARES).values())
        per_user = cleaned.groupBy("UserID").count()
        assert per_user.count() == len(old) + 1
        plan = per_user._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(UserID" not in plan and "Bucketed: true" in plan
        positions = session.stage(matrix.meal_positions(cleaned), "positions")
        plan = matrix.vector_rows(cleaned.select("UserID", "MealID", "Rating"), positions)._jdf.queryExecution()
        assert "hashpartitioning(UserID" not in plan.executedPlan().toString()

        capsys.readouterr()
        from platewise.plans import topics

        assert topics.tune(spark, 3, (1, 2), database="jobs_test").count() == 2
        assert topics.tune(spark, 3, (1, 2), database="jobs_test", solver="rows").count() == 2
        with pytest.raises(ValueError, match="most_cells"):
            topics.tune(spark, 3, (1, 2), database="jobs_test", most_cells=10)
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_command_line_in_a_process_of_its_own(inputs, tmp_path):
    command = [sys.executable, str(ROOT / "run_platewise.py"), "--master", "local[2]", "--shuffle-partitions", "2"]
    command += ["load", "--ratings", str(inputs / "ratings.json"), "--meals-json", str(inputs / "meals.json")]
    done = subprocess.run(command, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert list((tmp_path / "spark-warehouse").rglob("*.parquet"))


def test_meal_list_needs_one_source():
    with pytest.raises(SystemExit):
        cli._parser().parse_args(["load", "--ratings", "x"])
