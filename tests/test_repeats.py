import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from platewise.operators import repeats


def brute_force(rows):
    """All rows but each pair's first by (time, rating, review); None sorts first."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0], row[1]].append(row)

    def age(row):
        return [(value is not None, value or 0) if i != 1 else (value is not None, value or "")
                for i, value in ((0, row[4]), (2, row[2]), (1, row[3]))]

    kept = Counter()
    for group in groups.values():
        kept.update(sorted(group, key=age)[1:])
    return kept


def found(df):
    return Counter((r["UserID"], r["MealID"], r["Rating"], r["Review"], r["ReviewTime"]) for r in df.collect())


EDGES = [
    ("u1", "a", 1.0, "old", 100),
    ("u1", "a", 2.0, "new", 200),
    ("u1", "a", 3.0, "newest", 300),
    ("u2", "a", 4.0, "x", 100),
    ("u2", "a", 5.0, "x", 100),
    ("u3", "a", 4.0, "same", 100),
    ("u3", "a", 4.0, "same", 100),
    ("u3", "a", 4.0, "same", 100),
    ("u4", "a", 4.0, None, 86399),
    (None, "b", 1.0, "n", 86399),
    (None, "b", 2.0, "n", 86400),
    ("u5", None, 2.0, "n", 5),
]


def test_latest(rate):
    got = found(repeats.latest_ratings(rate(EDGES)))
    assert got == Counter(
        [
            ("u1", "a", 3.0, "newest", 300),
            ("u2", "a", 5.0, "x", 100),
            ("u3", "a", 4.0, "same", 100),
            ("u4", "a", 4.0, None, 86399),
            (None, "b", 2.0, "n", 86400),
            ("u5", None, 2.0, "n", 5),
        ]
    )


def test_latest_cuts_each_pair_before_the_shuffle(rate, plan_of):
    plan = plan_of(repeats.latest_ratings(rate(EDGES)))
    assert plan.count("WindowGroupLimit") >= 2


def test_duplicates(rate):
    got = {(r["UserID"], r["MealID"]): r["Count"] for r in repeats.duplicate_pairs(rate(EDGES)).collect()}
    assert got == {("u1", "a"): 3, ("u2", "a"): 2, ("u3", "a"): 3, (None, "b"): 2}
    assert repeats.duplicate_total(rate(EDGES)).first()["total"] == 10


def test_total_without_duplicates_is_null(rate):
    assert repeats.duplicate_total(rate(EDGES[:1])).first()["total"] is None


def test_repeats(rate):
    got = repeats.repeat_ratings(rate(EDGES))
    assert found(got) == brute_force(EDGES)
    days = {(r["UserID"], r["ReviewTime"]): r["review_date"] for r in got.collect()}
    assert days[None, 86400] == "1970-01-02" and days["u1", 200] == "1970-01-01"


def test_repeats_of_nothing(rate):
    assert repeats.repeat_ratings(rate(EDGES[:1])).count() == 0


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_repeats_with_a_pair_that_holds_a_third(spark, rate, threshold):
    """Half of the hot pair's rows are copies of each other; with and without a broadcast."""
    chance = random.Random(3)
    rows = [(f"u{chance.randrange(400)}", f"m{chance.randrange(40)}", float(chance.randrange(1, 6)),
             chance.choice(["good", "bad", None]), chance.randrange(1000)) for _ in range(6000)]
    rows += [("hot", "meal", 3.0, "copy", 17)] * 1500
    rows += [("hot", "meal", 3.0, "own", chance.randrange(10**6)) for _ in range(1500)]
    chance.shuffle(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert found(repeats.repeat_ratings(rate(rows).repartition(5))) == brute_force(rows)
        newest = repeats.latest_ratings(rate(rows))
        assert newest.count() == len({row[:2] for row in rows})
        assert newest.filter(F.col("UserID") == "hot").first()["ReviewTime"] == max(
            row[4] for row in rows if row[0] == "hot"
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_drilldowns(rate):
    assert found(repeats.repeats_of_user(rate(EDGES), "u1")) == Counter(
        {row: n for row, n in brute_force(EDGES).items() if row[0] == "u1"}
    )
    got = repeats.ratings_of_user_meal(rate(EDGES), "u4", "a").collect()
    assert [(r["ReviewTime"], r["review_date"]) for r in got] == [(86399, "1970-01-01")]


def test_drilldown_filter_reaches_the_scan(spark, rate, tmp_path, plan_of):
    path = str(tmp_path / "ratings")
    rate(EDGES).write.parquet(path)
    plan = plan_of(repeats.ratings_of_user_meal(spark.read.parquet(path), "u4", "a"))
    assert "EqualTo(UserID,u4)" in plan and "EqualTo(MealID,a)" in plan
