import pytest
from pyspark.sql import functions as F

from platewise.operators import keys


def test_ids_are_dense_and_in_key_order_over_many_partitions(spark):
    names = [f"k{(i * 7919) % 5000}" for i in range(5000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(n,) for n in names] * 2 + [(None,)] * 3, "key string").repartition(6)
        index = keys.dense_index(df, "key", "id")
        again = keys.dense_index(df, "key", "id")
        got = {r["key"]: r["id"] for r in index.collect()}
        assert got == {name: i for i, name in enumerate(sorted(names))}
        assert got == {r["key"]: r["id"] for r in again.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ids_of_one_key_holding_a_third(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    got = keys.dense_index(df, "key", "id").agg(F.count("*"), F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(got) == (6001, 0, 6000, 6001)


def test_empty_index(spark):
    assert keys.dense_index(spark.createDataFrame([], "key string"), "key", "id").count() == 0


def test_encode_drops_unlisted_meals(spark, rate, meal_list):
    latest = rate([("u2", "b", 1.0, "r", 1), ("u1", "a", 2.0, "r", 2), ("u1", "gone", 3.0, "r", 3), ("u3", None, 1.0, "r", 4)])
    users = keys.dense_index(latest, "UserID", "UserIndex")
    meal_index = keys.dense_index(latest, "MealID", "MealIndex")
    cleaned = keys.encode(latest, users, meal_index, meal_list([("a", "A"), ("b", "B"), (None, "no id")]))
    assert cleaned.columns == [
        "MealID", "UserID", "Rating", "Review", "ReviewTime", "UserIndex", "MealIndex", "mealno", "meal_name",
    ]
    assert sorted(tuple(row) for row in cleaned.collect()) == [
        ("a", "u1", 2.0, "r", 2, 0, 0, 1, "A"),
        ("b", "u2", 1.0, "r", 1, 1, 1, 2, "B"),
    ]
    assert sorted(tuple(r) for r in keys.lookup(cleaned, "MealID", "meal_name").collect()) == [("a", "A"), ("b", "B")]


def test_ids_beyond_an_int_are_refused(spark):
    small = spark.createDataFrame([(1,), (2**31 - 1,), (None,)], "id bigint").select(keys.as_int_id("id"))
    assert small.schema["id"].dataType.simpleString() == "int"
    assert sorted((r["id"] or 0) for r in small.collect()) == [0, 1, 2**31 - 1]
    with pytest.raises(Exception, match="does not fit a 32-bit id"):
        spark.createDataFrame([(2**31,)], "id bigint").select(keys.as_int_id("id")).collect()


def test_extended_ids_keep_the_old_ones_and_stay_dense(spark):
    def table(names):
        return spark.createDataFrame([(name,) for name in names], "key string")

    known = keys.dense_index(table(["d", "b", "f", None]), "key", "id")
    for names in (["a", "b", "c", None, "a"], ["z", "a", "f"], ["b", "z"], []):
        before = {row["key"]: row["id"] for row in known.collect()}
        known = known.unionByName(keys.extend_index(known, table(names), "key", "id"))
        after = {row["key"]: row["id"] for row in known.collect()}
        assert before.items() <= after.items() and known.count() == len(after)
        assert sorted(after.values()) == list(range(len(after)))
        assert set(after) == set(before) | {name for name in names if name}
    assert after == {"b": 0, "d": 1, "f": 2, "a": 3, "c": 4, "z": 5}
    fresh = keys.extend_index(known.limit(0), table(["y", "x"]), "key", "id")
    assert {row["key"]: row["id"] for row in fresh.collect()} == {"x": 0, "y": 1}
