import pytest

from platewise.operators import reports

ROWS = [
    ("u1", "a", 5.0, "x", 1),
    ("u2", "a", 5.0, "x", 2),
    ("u3", "b", 5.0, "y", 3),
    ("u4", "b", 5.0, "y", 4),
    ("u5", "c", 5.0, "y", 5),
    ("u1", "c", 1.0, "z", 6),
    ("u2", None, 1.0, "z", 7),
    ("u3", "a", None, None, 8),
]


def rows(df, *columns):
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


def test_counts(rate):
    got = rows(reports.count_by(rate(ROWS), "MealID", "Review"), "MealID", "Review", "count")
    assert ("a", "x", 2) in got and ("a", None, 1) in got and (None, "z", 1) in got
    assert sum(count for *_, count in got) == len(ROWS)


def test_share_counts_missing_ratings_in_the_total_only(rate):
    got = {row["Rating"]: (row["sum"], row["weights"]) for row in reports.rating_share(rate(ROWS)).collect()}
    assert got == {5.0: (5, 62.5), 1.0: (2, 25.0), None: (0, 0.0)}


def test_share_rounds_half_up(rate):
    # 1 of 32 is 3.125 percent exactly; 1 of 16,000 is 0.00625.
    many = [("u", "m", 1.0, "", 0)] + [("u", "m", 2.0, "", 0)] * 31
    got = {row["Rating"]: row["weights"] for row in reports.rating_share(rate(many)).collect()}
    assert got == {1.0: 3.125, 2.0: 96.875}


def test_share_reads_the_ratings_once(rate):
    share = reports.rating_share(rate(ROWS))
    share.collect()
    assert "ReusedExchange" in share._jdf.queryExecution().executedPlan().toString()


def test_meal_counts_keep_missing_meals_as_zero(rate):
    got = rows(reports.meal_counts_per_rating(rate(ROWS)), "Rating", "MealID", "Count")
    assert (1.0, None, 0) in got and (5.0, "a", 2) in got and (None, "a", 1) in got


def test_extremes_with_ties(rate, meal_list):
    names = meal_list([("a", "A"), ("b", "B"), ("c", "C"), (None, "nothing")])
    top = rows(reports.top_meal_per_rating(rate(ROWS), names), "Rating", "MealID", "MaxCount", "meal_name")
    assert top == [(1.0, "c", 1, "C"), (5.0, "b", 2, "B"), (None, "a", 1, "A")]
    low = rows(reports.bottom_meal_per_rating(rate(ROWS), names), "Rating", "MealID", "MinCount", "meal_name")
    assert low == [(1.0, "c", 1, "C"), (5.0, "c", 1, "C"), (None, "a", 1, "A")]


def test_top_limits_before_it_names(rate, meal_list):
    ratings = rate([("u", f"m{i:02d}", 5.0, "", 0) for i in range(15)] + [("u", "m14", 5.0, "", 1)])
    names = meal_list([(f"m{i:02d}", f"name {i}") for i in range(15) if i != 3])
    got = [row["MealID"] for row in reports.top_sales(ratings, names).collect()]
    # m14 leads with two; of the tied rest the first nine follow, one of them without a name.
    assert got == ["m14"] + [f"m{i:02d}" for i in range(9) if i != 3]


def test_top_rated_takes_one_rating(rate, meal_list):
    names = meal_list([("a", "A"), ("b", "B"), ("c", "C")])
    got = [(r["MealID"], r["Count"], r["Rating"]) for r in reports.top_rated(rate(ROWS), names).collect()]
    assert got == [("a", 2, 5.0), ("b", 2, 5.0), ("c", 1, 5.0)]


def test_all_reports_equal_the_single_ones(rate, meal_list):
    ratings, names = rate(ROWS), meal_list([("a", "A"), ("b", "B"), ("c", "C")])
    expected = {
        "RatingType": reports.rating_share(ratings),
        "result2": reports.top_meal_per_rating(ratings, names),
        "result3": reports.bottom_meal_per_rating(ratings, names),
        "top10": reports.top_sales(ratings, names),
        "RatingTop10": reports.top_rated(ratings, names),
    }
    found = reports.all_reports(ratings, names)
    assert list(found) == list(expected)
    for name, frame in found.items():
        assert frame.dtypes == expected[name].dtypes
        assert sorted(frame.collect(), key=repr) == sorted(expected[name].collect(), key=repr)


def test_row_counts(rate):
    frame = rate(ROWS)
    got = {row["stage"]: row["rows"] for row in reports.row_counts({"all": frame, "none": frame.limit(0)}).collect()}
    assert got == {"all": 8, "none": 0}


@pytest.mark.parametrize("build", [reports.top_sales, reports.top_rated])
def test_top_is_taken_without_a_full_sort(build, rate, meal_list, plan_of):
    plan = plan_of(build(rate(ROWS), meal_list([("a", "A")])))
    assert "TakeOrderedAndProject" in plan and "CartesianProduct" not in plan
