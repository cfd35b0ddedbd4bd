"""Time the headline steps at one scale and print one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of local cores. Every query
is built and written to the no-op sink, so all rows and columns are computed. As in the jobs, the
ratings are loaded into a table first ("load"), and the later steps read that table.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from platewise import session  # noqa: E402
from platewise.operators import als, keys, lda, matrix, repeats, reports, splits  # noqa: E402
from platewise.plans import clean, factors, topics  # noqa: E402
from platewise.sources import order_tables  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    session.configure(spark)
    times: dict[str, float] = {}
    stored: dict[str, DataFrame] = {}

    def timed(name, step):
        start = time.perf_counter()
        result = step()
        if isinstance(result, DataFrame):
            run(result)
        times[name] = round(time.perf_counter() - start, 3)
        return result

    def keep(name, df):
        stored[name] = session.stage(df, name)

    source = order_tables.ratings(spark, FOLDER)
    run(source)  # start-up of the JVM and the file cache is not a query
    timed("load", lambda: keep("ratings", source))
    ratings, meals = stored["ratings"], order_tables.meals(spark, FOLDER)
    timed("ratings_per_user", lambda: reports.count_by(ratings, "UserID"))
    timed("rating_share", lambda: reports.rating_share(ratings))
    timed("top_meal_per_rating", lambda: reports.top_meal_per_rating(ratings, meals))
    timed("bottom_meal_per_rating", lambda: reports.bottom_meal_per_rating(ratings, meals))
    timed("top10_sales", lambda: reports.top_sales(ratings, meals))
    timed("top10_five_star", lambda: reports.top_rated(ratings, meals))
    timed("duplicate_total", lambda: repeats.duplicate_total(ratings))
    timed("repeat_rows", lambda: repeats.repeat_ratings(ratings))
    timed("latest_rating", lambda: repeats.latest_ratings(ratings))
    timed("user_index", lambda: keys.dense_index(ratings, "UserID", "UserIndex"))

    timed("clean_and_encode", lambda: keep("cleaned", clean.clean(ratings, meals)))
    cleaned = stored["cleaned"]
    timed("split_assignment", lambda: splits.assign_parts(cleaned))
    timed("avg_rating_per_meal", lambda: matrix.average_ratings(cleaned))

    model, test = timed("als_fit", lambda: factors.split_and_fit(cleaned))
    timed("als_rmse", lambda: als.rmse(als.predictions(model, test)))
    timed("als_recommendations", lambda: factors.named_lists(cleaned, als.recommend(model)))

    features, positions = timed("sparse_matrix", lambda: topics.features_of(cleaned))
    topic_model = timed("lda_fit_k10_100_iterations", lambda: lda.fit(features, 10))
    terms = lda.topic_terms(topic_model, positions)
    timed("lda_recommendations", lambda: lda.recommend_by_mix(topic_model, features, terms))
    timed("lda_sweep_of_seven", lambda: lda.fit_metrics(features, 10))

    scale = Path(FOLDER).name.removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
