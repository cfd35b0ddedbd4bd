"""Command line: ``spark-submit``-able jobs, in the order load, explore, clean, then
matrix, topics, names, tune and factors as wanted."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from platewise import schemas, session
from platewise.operators import als, lda
from platewise.plans import clean, explore, factors, load, topics
from platewise.sources import catalog, files, jdbc


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="platewise")
    parser.add_argument("--master")
    parser.add_argument("--database", default=schemas.DATABASE)
    parser.add_argument("--shuffle-partitions", type=int)
    parser.add_argument("--hive", action="store_true", help="keep tables in the cluster's metastore")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("load", help="ratings (JSON lines) and meal list (JDBC or JSON lines) into the catalog")
    job.add_argument("--ratings", required=True)
    meals = job.add_mutually_exclusive_group(required=True)
    meals.add_argument("--meals-json")
    meals.add_argument("--meals-url")
    job.add_argument("--meals-table", default="meal_list")
    job.add_argument("--meals-driver", default=jdbc.JdbcTable.driver)
    job.add_argument("--meals-rows", type=int, help="largest mealno; splits the read over --meals-partitions")
    job.add_argument("--meals-partitions", type=int, default=8)
    job.add_argument("--broken", choices=["set_aside", "fail"], default="set_aside", help="lines that do not parse")

    job = jobs.add_parser("explore", help="report files")
    job.add_argument("--out", required=True)
    job.add_argument("--form", choices=["csv", "json"], default="csv")
    job.add_argument("--mode", choices=["overwrite", "errorifexists", "ignore"], default="overwrite")
    job.add_argument("--single-file", action="store_true", help="one file per report, written by one task")

    job = jobs.add_parser("clean", help="cleaned table and split files")
    job.add_argument("--splits")
    job.add_argument("--keep-ids", action="store_true", help="users and meals keep the ids of the last run")
    job.add_argument("--exact", action="store_true", help="split files of exactly their shares")
    job.add_argument("--buckets", type=int, help="buckets of the cleaned table, by user")

    job = jobs.add_parser("matrix", help="user x meal matrix as a table")
    job.add_argument("--wide", action="store_true", help="one column per meal, for short meal lists")
    job.add_argument("--min-avg-rating", type=float)

    job = jobs.add_parser("topics", help="lists from LDA")
    job.add_argument("--k", type=int, default=10)
    job.add_argument("--max-iter", type=int, default=lda.ITERATIONS)
    job.add_argument("--mode", choices=["mix", "positional"], default="mix")
    job.add_argument("--min-avg-rating", type=float)
    job.add_argument("--from-matrix", action="store_true", help="take the cells from the saved matrix")
    job.add_argument("--partitions", type=int, default=lda.PARTITIONS)
    job.add_argument("--solver", choices=["driver", "rows"], default="driver", help="rows keeps the topics in a table")
    job.add_argument("--most-cells", type=int, default=lda.MATRIX_CELLS, help="topics x meals that the driver may hold")
    job.add_argument("--seed", type=int, default=1)

    jobs.add_parser("names", help="saved id lists into name lists")

    job = jobs.add_parser("tune", help="LDA quality per number of iterations")
    job.add_argument("--k", type=int, default=10)
    job.add_argument("--iterations", type=int, nargs="+", default=list(lda.SWEEP))
    job.add_argument("--parallelism", type=int, default=4, help="models fitted at a time")
    job.add_argument("--from-matrix", action="store_true", help="take the cells from the saved matrix")
    job.add_argument("--partitions", type=int, default=lda.PARTITIONS)
    job.add_argument("--solver", choices=["driver", "rows"], default="driver", help="rows keeps the topics in a table")
    job.add_argument("--most-cells", type=int, default=lda.MATRIX_CELLS, help="topics x meals that the driver may hold")
    job.add_argument("--seed", type=int, default=1)

    job = jobs.add_parser("factors", help="lists from ALS")
    job.add_argument("--n", type=int, default=als.MEALS)
    job.add_argument("--rank", type=int, default=als.RANK)
    job.add_argument("--max-iter", type=int, default=als.ITERATIONS)
    job.add_argument("--alpha", type=float, default=als.ALPHA)
    job.add_argument("--regularisation", type=float, default=als.REGULARISATION)
    job.add_argument("--user-blocks", type=int)
    job.add_argument("--meal-blocks", type=int)
    job.add_argument("--solver", choices=["blocks", "sums"], default="blocks", help="sums splits hot meals and users")
    job.add_argument("--exclude-seen", action="store_true", help="list only meals that the user has not rated")
    job.add_argument("--seed", type=int, default=1)
    return parser


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "load":
        if args.meals_json:
            meals = files.read_meals(spark, args.meals_json)
        else:
            source = jdbc.JdbcTable(args.meals_url, args.meals_table, args.meals_driver)
            split = ("mealno", 1, args.meals_rows, args.meals_partitions) if args.meals_rows else ()
            meals = jdbc.read_jdbc(spark, source, *split)
        load.load(spark, files.read_ratings(spark, args.ratings), meals, args.database, args.broken).show()
    elif args.job == "explore":
        catalog.use_database(spark, args.database)
        ratings = catalog.read_table(spark, schemas.MEAL_RATING)
        meals = catalog.read_table(spark, schemas.MEAL_LIST_TABLE)
        explore.write_reports(ratings, meals, args.out, args.form, args.mode, args.single_file)
    elif args.job == "clean":
        clean.run(spark, args.splits, args.database, args.keep_ids, args.exact, args.buckets).show()
    elif args.job == "matrix":
        topics.save_matrix(spark, args.wide, args.min_avg_rating, args.database)
    elif args.job == "names":
        catalog.use_database(spark, args.database)
        topics.name_meals(spark, catalog.read_table(spark, schemas.USER_MEAL_IDS)).show()
    elif args.job == "topics":
        topics.run(
            spark, args.k, args.max_iter, args.mode, args.min_avg_rating, args.seed, args.database, args.from_matrix,
            args.partitions, args.solver, args.most_cells,
        ).show()
    elif args.job == "tune":
        topics.tune(
            spark, args.k, args.iterations, args.seed, args.database, args.from_matrix, args.parallelism, args.partitions,
            args.solver, args.most_cells,
        ).show()
    elif args.job == "factors":
        blocks = {"user_blocks": args.user_blocks, "meal_blocks": args.meal_blocks} if args.solver == "blocks" else {}
        factors.run(
            spark, args.n, args.seed, args.database, args.exclude_seen, args.solver, rank=args.rank,
            max_iter=args.max_iter, alpha=args.alpha, regularisation=args.regularisation, **blocks,
        ).show()


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = session.build("platewise", args.master, args.shuffle_partitions, args.hive)
    try:
        _run(spark, args)
    finally:
        session.drop_staged(spark)


if __name__ == "__main__":
    main()
