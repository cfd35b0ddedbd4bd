"""Reports over the raw ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from platewise.operators import repeats, reports
from platewise.sources.files import write_csv, write_json


def write_reports(
    ratings: DataFrame,
    meals: DataFrame,
    folder: str,
    form: str = "csv",
    mode: str = "overwrite",
    single_file: bool = False,
) -> None:
    """The five reports, as one file each if wanted, and the repeated ratings in the files they fill."""
    write = {"csv": write_csv, "json": write_json}[form]
    for name, frame in reports.all_reports(ratings, meals).items():
        write(frame, f"{folder}/{name}.{form}", mode=mode, single_file=single_file)
    write(repeats.repeat_ratings(ratings), f"{folder}/repeats.{form}", mode=mode)
