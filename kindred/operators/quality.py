"""Data-quality checks beside the stages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Minimum rows of a bronze input, by default and per catalogue file.
MIN_ROWS = 10
MIN_ROWS_PER_FILE = 100


class QualityError(ValueError):
    """A check of severity ``fail`` did not pass."""


def check_min_rows(inputs: Mapping[str, DataFrame], minimum: Mapping[str, int] | None = None,
                   default: int = MIN_ROWS) -> DataFrame:
    """One row per input: rows, the rule, ``passed`` and the severity. An empty input
    or one below its minimum is a warning."""
    minimum = minimum or {}
    report = None
    for name, df in inputs.items():
        least = minimum.get(name, default)
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("input"), "rows", F.lit(least).alias("min_rows"),
            (F.col("rows") > 0).alias("not_empty"),
            (F.col("rows") >= least).alias("passed"),
            F.when(F.col("rows") >= least, "ok").otherwise("warn").alias("severity"))
        report = row if report is None else report.unionByName(row)
    if report is None:
        raise QualityError("no input present")
    return report


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fails on an empty table; reads no more than one row of it."""
    if df.isEmpty():
        raise QualityError(f"{what} is empty")
    return df


def counted(df: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """``df`` plus an observation that holds its row count once an action ran."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def verify_count(stored: DataFrame, expected: int) -> int:
    """The stored table must hold exactly the rows that were written."""
    actual = stored.count()
    if actual != expected:
        raise QualityError(f"expected {expected} items, found {actual}")
    return actual
