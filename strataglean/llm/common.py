"""What several of the operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words between ASCII white space, in the SQL that checks an operator.
WORDS_SQL = r"list_filter(string_split_regex({}, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def whole_text(column: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` equals in any case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null; the keys come once, from the left."""
    other = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return left.join(other, on, how).drop(*[f"_r_{c}" for c in keys])


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker makes once and keeps from task to task."""
    store = vars(sys.modules.setdefault("kept_by_worker", ModuleType("kept_by_worker")))
    if key not in store:
        store[key] = make()
    return store[key]
