"""Declarative data-quality tests whose result is a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL, UNIQUE = "not_null", "unique"


@dataclass(frozen=True)
class ModelTests:
    """Which columns of a model must not be NULL and which must hold no value twice."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()


# The standard suite of twelve tests.
STANDARD_SUITE: dict[str, ModelTests] = {
    "stg_members": ModelTests(not_null=("member_id", "full_name", "group_id", "season")),
    "dim_group": ModelTests(not_null=("group_sk", "group_id"), unique=("group_sk", "group_id")),
    "dim_member": ModelTests(not_null=("member_sk", "member_id", "is_current"), unique=("member_sk",)),
}


def _result(model: str, column: Column, test: str) -> list[Column]:
    failures = F.coalesce(F.col("failures"), F.lit(0)).cast("bigint")
    return [
        F.lit(model).alias("model"),
        column.alias("column_name"),
        F.lit(test).alias("test"),
        failures.alias("failures"),
        (failures == 0).alias("passed"),
    ]


def check_not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns counted in a single aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [value for c in columns for value in (F.lit(c), F.col(f"`{c}`"))]
    long = counts.select(F.stack(F.lit(len(columns)), *pairs).alias("_column", "failures"))
    return long.select(*_result(model, F.col("_column"), NOT_NULL))


def check_unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """How many distinct values of ``column`` occur more than once; NULLs do not count."""
    repeated = (
        df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    )
    total = repeated.agg(F.count("*").alias("failures"))
    return total.select(*_result(model, F.lit(column), UNIQUE))


def check_model(df: DataFrame, model: str, tests: ModelTests) -> Iterable[DataFrame]:
    """All tests of a model in as few passes as it has unique columns, in one if it has none.

    The pass over a unique column counts the NULLs of all columns on its way.
    """
    if not tests.unique:
        if tests.not_null:
            yield check_not_null(df, model, tests.not_null)
        return
    first, *others = tests.unique
    nulls = {f"_null_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(tests.not_null)}
    values = df.groupBy(F.col(first).alias("_value")).agg(
        F.count("*").alias("_n"), *[count.alias(name) for name, count in nulls.items()]
    )
    totals = values.agg(
        F.count_if(F.col("_value").isNotNull() & (F.col("_n") > 1)).alias("_repeated"),
        *[F.sum(name).alias(name) for name in nulls],
    )
    found = [(F.lit(c), F.lit(NOT_NULL), F.col(name)) for c, name in zip(tests.not_null, nulls)]
    found.append((F.lit(first), F.lit(UNIQUE), F.col("_repeated")))
    long = totals.select(
        F.stack(F.lit(len(found)), *[x for row in found for x in row]).alias("_column", "_test", "_failures")
    )
    failures = F.coalesce(F.col("_failures"), F.lit(0)).cast("bigint")
    yield long.select(
        F.lit(model).alias("model"), F.col("_column").alias("column_name"), F.col("_test").alias("test"),
        failures.alias("failures"), (failures == 0).alias("passed"),
    )
    for column in others:
        yield check_unique(df, model, column)


def run_suite(models: Mapping[str, DataFrame], suite: Mapping[str, ModelTests]) -> DataFrame:
    """Results of all tests: (model, column_name, test, failures, passed)."""
    checks = (check for model, tests in suite.items() for check in check_model(models[model], model, tests))
    return reduce(DataFrame.unionByName, checks)


def failing_rows(df: DataFrame, model: str, tests: ModelTests, show: Sequence[str]) -> DataFrame:
    """The rows that fail a test: (model, column_name, test) and the columns ``show``, once per test failed.

    Rows with a value that occurs more than once are all listed. One pass finds the NULLs of all columns.
    """
    named = [F.when(F.col(c).isNull(), F.lit(c)) for c in tests.not_null]
    parts = []

    def listed(rows: DataFrame, column: Column, test: str) -> DataFrame:
        return rows.select(F.lit(model).alias("model"), column.alias("column_name"), F.lit(test).alias("test"), *show)

    if named:
        missing = df.withColumn("_column", F.explode(F.array_compact(F.array(*named))))
        parts.append(listed(missing, F.col("_column"), NOT_NULL))
    for c in tests.unique:
        values = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_value")).count().where(F.col("count") > 1)
        repeated = df.join(values, F.col(c) == F.col("_value"), "left_semi")
        parts.append(listed(repeated, F.lit(c), UNIQUE))
    return reduce(DataFrame.unionByName, parts)
