"""Declarative data tests and the constraint gate (O28a-e).

Each test returns a one-row-per-test DataFrame ``(test, model, column_name, failures)``;
``run_tests`` unions them. All not-null counts of one table come from a single
aggregation pass, and so do all its uniqueness tests: one grouping with partial
aggregation, so a hot value is pre-counted before the one shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ("test", "model", "column_name", "failures")


def _result(df: DataFrame, test: str, model: str, column: str, failures) -> DataFrame:
    return df.select(
        F.lit(test).alias("test"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        failures.cast("long").alias("failures"),
    )


def not_null(df: DataFrame, model: str, columns) -> DataFrame:
    """Number of nulls per column, all columns in one pass."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {stack}) AS (column_name, failures)").select(
        F.lit("not_null").alias("test"),
        F.lit(model).alias("model"),
        "column_name",
        F.col("failures").cast("long").alias("failures"),
    )


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    dup = df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    return _result(dup.agg(F.count(F.lit(1)).alias("n")), "unique", model, column, F.col("n"))


def unique_combination(df: DataFrame, model: str, columns) -> DataFrame:
    """O28d: number of column combinations that occur more than once."""
    columns = list(columns)
    dup = df.groupBy(*columns).count().where("count > 1")
    return _result(
        dup.agg(F.count(F.lit(1)).alias("n")), "unique_combination", model, ",".join(columns), F.col("n")
    )


def uniqueness(df: DataFrame, model: str, tests) -> DataFrame:
    """O28b and O28d together: ``tests`` is [(test name, columns)], all counted in one grouping.

    Each row gives one entry a test: the test's number and its values, each with its length
    in front, so that different values never read alike. ``unique`` ignores nulls, a
    combination counts them as values.
    """
    entries = []
    for i, (name, columns) in enumerate(tests):
        texts = [F.col(c).cast("string") for c in columns]
        parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
        key = F.concat(*parts)
        if name == "unique":
            key = F.when(texts[0].isNotNull(), key)
        entries.append(F.struct(F.lit(i).alias("at"), key.alias("key")))
    keys = df.select(F.inline(F.array(*entries))).where(F.col("key").isNotNull())
    twice = keys.groupBy("at", "key").count().where("count > 1")
    found = twice.agg(*[F.count_if(F.col("at") == i).alias(f"n{i}") for i in range(len(tests))])
    stack = ", ".join(f"'{name}', '{','.join(columns)}', n{i}" for i, (name, columns) in enumerate(tests))
    return found.selectExpr(f"stack({len(tests)}, {stack}) AS (test, column_name, failures)").select(
        "test", F.lit(model).alias("model"), "column_name", F.col("failures").cast("long").alias("failures")
    )


def relationships(child: DataFrame, model: str, column: str, parent: DataFrame, field: str, where=None) -> DataFrame:
    """Child rows (filtered by ``where``) whose value is missing from the parent.

    The child is first reduced to (value, row count) with partial aggregation, so a value
    carried by a third of the child rows is one row in the anti join.
    """
    rows = child.where(where) if where is not None else child
    per_value = rows.groupBy(F.col(column).alias("_child_key")).agg(F.count(F.lit(1)).alias("_rows"))
    keys = parent.select(F.col(field).alias("_parent_key")).where(F.col("_parent_key").isNotNull()).distinct()
    orphans = per_value.join(keys, F.col("_child_key") == F.col("_parent_key"), "left_anti")
    total = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))
    return _result(total, "relationships", model, column, F.col("n"))


def run_tests(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def gold_tests(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """The gold layer's declared tests (fact view and dimension)."""
    return run_tests(
        not_null(fact, "fct_rental_listings", ["scd_id", "listing_id", "website", "row_hash", "scraped_at", "valid_from"]),
        uniqueness(fact, "fct_rental_listings", [("unique", ["scd_id"]), ("unique_combination", ["listing_id", "website", "valid_from"])]),
        relationships(
            fact, "fct_rental_listings", "neighbourhood_sk", dim, "neighbourhood_sk",
            where=F.col("neighbourhood_sk").isNotNull(),
        ),
        not_null(dim, "dim_neighbourhoods", ["neighbourhood_sk", "neighbourhood", "city", "loaded_at"]),
        unique(dim, "dim_neighbourhoods", "neighbourhood_sk"),
    )


def constraint_violations(df: DataFrame, registry, model: str) -> DataFrame:
    """O28e input: NOT NULL columns and primary-key uniqueness of a registry table."""
    from strata import registry as R

    required = [c.name for c in registry if not c.nullable and c.name in df.columns]
    keys = R.key_columns(registry)
    dup = df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("n"))
    return run_tests(
        not_null(df, model, required),
        _result(dup, "primary_key", model, ",".join(keys), F.col("n")),
    )


@dataclass
class GateError(Exception):
    """Raised by :func:`gate`; ``violations`` holds the failing tests (collected, small)."""

    violations: list

    def __str__(self) -> str:
        return "constraint gate failed: " + ", ".join(
            f"{v['test']}({v['model']}.{v['column_name']})={v['failures']}" for v in self.violations
        )


def failing(results: DataFrame) -> DataFrame:
    return results.where(F.col("failures") > 0)


def gate(results: DataFrame) -> None:
    """O28e: any failing test fails the whole batch (nothing is written by the caller).

    Only the failing test rows (one per test, bounded by the number of tests) reach the
    driver.
    """
    bad = [r.asDict() for r in failing(results).collect()]
    if bad:
        raise GateError(bad)
