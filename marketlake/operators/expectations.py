"""Table expectations: a suite is declared once and evaluated in one pass over the table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "ERROR", "WARN"


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    violated: Column | None = None  # row predicate
    violations: Column | None = None  # aggregate: number of violating rows
    observed: Column | None = None  # aggregate: a figure to report beside it
    unique_key: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return f"{self.kind}({self.column})"


class Suite:
    """Expectations over one table. NULLs violate `expect_not_null` only."""

    def __init__(self, name: str, severity: str = ERROR):
        self.name, self.severity = name, severity
        self.expectations: list[Expectation] = []

    def _add(self, kind: str, column: str, violated: Column) -> Suite:
        self.expectations.append(Expectation(kind, column, violated, F.count_if(violated)))
        return self

    def expect_not_null(self, column: str) -> Suite:
        return self._add("expect_not_null", column, F.col(column).isNull())

    def expect_between(self, column: str, min_value=None, max_value=None) -> Suite:
        """Inclusive bounds; either end may be open."""
        outside = F.lit(False)
        if min_value is not None:
            outside = outside | (F.col(column) < min_value)
        if max_value is not None:
            outside = outside | (F.col(column) > max_value)
        return self._add("expect_between", column, outside)

    def expect_in_set(self, column: str, values: Iterable) -> Suite:
        return self._add("expect_in_set", column, ~F.col(column).isin(list(values)))

    def expect_expr(self, label: str, predicate: str | Column) -> Suite:
        """Any row predicate, as SQL text or a column."""
        holds = F.expr(predicate) if isinstance(predicate, str) else predicate
        return self._add("expect_expr", label, ~holds)

    def expect_unique(self, *columns: str) -> Suite:
        """Every row of a repeated key is a violation; keys with a NULL part are not compared."""
        self.expectations.append(Expectation("expect_unique", ",".join(columns), unique_key=columns))
        return self

    def expect_fresh(self, column: str, as_of: Column, max_age_hours: float) -> Suite:
        """The newest value is at most `max_age_hours` older than `as_of`."""
        age = age_hours(F.max(column), as_of)
        late = F.when(age > max_age_hours, 1).otherwise(0).cast("bigint")
        self.expectations.append(Expectation("expect_fresh", column, None, late, age))
        return self

    def evaluate(self, df: DataFrame) -> DataFrame:
        """One row per expectation. All but uniqueness share a single aggregate over the table; with one uniqueness check,
        the others are counted within its keys, and the table is read once."""
        shared = [e for e in self.expectations if not e.unique_key]
        unique = [e for e in self.expectations if e.unique_key]
        if len(unique) == 1 and all(e.violated is not None for e in shared):
            return self._labelled(self._evaluate_at_once(df, unique[0], shared))
        figures = [F.count(F.lit(1)).alias("n")]
        for i, e in enumerate(shared):
            figures.append(e.violations.alias(f"v{i}"))
            figures.append((e.observed if e.observed is not None else F.lit(None)).cast("double").alias(f"o{i}"))
        rows = [
            F.struct(
                F.lit(self.expectations.index(e)).alias("position"), F.lit(e.kind).alias("expectation"),
                F.lit(e.column).alias("column"), F.col("n").alias("evaluated"),
                F.col(f"v{i}").alias("violations"), F.col(f"o{i}").alias("observed"),
            )
            for i, e in enumerate(shared)
        ]
        rows = rows or [F.struct(
            F.lit(-1).alias("position"), F.lit("row_count").alias("expectation"), F.lit("").alias("column"),
            F.col("n").alias("evaluated"), F.lit(0).cast("bigint").alias("violations"),
            F.lit(None).cast("double").alias("observed"),
        )]
        result = df.agg(*figures).select(F.inline(F.array(*rows)))
        for e in self.expectations:
            if e.unique_key:
                result = result.unionByName(self._evaluate_unique(df, e))
        return self._labelled(result.filter("position >= 0"))

    def _labelled(self, result: DataFrame) -> DataFrame:
        return result.select(
            F.lit(self.name).alias("suite"), F.lit(self.severity).alias("severity"), "position", "expectation",
            "column", "evaluated", "violations", "observed",
            ((F.col("evaluated") > 0) & (F.col("violations") == 0)).alias("passed"),
        )

    def _evaluate_at_once(self, df: DataFrame, unique: Expectation, shared: list[Expectation]) -> DataFrame:
        keys = list(unique.unique_key)
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[e.violations.alias(f"_v{i}") for i, e in enumerate(shared)])
        totals = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when((F.col("_n") > 1) & complete, F.col("_n"))), F.lit(0)).alias("u"),
            *[F.coalesce(F.sum(f"_v{i}"), F.lit(0)).alias(f"v{i}") for i in range(len(shared))],
        )
        rows = [
            F.struct(
                F.lit(self.expectations.index(e)).alias("position"), F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column"),
                F.col("n").alias("evaluated"), F.col(count).alias("violations"), F.lit(None).cast("double").alias("observed"),
            )
            for e, count in [(unique, "u"), *[(e, f"v{i}") for i, e in enumerate(shared)]]
        ]
        return totals.select(F.inline(F.array(*rows)))

    def _evaluate_unique(self, df: DataFrame, e: Expectation) -> DataFrame:
        keys = list(e.unique_key)
        complete = F.lit(True)
        for k in keys:
            complete = complete & F.col(k).isNotNull()
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"),
            F.coalesce(F.sum(F.when((F.col("n") > 1) & complete, F.col("n"))), F.lit(0)).alias("violations"),
        ).select(
            F.lit(self.expectations.index(e)).alias("position"), F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column"), "evaluated", "violations", F.lit(None).cast("double").alias("observed"),
        )

    def result(self, df: DataFrame) -> DataFrame:
        """One row: passed, expectations evaluated and failed, failure labels. An empty table fails."""
        return summarise(self.evaluate(df))


def summarise(evaluated: DataFrame) -> DataFrame:
    """Suite results from evaluated expectations; the label list is bounded by the suite's declarations."""
    failed = ~F.col("passed")
    label = F.struct("position", F.concat("expectation", F.lit("("), "column", F.lit(")")).alias("label"))
    labels = F.transform(F.array_sort(F.collect_list(F.when(failed, label))), lambda x: x["label"])
    return (
        evaluated.groupBy("suite", "severity")
        .agg(
            F.max("evaluated").alias("n_rows"),
            F.min("passed").alias("_passed"),
            F.count(F.lit(1)).alias("expectations_evaluated"),
            F.count_if(failed).alias("expectations_failed"),
            F.concat_ws(", ", labels).alias("_failures"),
        )
        .select(
            "suite", "severity", F.col("_passed").alias("passed"), "n_rows",
            F.when(F.col("n_rows") > 0, F.col("expectations_evaluated")).otherwise(0).alias("expectations_evaluated"),
            F.when(F.col("n_rows") > 0, F.col("expectations_failed")).otherwise(0).alias("expectations_failed"),
            F.when(F.col("n_rows") == 0, "no data")
            .when(F.col("expectations_failed") == 0, "none")
            .otherwise(F.col("_failures")).alias("failures"),
        )
    )


def run_suite(df: DataFrame, name: str, build: Callable[[Suite], object], severity: str = ERROR) -> DataFrame:
    """Evaluate the expectations a callback declares; the extension point for user-written suites."""
    suite = Suite(name, severity)
    build(suite)
    return suite.result(df)


def age_hours(newest: Column, as_of: Column) -> Column:
    return (F.unix_timestamp(as_of) - F.unix_timestamp(newest.cast("timestamp"))) / 3600.0
