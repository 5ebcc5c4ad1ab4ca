"""Run metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def run_metrics(
    changes: DataFrame,
    graded: DataFrame,
    updates: DataFrame,
    approved: DataFrame,
    errors: DataFrame,
) -> DataFrame:
    """One row: counts of a run and its summary.

    Every changed file counts as analysed, also an unreadable one; API changes
    are those of the files that met the severity threshold (``graded``).
    """
    rows = F.count(F.lit(1))
    sources: dict[str, tuple[DataFrame, Column]] = {
        "files_analyzed": (changes, rows),
        "apis_changed": (graded, F.sum("n_changed")),
        "updates_generated": (updates, rows),
        "docs_updated": (approved, rows),
        "errors": (errors, rows),
    }
    counts = [
        df.agg(F.coalesce(count, F.lit(0)).cast("long").alias("n")).withColumn("metric", F.lit(name))
        for name, (df, count) in sources.items()
    ]
    row = reduce(DataFrame.unionByName, counts).agg(
        *[F.max(F.when(F.col("metric") == name, F.col("n"))).alias(name) for name in sources]
    )
    return with_summary(row)


def with_summary(row: DataFrame) -> DataFrame:
    """The counts with their one-line summary."""
    summary = F.concat_ws(
        ". ",
        F.format_string("Generated %d documentation update(s)", "updates_generated"),
        F.format_string("Applied %d update(s)", "docs_updated"),
        F.when(F.col("errors") > 0, F.format_string("Encountered %d error(s)", "errors")),
        F.format_string("Analyzed %d file(s)", "files_analyzed"),
        F.format_string("Found %d API change(s)", "apis_changed"),
    )
    return row.withColumn("summary", F.concat(summary, F.lit(".")))


class RunObservation:
    """Counts the rows of a run's tables while the run itself computes them.

    Pass each table through its method where the run uses it, run the jobs, then ask for
    :meth:`metrics`: nothing is computed a second time. A table is counted by the first job that
    reads it as a whole.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.observations: dict[str, Observation] = {}

    def _observed(self, name: str, rows: DataFrame, count: Column) -> DataFrame:
        self.observations[name] = Observation(name)
        return rows.observe(self.observations[name], F.coalesce(count, F.lit(0)).cast("long").alias("n"))

    def files_analyzed(self, changes: DataFrame) -> DataFrame:
        return self._observed("files_analyzed", changes, F.count(F.lit(1)))

    def apis_changed(self, graded: DataFrame) -> DataFrame:
        return self._observed("apis_changed", graded, F.sum("n_changed"))

    def updates_generated(self, updates: DataFrame) -> DataFrame:
        return self._observed("updates_generated", updates, F.count(F.lit(1)))

    def docs_updated(self, approved: DataFrame) -> DataFrame:
        return self._observed("docs_updated", approved, F.count(F.lit(1)))

    def errors(self, errors: DataFrame) -> DataFrame:
        return self._observed("errors", errors, F.count(F.lit(1)))

    def metrics(self) -> DataFrame:
        """One row as from :func:`run_metrics`; waits for jobs that are still running."""
        names = ("files_analyzed", "apis_changed", "updates_generated", "docs_updated", "errors")
        counts = [self.observations[n].get["n"] if n in self.observations else 0 for n in names]
        return with_summary(self.spark.createDataFrame([counts], ", ".join(f"{n} long" for n in names)))
