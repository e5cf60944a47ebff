"""Sinks: tables, one-row JSON reports and fitted models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.ml.util import MLWritable
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


class Measured:
    """Aggregates of the rows that a writing job writes, taken by that job itself.

    They are observed after the last shuffle, in the tasks that write: of a task that
    runs twice only the attempt that ended counts, so a lost executor does not count
    rows twice.
    """

    def __init__(self, **measures: Column):
        self._seen = Observation()
        self._measures = [F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in measures.items()]]

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *self._measures)

    @property
    def result(self) -> dict[str, Any]:
        """``rows`` and the measures by name; waits for the job."""
        return self._seen.get


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (),
    sort_within: Iterable[str] = (),
    measured: Measured | None = None,
) -> str:
    """Idempotent Parquet write of a large table.

    ``rebalance`` lets adaptive execution cut a hot partition into several files
    and merge small ones; rows are sorted inside each file only, which is what
    row-group pruning needs. There is no global sort.
    """
    partition_by, sort_within = list(partition_by), list(sort_within)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    if measured:
        df = measured.watch(df)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_ordered(df: DataFrame, path: str, *order: Column | str, measured: Measured | None = None) -> str:
    """Idempotent Parquet write in a global order, by range partitions."""
    df = df.orderBy(*order)
    if measured:
        df = measured.watch(df)
    df.write.mode("overwrite").parquet(path)
    return path


#: Rows at most in a section of a report.
REPORT_ROWS = 10_000


def run_report(spark: SparkSession, **sections: Any) -> DataFrame:
    """A one-row frame with one column per report section.

    A DataFrame section must be a summary of at most ``REPORT_ROWS`` rows, more are an
    error; it becomes an array of structs through an uncorrelated subquery, so the
    report is one query. Other values become literals.
    """
    columns = []
    for name, value in sections.items():
        if isinstance(value, DataFrame):
            # One row too many is enough to know; never more than that is gathered.
            few = value.limit(REPORT_ROWS + 1).agg(F.collect_list(F.struct("*")).alias("all"))
            error = F.raise_error(F.lit(f"report section {name} has more than {REPORT_ROWS} rows"))
            rows = few.select(F.when(F.size("all") > REPORT_ROWS, error).otherwise(F.col("all")).alias(name))
            columns.append(rows.scalar().alias(name))
        elif isinstance(value, Mapping):
            parts = [F.lit(part).alias(key) for key, part in value.items()]
            columns.append(F.struct(*parts).alias(name))
        elif isinstance(value, (list, tuple)):
            columns.append(F.array(*[F.lit(part) for part in value]).alias(name))
        else:
            columns.append(F.lit(value).alias(name))
    return spark.range(1).select(*columns)


def write_report(report: DataFrame, path: str) -> str:
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_model(model: MLWritable, path: str) -> str:
    model.write().overwrite().save(path)
    return path
