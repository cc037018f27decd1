"""Appends to staging tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import quote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from cleanroll.functions.periods import period_column, with_period
from cleanroll.session import Stages, delete_path

MANIFEST, RUN = "run_commit", "run_id"


class TableSink(Protocol):
    def begin(self) -> None:
        """Take back what an earlier attempt of this run made visible."""

    def append(self, df: DataFrame, name: str) -> None: ...

    def commit(self) -> None:
        """Make the run's tables visible, all at once."""

    def log(self, df: DataFrame, name: str) -> None:
        """Append rows that a rerun must not replace."""


def by_name(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df` in the target's column order; a missing or surplus column is an error."""
    if set(df.columns) != set(columns):
        raise ValueError(f"columns differ: {sorted(set(df.columns) ^ set(columns))}")
    return df.select(*columns)


@dataclass(frozen=True)
class ParquetSink:
    """Appends to `<root>/<name>`. Appending an empty result adds no rows, so no count is needed.

    With a `run`, one name per job and batch, the rows land in their own `run_id=`
    partition, which a rerun overwrites instead of appending a second copy. They count from
    `commit` on: it writes one row to the manifest, by which `CommittedTables` reads. A run that
    fails between two tables leaves nothing visible, and neither does one that runs again, until it commits.

    `periods` names the histories that are partitioned by time too: the time column and the grain of each. Period bounds
    then leave the folders of other days or months unread (`changed_in`, `since`).
    """

    spark: SparkSession
    root: str
    names: Mapping[str, str] = field(default_factory=dict)
    run: str | None = None
    periods: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{self.names.get(name, name)}"

    def log(self, df: DataFrame, name: str) -> None:
        self._writer(df, name).mode("append").parquet(self.path(name))

    def _writer(self, df: DataFrame, name: str) -> DataFrameWriter:
        """A period's rows are gathered first, so that not every task writes a file of every period; adaptive execution
        splits a period that fills more than a file."""
        if name not in self.periods:
            return df.write
        ts_col, grain = self.periods[name]
        period = period_column(ts_col, grain)
        return with_period(df, ts_col, grain).hint("rebalance", F.col(period)).write.partitionBy(period)

    def _own(self, name: str) -> str:
        """The run's folder of a table."""
        return f"{self.path(name)}/{RUN}={quote(self.run, safe='-_.')}"

    def _marker(self) -> str:
        return self._own(MANIFEST)

    def begin(self) -> None:
        if self.run is not None:
            delete_path(self.spark, self._marker())

    def commit(self) -> None:
        if self.run is not None:
            self.spark.range(1).select(F.lit(self.run).alias("run")).coalesce(1).write.mode("overwrite").parquet(self._marker())

    def append(self, df: DataFrame, name: str) -> None:
        if self.run is None:
            self.log(df, name)
            return
        # The whole folder of the run is replaced: a rerun without rows, or without some of the periods, leaves none of the old.
        self._writer(df.drop(RUN), name).mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._own(name))


@dataclass(frozen=True)
class JdbcSink:
    """Appends over JDBC. The rows are staged first, so that the few connections write a finished table and do not
    narrow the work before them."""

    url: str
    schema: str
    properties: Mapping[str, str] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)
    batch_size: int = 10_000
    connections: int = 16

    def options(self, name: str) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": f"{self.schema}.{self.names.get(name, name)}",
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.connections),
        }

    def begin(self) -> None:
        """A database keeps what was appended; there is no manifest."""

    commit = begin

    def append(self, df: DataFrame, name: str) -> None:
        with Stages(df.sparkSession) as stages:
            self.log(stages.write(df, name), name)

    def log(self, df: DataFrame, name: str) -> None:
        df.write.format("jdbc").mode("append").options(**self.options(name)).save()


def append_all(outputs: Mapping[str, DataFrame], sink: TableSink) -> None:
    """Append each named output to its table."""
    for name, df in outputs.items():
        sink.append(df, name)
