"""Named tables read from parquet folders or over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cleanroll.sinks import MANIFEST, RUN


class TableSource(Protocol):
    def table(
        self, name: str, columns: Sequence[str] | None = None, where: Column | str | None = None, run: str | None = None
    ) -> DataFrame:
        """The named table; with `run`, that run's rows alone."""


def _narrow(df: DataFrame, columns: Sequence[str] | None, where: Column | str | None, run: str | None = None) -> DataFrame:
    if run is not None:
        df = df.where(F.col(RUN) == run).drop(RUN)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


@dataclass(frozen=True)
class ParquetTables:
    """Tables stored as `<root>/<name><suffix>`; `names` maps a logical to a physical name."""

    spark: SparkSession
    root: str
    suffix: str = ".parquet"
    names: Mapping[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{self.names.get(name, name)}{self.suffix}"

    def table(self, name, columns=None, where=None, run=None):
        return _narrow(self._read(name), columns, where, run)

    def _read(self, name: str) -> DataFrame:
        """The stored rows; run names that look like numbers or dates stay texts."""
        df = self.spark.read.parquet(self.path(name))
        return df.withColumn(RUN, F.col(RUN).cast("string")) if RUN in df.columns else df


@dataclass(frozen=True)
class CommittedTables(ParquetTables):
    """As `ParquetTables`, but of tables that are partitioned by run only the rows of committed runs.

    The run names become a filter on the partitions: folders of other runs are not read.
    """

    def committed(self) -> list[str]:
        """The committed runs: the names of the manifest's finished folders, one a run."""
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(MANIFEST)}/{RUN}=*/_SUCCESS")
        found = done.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(done) or []
        return sorted(unquote(f.getPath().getParent().getName()[len(RUN) + 1 :]) for f in found)

    def table(self, name, columns=None, where=None, run=None):
        df = self.spark.read.parquet(self.path(name))
        if RUN not in df.columns:
            return _narrow(df, columns, where)
        wanted = [r for r in self.committed() if run in (None, r)]
        return _narrow(df.where(F.col(RUN).cast("string").isin(wanted)).drop(RUN), columns, where)


@dataclass(frozen=True)
class Split:
    """How a JDBC scan is cut into parallel range reads."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class EvenSplit:
    """A JDBC scan cut into parallel reads by predicates, each row in one of them; see `even_split`."""

    predicates: tuple[str, ...]


QUANTILE_ACCURACY = 100  # ranks are off by at most a hundredth of a read


def _sql_literal(value, kind: T.DataType) -> str:
    if isinstance(kind, T.DateType):
        return f"DATE '{value.isoformat()}'"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    return str(value) if isinstance(kind, T.IntegralType) else f"{value:f}"


def _check_splittable(keys: DataFrame, *columns: str) -> None:
    for column in columns:
        if not isinstance(keys.schema[column].dataType, (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ValueError(f"{column}: a split needs whole or decimal numbers, dates or times")


def _quantiles(column: Column | str, reads: int) -> Column:
    return F.percentile_approx(column, [i / reads for i in range(reads + 1)], reads * QUANTILE_ACCURACY)


def _cuts(quantiles: Sequence | None, parts: int) -> list:
    """The inner bounds of `parts` even ranges, by the nearest quantiles; a value that fills several ranges is there as often."""
    last = len(quantiles or ()) - 1
    return [quantiles[min(last, round(i * last / parts))] for i in range(1, parts)] if last > 0 else []


def even_split(keys: DataFrame, column: str, partitions: int, within: str | None = None) -> EvenSplit:
    """About `partitions` reads of even size, though the values of `column` lie unevenly.

    `keys` holds `column` as the table has it: all of it, a sample, or that of the last load. Ranges between its quantiles
    are read each by a task. A value that fills several of them, or NULL, is a read of its own, and is cut further at the
    quantiles of a second column, `within`, among its rows; without that it stays one read. The predicates are plain SQL:
    every row meets one of them, also rows that came after `keys`. Without known values the whole table is one read.
    """
    if partitions < 1:
        raise ValueError("a split has one read at least")
    _check_splittable(keys, column, *([within] if within else []))
    literal = lambda value: _sql_literal(value, keys.schema[column].dataType)
    known = keys.agg(_quantiles(column, partitions).alias("at"), F.count(F.lit(1)).alias("rows"), F.count(column).alias("present")).first()
    absent = -(-partitions * (known.rows - known.present) // max(1, known.rows))
    cuts = _cuts(known.at, max(1, round(partitions * known.present / max(1, known.rows))))
    hot = sorted({v for v in cuts if cuts.count(v) > 1})
    inner = {}
    heavy = [*hot, *([None] if absent > 1 else [])]
    if within and heavy:  # one aggregate a heavy value, and there are fewer of them than reads
        is_value = lambda v: F.col(column).isNull() if v is None else F.col(column) == F.lit(v)
        at = [_quantiles(F.when(is_value(v), F.col(within)), partitions).alias(f"at{i}") for i, v in enumerate(heavy)]
        inner = dict(zip(heavy, keys.where(F.col(column).isNull() | F.col(column).isin(hot)).agg(*at).first(), strict=True))

    def shares(where: str, value, parts: int) -> list[str]:
        bounds = [_sql_literal(b, keys.schema[within].dataType) for b in sorted(set(_cuts(inner.get(value), parts)))] if within else []
        if not bounds:
            return [where]
        middle = [f"{within} >= {low} AND {within} < {high}" for low, high in zip(bounds, bounds[1:])]
        ranges = [f"({within} < {bounds[0]} OR {within} IS NULL)", *middle, f"{within} >= {bounds[-1]}"]
        return [f"{where} AND {r}" for r in ranges]

    out = shares(f"{column} IS NULL", None, absent)
    least = ""  # what the values from here on meet
    for value in sorted(set(cuts)):
        out.append(" AND ".join(filter(None, (least, f"{column} < {literal(value)}"))))
        if value in hot:
            out += shares(f"{column} = {literal(value)}", value, cuts.count(value))
        least = f"{column} {'>' if value in hot else '>='} {literal(value)}"
    return EvenSplit((*out, least or f"{column} IS NOT NULL"))


@dataclass(frozen=True)
class JdbcTables:
    """Tables of one database schema. `splits` gives the parallel read of each large table, by equal ranges (`Split`) or,
    where keys are skewed, by `even_split`.

    A table without a split is read by one task, so it has to be named in `small`.

    Filters and column lists reach the database through Spark's JDBC pushdown.
    """

    spark: SparkSession
    url: str
    schema: str
    properties: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split | EvenSplit] = field(default_factory=dict)
    small: frozenset[str] = frozenset()
    names: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, name: str) -> dict[str, str]:
        out = {
            **self.properties,
            "url": self.url,
            "dbtable": f"{self.schema}.{self.names.get(name, name)}",
            "fetchsize": str(self.fetch_size),
        }
        split = self.splits.get(name)
        if split is None and name not in self.small:
            raise ValueError(f"{name}: give a split, or name it in `small` to read it in one task")
        if isinstance(split, Split):
            out |= {
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return out

    def table(self, name, columns=None, where=None, run=None):
        options, split = self.options(name), self.splits.get(name)
        if isinstance(split, EvenSplit):
            df = self.spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=list(split.predicates), properties=options)
        else:
            df = self.spark.read.format("jdbc").options(**options).load()
        return _narrow(df, columns, where, run)
