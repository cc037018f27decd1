"""Batch periods and cool-down dates as range predicates that reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

DAY = "day"
MONTH = "month"
GRAINS = (DAY, MONTH)
ONE_DAY = dt.timedelta(days=1)


def _as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def bounds(run_date: dt.date | str, grain: str = DAY) -> tuple[dt.date, dt.date]:
    """First day of the period that holds `run_date`, and first day after it."""
    day = _as_date(run_date)
    if grain == DAY:
        return day, day + ONE_DAY
    if grain == MONTH:
        first = day.replace(day=1)
        return first, (first + dt.timedelta(days=32)).replace(day=1)
    raise ValueError(f"unknown grain {grain!r}")


def _literal(df: DataFrame, column: str, day: dt.date) -> Column:
    # The literal takes the column's own type: a cast on the column would keep the filter out of the scan.
    return F.lit(day.isoformat()).cast(df.schema[column].dataType)


def period_column(ts_col: str, grain: str) -> str:
    """The name of the partition column that holds the day or month of `ts_col`."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    return f"{ts_col}_{grain}"


def _period_columns(df: DataFrame, ts_col: str) -> dict[str, str]:
    """The partition columns of `ts_col` that `df` has, by grain."""
    return {g: period_column(ts_col, g) for g in GRAINS if period_column(ts_col, g) in df.columns}


def with_period(df: DataFrame, ts_col: str, grain: str = DAY) -> DataFrame:
    """`df` plus the first day of the day or month of `ts_col`, to partition by; NULL for a NULL time.

    The day of an instant is the one in UTC, so that it does not hang on the zone of the session that writes.
    """
    kind = df.schema[ts_col].dataType
    if isinstance(kind, T.TimestampType):
        day = F.date_from_unix_date(F.floor(F.unix_seconds(ts_col) / 86400).cast("int"))
    elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
        day = F.to_date(ts_col)
    else:
        raise ValueError(f"{ts_col}: a partition by {grain} needs dates or times")
    return df.withColumn(period_column(ts_col, grain), day if grain == DAY else F.trunc(day, "month").cast("date"))


def with_time(df: DataFrame, ts_col: str, *columns: Column | str) -> DataFrame:
    """`columns` and `ts_col` of `df`, and what it is partitioned by in time, for `changed_in` and `since` to filter on."""
    return df.select(*columns, ts_col, *_period_columns(df, ts_col).values())


def _between(df: DataFrame, ts_col: str, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Rows with `start <= ts_col < end`.

    Where `df` is partitioned by the day or month of `ts_col` (`with_period`) the same bounds go to the partitions, so that
    other folders are not read; the column that holds them is dropped. Instants are compared in the session's zone, and
    no zone is a day from UTC: their partitions reach a day further on both sides.
    """
    ts = F.col(ts_col)
    wanted = ts >= _literal(df, ts_col, start)
    if end is not None:
        wanted &= ts < _literal(df, ts_col, end)
    parts = _period_columns(df, ts_col)
    reach = ONE_DAY if isinstance(df.schema[ts_col].dataType, T.TimestampType) else dt.timedelta()
    for grain, column in parts.items():
        wanted &= F.col(column) >= _literal(df, column, bounds(start - reach, grain)[0])
        if end is not None:
            wanted &= F.col(column) < _literal(df, column, end + reach)
    return df.where(wanted).drop(*parts.values())


def changed_in(df: DataFrame, ts_col: str, run_date: dt.date | str, grain: str = DAY) -> DataFrame:
    """Rows changed in the day or month of `run_date`."""
    return _between(df, ts_col, *bounds(run_date, grain))


def since(df: DataFrame, ts_col: str, run_date: dt.date | str, days: int) -> DataFrame:
    """Rows from `run_date + days` on; `days` is signed, so -15 looks back 15 days."""
    return _between(df, ts_col, _as_date(run_date) + dt.timedelta(days=int(days)))


def shifted_date(column: Column, days: int, pattern: str = "yyyy-MM-dd") -> Column:
    """A date moved by `days` and written as text."""
    return F.date_format(F.date_add(column, days), pattern)
