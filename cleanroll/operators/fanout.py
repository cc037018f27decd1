"""One pass over parsed bodies that yields the rows of a parent table and of all its child tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cleanroll.operators.bodies import CLEAN, TEXTS, Field, Shape, at, columns_of, schema_of
from cleanroll.session import stage

ROWS = "array<array<string>>"


@dataclass(frozen=True)
class Target:
    """One output table: its columns, its rows in a body (an array of arrays of texts), and the column that the
    parent's key goes to, if the columns do not hold it already."""

    name: str
    columns: Sequence[str]
    rows: Column
    key: str | None = None


def parent(name: str, shape: Shape) -> Target:
    """The one row of the body itself."""
    return Target(name, [f.column for f in shape.fields], F.array(F.array(*columns_of(shape))))


def children(
    name: str, path: str, fields: Sequence[Field], key: str, change: Mapping[str, Callable[[Column], Column]] | None = None
) -> Target:
    """The rows of a field that holds one object or an array of them.

    The field was read as text; an object there is read as an array of one. An array with an element that is no object
    fails as a whole, so it is read once more, element by element: such an element becomes a row of NULLs beside the others.
    """
    element, change = schema_of(fields), change or {}
    text = at(F.col("parsed"), path)
    one_by_one = F.transform(F.from_json(text, TEXTS), lambda e: F.from_json(e, element))
    items = F.coalesce(F.from_json(text, T.ArrayType(element)), one_by_one)
    cell = lambda e, f: change.get(f.column, lambda c: c)(CLEAN[f.clean](at(e, f.path)))
    return Target(name, [f.column for f in fields], F.transform(items, lambda e: F.array(*[cell(e, f) for f in fields])), key)


def texts_of(name: str, path: str, column: str, key: str) -> Target:
    """The rows of an array of texts; a text alone or a missing field gives none."""
    return Target(name, [column], F.transform(at(F.col("parsed"), path), lambda v: F.array(v)), key)


def fan_out(parsed: DataFrame, key: Column, targets: Sequence[Target]) -> DataFrame:
    """`target, key, ordinal, cells`: all rows of all `targets`, each body read once. `cells` follow the target's columns."""
    tagged = [F.struct(F.lit(t.name).alias("target"), F.coalesce(t.rows, F.array().cast(ROWS)).alias("rows")) for t in targets]
    by_target = parsed.select(key.alias("key"), F.explode(F.array(*tagged)).alias("t"))
    return by_target.select("t.target", "key", F.posexplode("t.rows").alias("ordinal", "cells"))


def staged_fan_out(fanned: DataFrame, name: str, stage: Callable[..., DataFrame] = stage) -> DataFrame:
    """The fan-out written once by `stage`, a folder a target, so that each table reads its own rows alone."""
    return stage(fanned, name, partition_by=("target",))


def tables_of(fanned: DataFrame, targets: Sequence[Target]) -> dict[str, DataFrame]:
    """Each target's table."""
    return {
        t.name: fanned.where(F.col("target") == t.name).select(
            *([F.col("key").alias(t.key)] if t.key else []), *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(t.columns)]
        )
        for t in targets
    }


def cell_rows(fanned: DataFrame, targets: Sequence[Target]) -> DataFrame:
    """`target, key, ordinal, column, value`: the same, one row a cell."""
    names = F.lit(None).cast("array<string>")
    for t in targets:
        names = F.when(F.col("target") == t.name, F.array(*[F.lit(c) for c in t.columns])).otherwise(names)
    cells = F.explode(F.arrays_zip(names.alias("column"), F.col("cells").alias("value"))).alias("c")
    return fanned.select("target", "key", "ordinal", cells).select("target", "key", "ordinal", "c.column", "c.value")
