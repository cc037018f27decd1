"""JSON bodies flattened by a list of paths.

`from_json` reads a body once, into the struct the paths describe; every field is
then a nested column. A body that is not JSON gives NULLs and no row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cleanroll.functions.text import null_or_empty, null_text


def as_is(column: Column) -> Column:
    return column


CLEAN: dict[str, Callable[[Column], Column]] = {
    "as_is": as_is,
    "null_text": null_text,
    "null_or_empty": null_or_empty,
    "empty": lambda c: F.nullif(c, F.lit("")),
}

# What a leaf may hold: its text, any value with its JSON type, or a list of texts.
TEXT = T.StringType()
ANY = T.VariantType()
TEXTS = T.ArrayType(T.StringType())


@dataclass(frozen=True)
class Field:
    """One output column. `a.b[0].c` walks objects and takes an array's first element."""

    column: str
    path: str
    clean: str = "as_is"
    kind: T.DataType = TEXT


@dataclass(frozen=True)
class Shape:
    """How a provider's body becomes columns.

    `required` is a path that must be there (JSON null counts as there). A body that
    contains one of `rejects` yields no row.
    """

    fields: Sequence[Field]
    required: str | None = None
    rejects: Sequence[str] = ()
    extra: Sequence[Field] = field(default=())


def _steps(path: str) -> list[str]:
    return path.replace("[0]", ".[0]").split(".")


def schema_of(fields: Sequence[Field], required: str | None = None) -> T.StructType:
    """The struct that holds exactly the given paths."""
    tree: dict = {}
    for f in fields:
        node = tree
        *parents, leaf = _steps(f.path)
        for step in parents:
            node = node.setdefault(step, {})
        node[leaf] = f.kind
    if required:
        node = tree
        for step in _steps(required):
            node = node.setdefault(step, {}) if isinstance(node, dict) else {}

    def build(node) -> T.DataType:
        if not isinstance(node, dict):
            return node
        if "[0]" in node:
            return T.ArrayType(build(node["[0]"]))
        return T.StructType([T.StructField(name, build(child)) for name, child in node.items()])

    return build(tree)


def at(parsed: Column, path: str) -> Column:
    """The value at `path`; NULL where a step is missing."""
    return reduce(lambda c, s: F.get(c, F.lit(0)) if s == "[0]" else c.getField(s), _steps(path), parsed)


def present(parsed: Column, body: Column, path: str) -> Column:
    """Is `path` in the body? Only a NULL value needs the second, exact look at the body."""
    there = F.try_variant_get(F.try_parse_json(body), f"$.{path}", "variant").isNotNull()
    return at(parsed, path).isNotNull() | there


def text_of(value: Column) -> Column:
    """The text of a value read with its type."""
    return F.try_variant_get(value, "$", "string")


def parse(df: DataFrame, shape: Shape, body: str = "body") -> DataFrame:
    """`df` plus `parsed`, without the bodies the shape rejects.

    The parsed body comes out of an `explode`, so the tests on it stay above it: as a
    plain column it would be read again in each filter, and pushed below the join
    that picks the wanted bodies, where it would be read for every landed one.
    """
    schema = schema_of([*shape.fields, *shape.extra], shape.required)
    raw = F.col(body)
    keep = reduce(lambda a, b: a & b, [~raw.contains(phrase) for phrase in shape.rejects], raw.isNotNull())
    parsed = df.where(keep).select("*", F.explode(F.array(F.from_json(raw, schema))).alias("parsed"))
    return parsed.where(present(F.col("parsed"), raw, shape.required)) if shape.required else parsed


def columns_of(shape: Shape) -> list[Column]:
    parsed = F.col("parsed")
    return [
        CLEAN[f.clean](at(parsed, f.path) if f.kind == TEXT else text_of(at(parsed, f.path))).alias(f.column)
        for f in shape.fields
    ]


def flatten(df: DataFrame, shape: Shape, keys: Sequence[str], body: str = "body") -> DataFrame:
    """`keys` and one column per field; one row per accepted body."""
    return parse(df, shape, body).select(*keys, *columns_of(shape))


def texts(column: str, path: str) -> Field:
    return Field(column, path, kind=TEXTS)


def nested(path: str) -> Field:
    """A field kept as JSON text, whose rows `fanout.children` reads."""
    return Field(path, path)


def fields_under(root: str, names: Sequence[str] | Mapping[str, str], clean: str = "as_is", kind: T.DataType = TEXT) -> list[Field]:
    """Fields below `root`; a mapping gives `{column: path}`, a list uses one name for both."""
    pairs = names.items() if isinstance(names, Mapping) else [(n, n) for n in names]
    prefix = f"{root}." if root else ""
    return [Field(column, f"{prefix}{path}", clean, kind) for column, path in pairs]
