"""Bodies read with DuckDB's own JSON functions, for the oracles."""

from __future__ import annotations


def answered(table: str) -> dict[str, str]:
    """`latest`: the newest good body of each request key."""
    return {
        "ranked": f"""select *, row_number() over (partition by request_key order by fetched_at desc, body desc) as rn
            from {table} where status = 200 and body is not null""",
        "latest": "select request_key, body from ranked where rn = 1",
    }


def readable(source: str = "latest", rejects: tuple[str, ...] = (), keys: str = "request_key") -> dict[str, str]:
    """`bodies`: the keys and the body as JSON, without unreadable or rejected ones."""
    refuse = "".join(f" and not contains(body, '{r}')" for r in rejects)
    return {
        "parsed": f"select *, case when json_valid(body) then body::json end as j from {source} where true{refuse}",
        "bodies": "select * from parsed where j is not null",
    }


def at(path: str, clean: str = "as_is", source: str = "j") -> str:
    value = f"json_extract_string({source}, '$.{path}')"
    if clean == "null_text":
        return f"case when lower({value}) <> 'null' then {value} end"
    if clean == "null_or_empty":
        return f"case when lower({value}) not in ('null', '') then {value} end"
    if clean == "empty":
        return f"nullif({value}, '')"
    return value


def columns(root: str, names, clean: str = "as_is", source: str = "j", prefix: str = "") -> str:
    pairs = names.items() if isinstance(names, dict) else [(n, n) for n in names]
    dot = f"{root}." if root else ""
    return ", ".join(f"{at(dot + path, clean, source)} as {prefix}{column}" for column, path in pairs)


def items(path: str, alone: bool = True) -> str:
    """A list of JSON elements: of an array its own; of an object itself, if it may stand alone."""
    value, kind = f"json_extract(j, '$.{path}')", f"json_type(j, '$.{path}')"
    return f"case when {kind} = 'ARRAY' then cast({value} as json[])" + (f" when {kind} = 'OBJECT' then [{value}]" if alone else "") + " end"


def cells(target: str, source: str, key: str, columns: dict[str, str], elements: str | None = None) -> str:
    """`target, key, ordinal, column, value` of a table: its columns by name, each an expression over `j`, or over the
    element `e` of the list `elements`."""
    names = ", ".join(f"'{c}'" for c in columns)
    rows = f"select {key} as key, 0 as ordinal, j from {source}"
    if elements:
        rows = f"select key, unnest(l) as e, unnest(range(len(l))) as ordinal from (select {key} as key, {elements} as l from {source})"
    return f"select '{target}' as target, key, cast(ordinal as int) as ordinal, unnest([{names}]) as \"column\", unnest([{', '.join(columns.values())}]) as value from ({rows})"
