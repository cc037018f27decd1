"""Rows of a DataFrame for comparisons."""


def values(df, *columns):
    """Sorted rows as tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
