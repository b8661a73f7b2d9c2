"""Shared by the test modules. Not in a conftest, since several folders have one."""


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls last."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
