"""Rows of a DataFrame as plain tuples."""


def rows_of(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
