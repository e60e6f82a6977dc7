"""Helpers the tests import."""


def rows(df, *order):
    """Rows as tuples in the frame's column order, sorted for comparing."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((x is None, str(x)) for x in row))
