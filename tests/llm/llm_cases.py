"""Helpers of several test modules."""


def smaller_first(row):
    """Order of rows by id (missing ids last), then text."""
    return (row[0] is None, row[0] or 0, row[1] is not None, row[1] or "")
