from __future__ import annotations


def plain(value):
    """A value two engines can be compared by."""
    if value is None or (isinstance(value, float) and value != value):
        return None
    return float(value) if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    """Rows as a sorted list, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def frame_rows(df):
    return rows_of(df.columns, df.collect())


def values(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]
