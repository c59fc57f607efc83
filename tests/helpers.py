"""Plain helpers of the tests."""

import datetime as dt


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples; nulls sort first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])
