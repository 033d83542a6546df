"""What tests share besides fixtures (a plain module: several folders have a conftest)."""

from __future__ import annotations

import datetime as dt

SF_DIR = "/root/testdata/sf0.001"


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def stamp(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def records(df, *order):
    """Rows as dicts, ordered."""
    out = [row.asDict() for row in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[c]) for c in order)) if order else out
